"""What the daily job puts on disk at once: slices of its rows, compressed, without old shuffles."""

import os
import time

import pytest
from pyspark.sql import functions as F

from test_cleaning import order_row, write_csv
from tillroll.functions.sharing import stage_writes
from tillroll.plans import catalog, daily
from tillroll.plans.daily import run_daily
from tillroll.sources import orders_files
from tillroll.sources.orders_files import load_orders, slices_for, write_output
from tillroll.sources.published import read_published
from tillroll.sources.star_tables import raw_order_text

SF_DIR = "/root/testdata/sf0.001"
OUTPUTS = ("cleaned_data", "quality_report", "rejected_rows", "customer_metrics", "risk_budget", "boston_matrix")


def text_rows(df):
    return sorted(str(r) for r in df.collect())


def odd_file(tmp_path):
    rows = [
        order_row(
            customer_id="" if i % 11 == 0 else f"c{i % 13}", order_id=f"o{i % 29}", product_name=f"p{i % 5}",
            order_date=f"{1 + i % 14}/{1 + i % 9}/{2011 + i % 3}", unit_price="n/a" if i % 17 == 0 else str(i % 23), quantity=str(1 + i % 4),
        )
        for i in range(90)
    ]
    # The same rows again, with their dates written otherwise.
    again = [{**r, "order_date": "/".join(x.zfill(2) for x in r["order_date"].split("/"))} for r in rows]
    return write_csv(tmp_path / "orders.csv", *rows, *again, *rows[:7])


@pytest.mark.parametrize("options", [{}, {"file_order": True}, {"fmt": "csv"}, {"quoted_breaks": True}])
def test_slices_give_what_the_whole_gives(spark, tmp_path, monkeypatch, options):
    path, got = odd_file(tmp_path), []
    for at_least in (1 << 40, 1):
        monkeypatch.setattr(orders_files, "SLICE_BYTES", at_least)
        out = str(tmp_path / f"out-{at_least}")
        counts = run_daily(spark, path, out, keep_rejects=True, **options)
        got.append([text_rows(counts), *[text_rows(read_published(spark, out, name)) for name in OUTPUTS]])
    assert got[0] == got[1] and all(got[0])


def test_rows_are_cleaned_and_totalled_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(orders_files, "SLICE_BYTES", 1)
    seen = {"cleaned": [], "totalled": []}

    def watched(into, run):
        def f(df, *args):
            seen[into].append(df.count())
            return run(df, *args)

        return f

    monkeypatch.setattr(daily, "clean_orders", watched("cleaned", daily.clean_orders))
    monkeypatch.setattr(daily, "customer_totals", watched("totalled", daily.customer_totals))
    out = str(tmp_path / "out")
    path = odd_file(tmp_path)
    run_daily(spark, path, out)
    assert len(seen["cleaned"]) == len(seen["totalled"]) == daily.SLICES
    assert sum(seen["cleaned"]) == load_orders(spark, path).count() and max(seen["cleaned"]) < sum(seen["cleaned"]) / 2
    assert sum(seen["totalled"]) == read_published(spark, out, "cleaned_data").count()


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def on_disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = on_disk()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(setting)
    with stage_writes(spark):
        write_output(spark.range(10_000).groupBy("id").count(), str(tmp_path / "t"))
    assert spark.conf.get(setting) == kept
    until = time.time() + 20
    while on_disk() - before and time.time() < until:
        time.sleep(0.2)
    assert not on_disk() - before


def test_input_is_dropped_on_request_only(spark, tmp_path):
    path, out = odd_file(tmp_path), str(tmp_path / "out")
    first = text_rows(run_daily(spark, path, out))
    assert os.path.exists(path)
    assert text_rows(run_daily(spark, path, out, drop_input=True)) == first
    assert not os.path.exists(path)


def test_a_file_without_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(orders_files, "SLICE_BYTES", 1)
    rows = {r["output"]: r["rows"] for r in run_daily(spark, write_csv(tmp_path / "o.csv"), str(tmp_path / "out")).collect()}
    assert rows["cleaned_data"] == rows["customer_metrics"] == 0 and rows["quality_report"] > 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_the_raw_file_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(orders_files, "SLICE_BYTES", 1)
    monkeypatch.setattr(orders_files, "COMPRESSED_ROWS", 1_000)
    seen = {}

    def watched(spark, path, *args, drop_input, **options):
        files = spark.read.text(path).inputFiles()
        seen.update(names=files, rows=load_orders(spark, path), drop_input=drop_input)
        sizes = seen["rows"].groupBy(F.input_file_name()).count()
        seen.update(most=sizes.agg(F.max("count")).first()[0], got=text_rows(seen["rows"]))
        return spark.range(1)

    monkeypatch.setattr(catalog, "run_daily", watched)
    catalog._daily_job(spark, SF_DIR)
    assert seen["names"] and all(n.endswith(".csv.gz") for n in seen["names"]) and seen["most"] <= 1_000 and seen["drop_input"]
    raw = raw_order_text(spark, SF_DIR)
    whole = write_output(raw, str(tmp_path / "whole"), "csv")
    assert seen["got"] == text_rows(load_orders(spark, whole))
    parts = [raw_order_text(spark, SF_DIR, i, 4).count() for i in range(4)]
    assert sum(parts) == raw.count() and all(parts)


def test_small_files_are_one_slice(spark, tmp_path):
    path = odd_file(tmp_path)
    assert slices_for(spark, path, 8) == 1
    big = tmp_path / "big"
    big.write_bytes(b"x" * (3 * orders_files.SLICE_BYTES))
    assert slices_for(spark, str(big), 8) == 3 and slices_for(spark, str(big), 2) == 2
