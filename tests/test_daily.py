import glob

import pytest

from helpers import by
from test_cleaning import order_row, write_csv
from tillroll.functions.sharing import share
from tillroll.plans import daily
from tillroll.plans.daily import run_daily
from tillroll.sources import published
from tillroll.sources.published import published_versions, read_published


def order_file(tmp_path):
    rows = []
    for i in range(30):
        year = 2011 + i % 3
        rows.append(
            order_row(
                customer_id=f"c{i % 7}", order_id=f"o{i}", product_name=f"p{i % 4}",
                order_date=f"{1 + i % 12}/{1 + i % 28}/{year}", unit_price=str(10 + i), quantity=str(1 + i % 5),
            )
        )
    return write_csv(tmp_path / "orders.csv", *rows, rows[0])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_all_outputs_are_written(spark, tmp_path, fmt):
    out = str(tmp_path / "out")
    summary = by(run_daily(spark, order_file(tmp_path), out, as_of_year=2013, fmt=fmt), "output")
    assert {k: r["rows"] for k, r in summary.items() if k != "risk_budget"} == {
        "cleaned_data": 30, "quality_report": 29, "customer_metrics": 7, "boston_matrix": 4,
    }
    for name, row in summary.items():
        assert glob.glob(f"{out}/versions/*/{name}/*.{fmt}")
        back = read_published(spark, out, name)
        assert back.count() == row["rows"]
    assert "risk_level" in back.columns or "category" in back.columns


def test_rejected_rows_are_kept_on_request(spark, tmp_path):
    out = str(tmp_path / "out")
    path = write_csv(tmp_path / "o.csv", *[order_row(order_id=f"o{i}", order_date="1/2/2013") for i in range(9)], order_row(order_id="bad", quantity="many"))
    rows = by(run_daily(spark, path, out, keep_rejects=True, file_order=True), "output")
    assert rows["rejected_rows"]["rows"] == 1 and rows["cleaned_data"]["rows"] == 10
    kept = read_published(spark, out, "rejected_rows").first()
    assert (kept.order_id, kept.quantity, kept.rejected_for) == ("bad", "many", "quantity")


def test_a_second_run_replaces_the_first(spark, tmp_path):
    path, out = order_file(tmp_path), str(tmp_path / "out")
    for _ in range(2):
        summary = by(run_daily(spark, path, out), "output")
    assert summary["cleaned_data"]["rows"] == 30


def test_a_failed_run_leaves_the_old_outputs(spark, tmp_path):
    path, out = order_file(tmp_path), tmp_path / "out"
    run_daily(spark, path, str(out))
    before = sorted(str(p) for p in out.rglob("*"))
    with pytest.raises(Exception, match="label"):
        run_daily(spark, path, str(out), risk_label_names=("one",))
    assert sorted(str(p) for p in out.rglob("*")) == before


@pytest.mark.parametrize("stops_at", ["manifest", "rename", "clean up"])
def test_readers_see_one_run_whole_wherever_the_next_stops(spark, tmp_path, monkeypatch, stops_at):
    """The run is cut off before its manifest, between writing and naming it, or behind it."""
    out = str(tmp_path / "out")
    run_daily(spark, order_file(tmp_path), out)
    (old,) = published_versions(spark, out)
    longer = write_csv(tmp_path / "more.csv", *[order_row(order_id=f"n{i}", order_date="1/2/2013") for i in range(50)])

    class Stopped(BaseException):
        pass

    def stop(*_, **__):
        raise Stopped

    if stops_at == "manifest":
        monkeypatch.setattr(daily, "publish", stop)
    elif stops_at == "rename":
        monkeypatch.setattr(published.json, "dumps", stop)
    else:
        monkeypatch.setattr(published, "published_versions", stop)
    with pytest.raises(Stopped):
        run_daily(spark, longer, out)
    monkeypatch.undo()
    rows = {name: read_published(spark, out, name).count() for name in ("cleaned_data", "customer_metrics")}
    if stops_at == "clean up":  # the new version is complete, and stays
        assert rows["cleaned_data"] == 50 and published_versions(spark, out)[0] == old
    else:
        assert rows["cleaned_data"] == 30 and published_versions(spark, out) == [old]
    assert read_published(spark, out, "cleaned_data", old).count() == 30


def test_old_versions_go_and_wrong_names_are_told(spark, tmp_path):
    path, out = order_file(tmp_path), tmp_path / "out"
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(out), "cleaned_data")
    for _ in range(3):
        run_daily(spark, path, str(out))
    assert sorted(p.name for p in (out / "versions").iterdir()) == published_versions(spark, str(out))
    assert len(published_versions(spark, str(out))) == published.KEPT
    with pytest.raises(KeyError, match="cleaned_data"):
        read_published(spark, str(out), "nothing")


def test_file_order_decides_what_comes_first(spark, tmp_path):
    rows = [
        order_row(customer_id="c", order_id="1", order_date=f"{day}/1/2013", unit_price=price, quantity="1")
        for day, price in ((5, "50"), (3, "30"))
    ]
    path, out = write_csv(tmp_path / "orders.csv", *rows), str(tmp_path / "out")
    for file_order, first in ((True, 50.0), (False, 30.0)):
        run_daily(spark, path, out, file_order=file_order)
        assert [r.first_order_revenue for r in read_published(spark, out, "customer_metrics").collect()] == [first]
        assert "file_order" not in read_published(spark, out, "cleaned_data").columns


def test_frames_of_others_stay_shared(spark, tmp_path):
    mine = share(spark.range(3))
    run_daily(spark, order_file(tmp_path), str(tmp_path / "out"))
    assert mine.storageLevel.useMemory


def test_failure_is_not_hidden(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_daily(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"))
