"""The daily job: raw orders to cleaned data, customers, risk budget and products."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.sharing import scratch_path, stage_writes
from tillroll.operators.cleaning import clean_orders, quality_report, rejected_rows
from tillroll.operators.customers import (
    RISK_EDGES,
    RISK_LABELS,
    clv_segments,
    customer_measures,
    customer_totals,
    risk_allocation,
    risk_allocation_report,
)
from tillroll.operators.products import boston_matrix
from tillroll.sources.orders_files import delete_output, load_orders, slices_for, write_output
from tillroll.sources.published import new_version, output_path, publish, published_versions

SLICES = 8  # of the raw rows, at most
CODEC = "zstd"  # of stages and published parquet


def run_daily(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    as_of_year: int | None = None,
    fmt: str = "parquet",
    date_mode: str = "month_first_fallback",
    multiline: bool = False,
    risk_edges: Sequence[float] = RISK_EDGES,
    risk_label_names: Sequence[str] = RISK_LABELS,
    file_order: bool = False,
    keep_rejects: bool = False,
    quoted_breaks: bool = False,
    drop_input: bool = False,
) -> DataFrame:
    """Run the job and return ``output, rows``, one row per written output.

    Each stage is written as parquet and the next one reads that table, so a lost
    executor costs no earlier stage. Raw rows are staged in slices by customer, then
    cleaned and totalled by customer slice by slice, so the shuffles of one slice at a time lie on
    disk. With ``drop_input`` the input is deleted once it is staged. ``quality_report`` tells what cleaning dropped and
    could not read. With ``file_order`` the first of equal rows stays, and first orders
    and day gaps follow the file, else the dates. With ``keep_rejects`` the raw rows that hold
    an unreadable date or number are an output of their own, ``rejected_rows``. Outputs are published as one version, to
    be read with ``read_published``: wherever a run fails, readers see the version before.
    """
    order_key = "file_order" if file_order else None
    version = new_version()
    work = scratch_path(spark, "stages")
    counts: list[tuple[str, int]] = []

    def stage(name: str, *parts: DataFrame, then: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Write the parts one after another; each one, read back, goes to ``then``."""
        as_it_is = fmt == "parquet" and "file_order" not in parts[0].columns
        target = output_path(output_dir, version, name)
        path = target if as_it_is else f"{work}/{name}"
        seen: set[str] = set()
        for part in parts:
            with stage_writes(spark):
                write_output(part, path, compression=CODEC, mode="append")
            staged = spark.read.parquet(path)
            if then:
                files = set(staged.inputFiles())
                then(spark.read.schema(staged.schema).parquet(*sorted(files - seen)))
                seen = files
        if not as_it_is:
            write_output(staged.drop("file_order"), target, fmt, compression=CODEC if fmt == "parquet" else None)
        counts.append((name, staged.count()))
        return staged

    def add_totals(lines: DataFrame) -> None:
        with stage_writes(spark):
            write_output(customer_totals(lines, order_key), f"{work}/totals", compression=CODEC, mode="append")

    try:
        loaded = load_orders(spark, input_path, multiline, file_order, quoted_breaks)
        slices = slices_for(spark, input_path, SLICES)
        # Copies of a row are of one customer, so neither copies nor customers are in two slices.
        of_customer = F.pmod(F.xxhash64("customer_id"), F.lit(slices)).cast("int")
        sliced = loaded.withColumn("slice", of_customer)
        with stage_writes(spark):
            write_output(sliced, f"{work}/raw", partition_by=["slice"], compression=CODEC)
        if drop_input:
            delete_output(spark, input_path)
        sliced = spark.read.schema(sliced.schema).parquet(f"{work}/raw")
        raw = sliced.drop("slice", "file_order")
        clean = stage(
            "cleaned_data",
            *[clean_orders(sliced.where(F.col("slice") == i).drop("slice"), date_mode, order_key) for i in range(slices)],
            then=add_totals,
        )
        stage("quality_report", quality_report(raw, clean.drop("file_order"), date_mode))
        if keep_rejects:
            stage("rejected_rows", rejected_rows(raw, date_mode))
        delete_output(spark, f"{work}/raw")
        customers = stage("customer_metrics", clv_segments(customer_measures(spark.read.parquet(f"{work}/totals"))))
        budget = risk_allocation(customers, as_of_year, risk_edges, risk_label_names)
        stage("risk_budget", risk_allocation_report(budget))
        stage("boston_matrix", boston_matrix(clean))
        publish(spark, output_dir, version, {name: fmt for name, _ in counts})
    except BaseException:
        if version not in published_versions(spark, output_dir):
            delete_output(spark, output_path(output_dir, version, ""))
        raise
    finally:
        delete_output(spark, work)
    return spark.createDataFrame(counts, "output string, rows bigint")
