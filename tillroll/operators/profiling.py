"""Column profiles: one row per column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.quantiles import exact_quantiles
from tillroll.schema import NUMERIC_TYPES


def _every_column(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(c,) for c in cols], "column string")


def profile_numeric(df: DataFrame, cols: Iterable[str] = tuple(NUMERIC_TYPES)) -> DataFrame:
    """``column, count, mean, std, min, p25, p50, p75, max``; std is the sample one
    and percentiles interpolate linearly. Percentiles are exact at any size. A column
    without values has count 0 and nothing else."""
    cols = list(cols)
    long = (
        df.select(*[F.col(c).cast("double") for c in cols])
        .unpivot([], cols, "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    basics = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    at = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    percentiles = exact_quantiles(long, list(at.values())).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for name, p in at.items()]
    )
    return (
        _every_column(df, cols)
        .join(basics, "column", "left")
        .join(percentiles, "column", "left")
        .select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", *at, "max")
    )


def profile_text(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``column, count, unique, top, freq`` of the text columns; of equally frequent
    values the first in text order is ``top``. A column without values has count 0."""
    cols = [f.name for f in df.schema if f.dataType.simpleString() == "string"] if cols is None else list(cols)
    counted = (
        df.select(*[F.col(c).cast("string") for c in cols])
        .unpivot([], cols, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = (
        counted.groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("best"),
        )
        .select(
            "column",
            "count",
            "unique",
            F.col("best.value").alias("top"),
            (-F.col("best.minus_n")).alias("freq"),
        )
    )
    none = F.lit(0).cast("bigint")
    return _every_column(df, cols).join(found, "column", "left").select(
        "column", F.coalesce("count", none).alias("count"), F.coalesce("unique", none).alias("unique"), "top", "freq"
    )
