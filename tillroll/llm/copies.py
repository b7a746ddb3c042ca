"""Equal rows as one row with a number of copies, and back.

Equal rows cannot be told apart, so a step that numbers rows may number them in any
order. Grouped, they are counted before they are shuffled, and a row that makes up a
third of a table is a few short rows that fall to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 1_000  # copies in one row; more make several rows, numbered by ``part``


def grouped(df: DataFrame, most: int = MOST) -> DataFrame:
    """The distinct rows of ``df`` with ``part`` and ``copies``, nulls equal to nulls."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {most}"))))
    return parts.withColumn("copies", F.least(F.lit(most), F.col("copies") - F.col("part") * most))


def numbered(first: Column) -> Column:
    """One row for each of the ``copies``, numbered from ``first`` on."""
    return F.explode(F.sequence(first, first + F.col("copies") - 1))
