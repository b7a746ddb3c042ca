"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.stages import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge between two nodes; the component is
    its smallest node.

    ``edges`` has two columns of the same type. Edges are replaced by edges to smaller
    nodes, from large to small and back, until every node hangs on the smallest; the
    number of rounds grows with the logarithm of the number of nodes. Each round is a
    written table. No edge, no row.
    """
    one, two = edges.columns
    now = written(
        edges.where(F.col(one) != F.col(two))
        .select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v"))
        .distinct(),
        "edges",
    )
    mark = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum"))
    before, after = None, now.agg(mark.alias("mark")).first()["mark"]
    while after["n"] and before != after:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, after = after, now.agg(mark.alias("mark")).first()["mark"]
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
