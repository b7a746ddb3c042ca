"""Session settings for running the operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

# On a cluster, set spark.sql.shuffle.partitions to a few times the cores (AQE merges
# small ones) and spark.checkpoint.dir to a folder that all executors reach.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: split an oversized join partition even at the price of a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks: one shuffle partition per core."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tillroll")
    partitions = "8" if cpus == "*" else str(cpus)
    values = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": partitions,
        "spark.driver.memory": memory,
        "spark.ui.showConsoleProgress": "false",
        **settings,
    }
    for key, value in values.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
