"""Weighted rendezvous hashing of records over shards, on native expressions alone.

Every shard draws a number for a record's key, and the lowest number, divided by the
shard's weight, wins. A number depends on the key and the shard only. So a further shard
takes records to itself and moves no other, and its share is that of its weight.

Places within a shard follow a hash of the records. Records are dealt to buckets by that
hash, buckets are counted, and a record's place is what lies before its bucket plus its
place in the bucket. So no task holds a shard, however large, and equal input gives equal
places on any cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.copies import MOST, grouped, numbered
from tillroll.llm.stages import written

SHARDS = 8
BUCKET_BITS = 14  # of the 52 bits of a place: buckets of each shard
_DIGITS = 13  # hexadecimal, so that a number is exact as a double


def _number(text: Column) -> Column:
    """52 bits of a text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("long")


def _text(value: str) -> Column:
    return F.coalesce(F.col(value).cast("string"), F.lit(""))


def shard_of(key: str, weights: Sequence[float]) -> Column:
    """The shard, from 0 on, of a record with this key column; null counts as an empty key.

    ``weights`` has the weight of each shard, above 0. Equal draws go to the lower shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be above 0, one for each shard")
    by_shard = F.array(*[F.lit(float(w)) for w in weights])

    def draw(shard: Column) -> Column:
        drawn = (_number(F.concat(_text(key), F.lit(":"), shard.cast("string"))) + 0.5) / float(1 << 4 * _DIGITS)
        return F.struct((-F.ln(drawn) / by_shard[shard]).alias("draw"), shard.alias("shard"))

    shards = F.sequence(F.lit(0), F.lit(len(weights) - 1))
    return F.array_min(F.transform(shards, draw))["shard"]


def shard_documents(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None
) -> DataFrame:
    """The shard and the place of every row of ``docs`` (doc_id, text, anything else).

    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``: the size is the text's
    UTF-8 bytes and one, slots of a shard are 0, 1, 2 and so on, and ``grown_shard`` is the
    shard under the weights ``grown``, by default one more shard of the last one's weight. A
    null text counts as an empty one. All rows of a doc_id are in one shard, rows without
    one as if it were one id; each row has its own slot. No rows give no rows.
    """
    weights = list(weights)
    grown = [*weights, weights[-1]] if grown is None else list(grown)
    text = F.coalesce("text", F.lit(""))
    short = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = grouped(short, MOST)
    place = _number(F.concat_ws(":", _text("doc_id"), "size", "text_crc32", "part"))
    rows = rows.withColumns({"place": place, "shard": shard_of("doc_id", weights), "grown_shard": shard_of("doc_id", grown)})
    rows = written(rows.withColumn("bucket", F.shiftright("place", 4 * _DIGITS - BUCKET_BITS)), "sharded")

    buckets = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket"))  # 2 ** BUCKET_BITS rows at most
    buckets = buckets.select("shard", "bucket", (upto - F.col("n")).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("place", "doc_id", "size", "text_crc32", "part")
    placed = rows.withColumn("upto", F.sum("copies").over(inside)).join(buckets, ["shard", "bucket"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        numbered(F.col("before") + F.col("upto") - F.col("copies")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id") -> None:
    """Write the rows of ``docs``, as they are, to a folder ``shard=<number>`` for each shard."""
    if "shard" in docs.columns:
        raise ValueError("the folders are named shard=..., so no column may have that name")
    docs.withColumn("shard", shard_of(key, weights)).write.partitionBy("shard").parquet(path)
