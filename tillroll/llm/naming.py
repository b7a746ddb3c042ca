"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. All blocks of the corpus are
sorted, and equal blocks get one integer name: their rank. Then neighbouring names are
paired, the pairs are sorted and named alike, and so on, until one name is left of each
text. Two texts of the same number of blocks are equal if and only if their last names
are equal: no hash decides anything.

The sort is dealt out by ranges of (hash of the key, row, place), so a block that a third
of all rows share is spread over many tasks, and no block goes to the driver. Inside a task
keys of one hash are told apart by their bytes. What runs over the edge between two tasks
is mended from a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.stages import lean, written

BLOCK_BYTES = 4096
_RANK_BITS = 40


def text_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows ``row, place, blocks, block, doc_id, text_sha256``; the last two and the number
    of blocks on place 0 only. An empty text is one empty block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, shas = (batch.column(c).to_pylist() for c in ("row", "doc_id", "text_sha256"))
            out: list[tuple] = []
            held = 0
            for i, row in enumerate(rows):
                text = memoryview(batch.column("text")[i].as_buffer() or b"")
                count = max(1, -(-len(text) // block_bytes))
                for k in range(count):
                    block = bytes(text[k * block_bytes : (k + 1) * block_bytes])
                    out.append((row, k, count, block, ids[i] if k == 0 else None, shas[i] if k == 0 else None))
                    held += len(block) + 64
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["row", "place", "blocks", "block", "doc_id", "text_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("text_sha256"),
    )
    return keyed.mapInArrow(
        lean(cut), "row long, place long, blocks long, block binary, doc_id long, text_sha256 binary"
    )


def _deal(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def name_keys(rows: DataFrame, keys: list[str], stage: str) -> DataFrame:
    """Replace the key columns by ``name``: equal keys get equal names, others others, and
    names ascend with (hash, key). ``row, place`` make the rows distinct."""
    rest = [c for c in rows.columns if c not in keys]
    dealt = rows.withColumn("deal", _deal(keys)).repartitionByRange("deal", "row", "place")
    ranged = dealt.sortWithinPartitions("deal", *keys, "row", "place")
    kinds = {f.name: f.dataType for f in rows.schema}

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << _RANK_BITS
        last, name = None, first - 1
        for batch in batches:
            names, edges = [], []
            columns = [batch.column(k).to_pylist() for k in ("deal", *keys)]
            for key in zip(*columns):
                if key != last:
                    if last is None:
                        edges.append((key, name + 1))
                    elif key[0] == last[0]:
                        edges += [(last, name), (key, name + 1)]
                    last, name = key, name + 1
                names.append(name)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.nulls(len(names), arrow[k]) for k in keys), pa.array(names, pa.int64())], shown
            )
            if edges:
                yield edge_rows(edges, batch.schema)
        if last is not None:
            yield edge_rows([(last, name)], batch.schema)

    def edge_rows(edges: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        """Rows of keys alone, without a row: a task's first key and its last, and all keys of
        a hash that several have. Only these can go on in another task."""
        values = [pa.array([key[1 + i] for key, _ in edges], arrow[k]) for i, k in enumerate(keys)]
        blank = [pa.nulls(len(edges), schema.field(c).type) for c in rest]
        return pa.RecordBatch.from_arrays([*blank, *values, pa.array([name for _, name in edges], pa.int64())], shown)

    shown = [*rest, *keys, "name"]
    arrow = {k: pa.binary() if kinds[k].typeName() == "binary" else pa.int64() for k in keys}
    schema = ", ".join([*(f"`{c}` {kinds[c].simpleString()}" for c in (*rest, *keys)), "name long"])
    table = written(ranged.mapInArrow(lean(rank), schema), stage)
    named = table.where("row is not null").select(*rest, "name")

    lowest = F.min("name").over(Window.partitionBy(*keys)).alias("first")
    edges = table.where("row is null").select("name", lowest).where("name <> first").distinct()
    # Two numbers for each edge between tasks.
    same = [tuple(r) for r in edges.collect()]
    if not same:
        return named
    mended = table.sparkSession.createDataFrame(same, "name long, first long")
    return named.join(F.broadcast(mended), "name", "left").select(*rest, F.coalesce("first", "name").alias("name"))


def block_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``row, doc_id, text_sha256, blocks, name``. Equal texts, and
    only they, have equal (blocks, name)."""
    heads = ["blocks", "doc_id", "text_sha256"]
    level = name_keys(text_blocks(docs, block_bytes), ["block"], "blocks")
    longest = level.agg(F.max("blocks")).first()[0] or 0
    done = [level.where("blocks = 1").drop("place")]
    level, width = level.where("blocks > 1"), 1
    while width < longest:
        width *= 2
        left = F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left")
        right = F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")
        pairs = level.groupBy("row", F.expr("place div 2").alias("place")).agg(
            left, right, *[F.max(c).alias(c) for c in heads]
        )
        level = name_keys(pairs, ["left", "right"], "pairs")
        done.append(level.where(f"blocks <= {width}").drop("place"))
        level = level.where(f"blocks > {width}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row", "doc_id", "text_sha256", "blocks", "name")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, anything else) with its group of equal texts.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, one row per input row. The
    row with the largest doc_id of a group is kept; of rows that share this id too, one.
    A null text counts as empty; a null doc_id is the smallest. No rows give no rows.
    """
    named = block_names(docs, block_bytes)
    best = F.max(F.struct("doc_id", "row"))
    groups = named.groupBy("blocks", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``exact_duplicates`` keeps. They are
    found again by doc_id and digest, in whatever order ``docs`` gives its rows."""

    def key(sha: Column) -> Column:
        return F.concat_ws(":", sha, F.col("doc_id").cast("long").cast("string")).alias("key")

    groups = block_names(docs, block_bytes).groupBy("blocks", "name")
    kept = groups.agg(F.max("doc_id").alias("doc_id"), F.first("text_sha256").alias("sha"))
    rows = docs.select(key(F.sha2(F.coalesce("text", F.lit("")), 256)), F.struct("*").alias("whole"))
    # Rows equal in both merge before the shuffle.
    one = rows.groupBy("key").agg(F.first("whole").alias("whole"))
    return one.join(kept.select(key(F.lower(F.hex("sha")))), "key", "leftsemi").select("whole.*")
