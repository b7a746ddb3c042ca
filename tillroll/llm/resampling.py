"""Importance resampling of documents towards a target text distribution.

Word runs are hashed to buckets. A bucket's gain is the log ratio of its share in the
target and in the corpus, a document's weight the sum of the gains of its runs, looked up
in one array. Noise of a Gumbel distribution is added, and the highest scores are a sample
without replacement.

Where the sample ends is found by a distributed quickselect: random pivot keys, exact
counts before, at and behind each pivot, and on with the rows between two pivots, until the
key at the wanted place is a pivot. Only the winners are then sorted, in ranges, and
ranked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tillroll.llm.copies import grouped, numbered
from tillroll.llm.hashing import LONG_WORD, LOWER, slices, text_bytes, word_spans
from tillroll.llm.stages import written

BUCKETS = 10_000
RUN = 1  # words in the longest run
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
PIVOTS = 15
KEY = ("minus", "doc_id", "n_features", "part")  # ascending: higher scores, then smaller ids, come first

_byte = np.arange(256)
# Words are digits, letters a to z and all characters beyond ASCII.
APART = ~(((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80))


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ (out & np.uint32(1)) * np.uint32(0xEDB88320)
    return out


_CRC = _crc_table()


def crc_on(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each text so far and, behind it, a span of ``data``."""
    state, left = crc ^ np.uint32(0xFFFFFFFF), ends - starts
    todo, at = np.flatnonzero((left > 0) & (left <= LONG_WORD)), 0
    while len(todo):
        state[todo] = (state[todo] >> np.uint32(8)) ^ _CRC[(state[todo] ^ data[starts[todo] + at]) & np.uint32(255)]
        at += 1
        todo = todo[left[todo] > at]
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(left > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(crc[i]))
    return out


def features(column: pa.Array, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every run of 1 to ``run`` words of a slice of texts."""
    data, offsets = text_bytes(column)
    starts, ends, rows = word_spans(LOWER[data], offsets, APART)
    data = np.append(LOWER[data], np.uint8(32))
    space = len(data) - 1
    crc, found, where = np.zeros(len(starts), np.uint32), [], []
    for n in range(run):
        whole = rows[n:] == rows[: len(rows) - n]
        if n:
            crc = crc_on(crc[: len(rows) - n], data, np.full(len(whole), space), np.full(len(whole), space + 1))
        crc = crc_on(crc, data, starts[n:], ends[n:])
        found.append((crc % np.uint32(buckets)).astype(np.int64)[whole])
        where.append(rows[: len(rows) - n][whole])
    return np.concatenate(found), np.concatenate(where)


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of all ``texts`` (column text) fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += np.bincount(features(part.column("text"), run, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in counted.collect():  # one row a bucket at most
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, cut down to whole ones."""
    size, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    pairs = zip(corpus.tolist(), target.tolist())
    ratio = [float(t + 1) * (all_corpus + size) / (float(s + 1) * (all_target + size)) for s, t in pairs]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """``doc_id, n_features, n_words, weight`` of every row of ``docs``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, rows = features(part.column("text"), run, len(gain))
                n = part.num_rows
                total = np.zeros(n, np.int64)
                np.add.at(total, rows, gain[found])
                count = np.bincount(rows, minlength=n)
                words = count if run == 1 else np.bincount(features(part.column("text"), 1, 1)[1], minlength=n)
                columns = [part.column("doc_id"), pa.array(count), pa.array(words), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "n_words", "weight"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(score, "doc_id long, n_features long, n_words long, weight long")


def noise(key: str, seed: int) -> Column:
    """Thousandths of a Gumbel variable that the seed and the key decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def _key(row: Row | None = None) -> Column:
    """The composite key of a row of the table, or that of a given row."""
    value = F.col if row is None else lambda c: F.lit(row[c]).cast("long")
    return F.struct(*[value(c).alias(c) for c in KEY])


def _sorts(row: Row) -> tuple:
    return tuple((row[c] is not None, row[c] or 0) for c in KEY)


def kth(rows: DataFrame, k: int) -> Row:
    """The row that has the k-th of all copies in the order of the key, 1 <= k <= copies.

    Keys are distinct. Each round takes the rows with the lowest hashes of a new seed as
    pivots, counts all rows before, at and behind each, and keeps those between two pivots
    in a written table. A round leaves about one row of ``PIVOTS`` + 1.
    """
    turn = 0
    while True:
        turn += 1
        pivots = sorted(rows.select(*KEY).orderBy(F.xxhash64(F.lit(turn), *KEY)).limit(PIVOTS).collect(), key=_sorts)
        keys = F.array(*[_key(p) for p in pivots])
        below, at_most = F.filter(keys, lambda p: p < _key()), F.filter(keys, lambda p: p <= _key())
        placed = rows.withColumn("cell", F.size(below) + F.size(at_most))
        for where, n in sorted(placed.groupBy("cell").agg(F.sum("copies")).collect()):
            if k <= n:
                break
            k -= n
        if where % 2:  # at a pivot
            return pivots[where // 2]
        rows = written(placed.where(F.col("cell") == where).drop("cell"), "between")


def ranked(winners: DataFrame) -> DataFrame:
    """The winners with ``rank``, that of the first copy: sorted in ranges, each counted."""
    placed = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("at", F.monotonically_increasing_id())
    # Written, so that ranges and places stay as they are whatever is computed again.
    placed = written(placed.withColumn("range", F.shiftright("at", 33)), "winners")
    ranges = placed.groupBy("range").agg(F.sum("copies").alias("n"))
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")  # one row a task
    ranges = ranges.select("range", before.alias("before"))
    upto = F.sum("copies").over(Window.partitionBy("range").orderBy("at"))
    return (
        placed.withColumn("upto", upto)
        .join(ranges, "range")
        .withColumn("rank", F.col("before") + F.col("upto") - F.col("copies") + 1)
        .drop("range", "at", "before", "upto")
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, run: int = RUN, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text, anything else) and rank the sample.

    ``doc_id, n_features, weight, score, rank``: ``percent`` of the rows with at least
    ``LEAST_WORDS`` words, rounded down, are drawn and have ranks 1, 2, 3 and so on by
    falling score, ties by rising doc_id (none first); all other rows have a null rank. A
    null or empty text has no features and weighs nothing. Rows of equal doc_id draw the
    same noise and are ranked apart. ``target`` has a column text; without any text in it
    gains follow from the corpus alone. No rows give no rows.
    """
    gain = gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets))
    weighed = weigh(docs, gain, run).select(
        "doc_id",
        "n_features",
        "weight",
        (F.col("n_words") >= LEAST_WORDS).alias("able"),
        (-F.col("weight") - noise("doc_id", seed)).alias("minus"),
    )
    rows = written(grouped(weighed), "weighed")
    able = rows.where("able")
    k = percent * (able.agg(F.sum("copies")).first()[0] or 0) // 100
    first = F.lit(None).cast("long")
    if k:
        last = _key(kth(able, k))
        drawn = ranked(able.where(_key() <= last))
        rest = rows.where(~(F.col("able") & (_key() <= last)))
        rows = drawn.unionByName(rest.withColumn("rank", first))
        first = F.col("rank")
    at = F.col("at")
    return (
        rows.withColumn("first", first)
        .withColumn("at", numbered(F.coalesce("first", F.lit(1).cast("long"))))
        .select(
            "doc_id",
            "n_features",
            "weight",
            (-F.col("minus")).alias("score"),
            F.when(F.col("first").isNotNull() & (at <= k), at).alias("rank"),
        )
    )
