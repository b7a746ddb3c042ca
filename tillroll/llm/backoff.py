"""Stupid-backoff scores of documents, from n-gram counts of the whole corpus.

The texts are written in numbered slices. Each task gathers the distinct n-grams of a
slice and deals them out by hash.
A bucket is one part of the count table: it adds up its n-grams over all slices, and
gives each slice the totals of the n-grams that it asked for. The totals join their
slice's texts, whose n-grams are looked up and summed per document.

N-grams travel as packed 64-bit hashes, a row for each bucket of a slice, not as a row
each. A common n-gram comes once from each slice, however many documents have it.

A document is scored by the rest of the corpus: its own n-grams are taken off the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import U, mix, ngrams, slices, word_hashes
from tillroll.llm.stages import written

ORDER = 2
DISCOUNT = 0.4
SLICE = 8 << 20
BUCKET_BYTES = 1 << 20  # of text for each bucket


class SliceGrams:
    """The n-grams of a slice's texts: ``keys`` are distinct, and for each order ``which`` has
    the place of every position's n-gram in them, -1 where it would leave its text."""

    def __init__(self, column: pa.Array, order: int):
        words, self.bounds = word_hashes(column)
        self.rows = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        parts = []
        for n in range(1, order + 1):
            start = np.arange(len(words)) - n + 1  # of the n-gram that ends here
            whole = (start >= 0) & (start >= self.bounds[:-1][self.rows])
            parts.append((whole, mix(ngrams(words, n)[start[whole]] ^ U(n))))
        keys = np.concatenate([k for _, k in parts])
        self.keys, places, self.counts = np.unique(keys, return_inverse=True, return_counts=True)
        self.which, at = [], 0
        for whole, own in parts:
            which = np.full(len(words), -1, np.int64)
            which[whole] = places[at : at + len(own)]
            self.which.append(which)
            at += len(own)

    def elsewhere(self, totals: np.ndarray) -> list[np.ndarray]:
        """For each order and position, how often its n-gram is in other documents."""
        out = []
        for which in self.which:
            pair = self.rows * np.int64(len(self.keys)) + which
            inside = np.flatnonzero(which >= 0)
            _, place, own = np.unique(pair[inside], return_inverse=True, return_counts=True)
            rest = np.zeros(len(which), np.int64)
            rest[inside] = totals[which[inside]] - own[place]
            out.append(rest)
        return out

    def scores(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row: the sum of log scores without the size of the corpus, how many words
        are scored against that size, and the number of words."""
        counts = self.elsewhere(totals)
        value, open_ = np.zeros(len(self.rows)), np.ones(len(self.rows), bool)
        penalty = np.zeros(len(self.rows))
        for n in range(len(counts), 1, -1):
            # The context is the (n-1)-gram that ends one word before.
            context = np.concatenate([[0], counts[n - 2][:-1]])
            found = open_ & (counts[n - 1] > 0)
            value[found] = penalty[found] + np.log(counts[n - 1][found] / context[found])
            tried = self.which[n - 1] >= 0
            penalty[open_ & ~found & tried] += np.log(DISCOUNT)
            open_ &= ~found
        seen = counts[0] > 0
        value[open_ & seen] = penalty[open_ & seen] + np.log(counts[0][open_ & seen])
        value[open_ & ~seen] = penalty[open_ & ~seen] + np.log(DISCOUNT)
        count = len(self.bounds) - 1
        return (
            np.bincount(self.rows, value, count),
            np.bincount(self.rows, open_, count).astype(np.int64),
            np.diff(self.bounds).astype(np.int64),
        )


def _sliced(docs: DataFrame) -> DataFrame:
    """``slice, texts``: each row is a whole slice, its doc_id and text packed, so no later
    step depends on where Arrow batches end."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slice_ = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slice_], pa.int64()), pa.array([packed(part.select(["doc_id", "text"]))], pa.binary())],
                    ["slice", "texts"],
                )
                slice_ += 1

    return docs.mapInArrow(number, "slice long, texts binary")


def packed(part: pa.RecordBatch) -> bytes:
    """A batch as one compressed value."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(part)
    return out.getvalue().to_pybytes()


def unpacked(value: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(value.as_buffer()).read_next_batch()


def planes(values: np.ndarray) -> bytes:
    """64-bit values with their first bytes together, then the second ones: most of the high
    bytes are zero, and the shuffle compresses them away."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _requests(sliced: DataFrame, order: int, buckets: int) -> DataFrame:
    """``bucket, slice, keys, counts``: the n-grams of every slice, packed."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_, value in zip(batch.column("slice").to_pylist(), batch.column("texts")):
                grams = SliceGrams(unpacked(value).column("text"), order)
                # Keys ascend, and so do their buckets, so a slice's totals are put together again in order.
                place = bucket_of(grams.keys, buckets)
                cuts = np.searchsorted(place, np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts))
                keys, counts = grams.keys, grams.counts.astype("<u4")
                del grams, place
                for k in range(0, len(some), 64):
                    own = some[k : k + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own.astype(np.int64)),
                            pa.array(np.full(len(own), slice_, np.int64)),
                            pa.array([planes(np.diff(keys[cuts[b] : cuts[b + 1]], prepend=U(0))) for b in own], pa.binary()),
                            pa.array([counts[cuts[b] : cuts[b + 1]].tobytes() for b in own], pa.binary()),
                        ],
                        ["bucket", "slice", "keys", "counts"],
                    )

    return sliced.mapInArrow(ask, "bucket long, slice long, keys binary, counts binary")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the keys' upper 32 bits."""
    return ((keys >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _totals(requests: DataFrame) -> DataFrame:
    """``slice, bucket, totals``: for each slice the corpus's counts of its n-grams."""

    def add(bucket: tuple, rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(from_planes(x.as_py(), U), dtype=U) for x in rows["keys"]]
        counts = [np.frombuffer(x.as_py(), "<u4") for x in rows["counts"]]
        table, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(table)).astype("<i8")[place]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        packed = [planes(t) for t in np.split(total, cuts)]
        ids = pa.array([bucket[0].as_py()] * len(keys), pa.int64())
        return pa.table([rows["slice"], ids, pa.array(packed, pa.binary())], names=["slice", "bucket", "totals"])

    return requests.groupBy("bucket").applyInArrow(add, "slice long, bucket long, totals binary")


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, n_words, score`` for every row of ``docs`` (doc_id, text, anything else).

    Words are as elsewhere here: lower-case ASCII, between white space. The score is the mean
    over a text's words of the log of: the n-gram's count over its context's, for the longest
    n-gram up to ``order`` that other documents have, times DISCOUNT for each longer one that
    was tried; for a single word the count over the number of words of other documents; a
    word that no other document has counts as once, discounted again. Rows are documents of
    their own, whatever their ids. A text without words, also a null one, and the words of
    a corpus that is one document, have a null score. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Written: two scans might cut their batches, and so the slices, at other rows.
    sliced = written(_sliced(docs), "slices")
    totals = _totals(_requests(sliced, order, 1 + int(size // BUCKET_BYTES)))

    def score(slice_: tuple, texts: pa.Table, counts: pa.Table) -> pa.Table:
        part = unpacked(texts["texts"][0])
        grams = SliceGrams(part.column("text"), order)
        parts = counts.sort_by("bucket")["totals"]
        found = np.concatenate([np.zeros(0, np.int64), *(from_planes(x.as_py(), np.int64) for x in parts)])
        value, open_, words = grams.scores(found)
        return pa.table([part.column("doc_id"), pa.array(value), pa.array(open_), pa.array(words)], names=["doc_id", "value", "open", "n_words"])

    parts = written(
        sliced.groupBy("slice")
        .cogroup(totals.groupBy("slice"))
        .applyInArrow(score, "doc_id long, value double, open long, n_words long"),
        "scores",
    )
    corpus = parts.agg(F.sum("n_words")).first()[0] or 0
    others = F.lit(corpus) - F.col("n_words")
    total = F.col("value") - F.when(F.col("open") > 0, F.col("open") * F.log(others)).otherwise(0.0)
    return parts.select(
        "doc_id", "n_words", F.when((F.col("n_words") > 0) & (others > 0), total / F.col("n_words")).alias("score")
    )
