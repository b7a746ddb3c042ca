"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word byte by byte from both ends and labels every position with a
probability for each language. A document's probabilities are the mean over all its
positions. It is trained here, in numpy, by backpropagation through time, on the words
of a bounded sample of labelled documents.

Words are read apart, so equal words give equal labels: a slice of texts runs each
distinct word once and counts it as often as it occurs. Long words are read in pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.hashing import LOWER, slices, span_hashes, text_bytes, word_spans
from tillroll.llm.stages import written

SAMPLE = 300  # labelled documents of a language that training reads at most
SAMPLE_CHARS = 1_500  # of each of them
SAMPLE_ALL = 30_000  # documents of all languages; the more languages, the fewer of each
PIECE = 16  # bytes
UNITS = 12
STEPS, BATCH, RATE = 300, 384, 0.02
UNKNOWN = "und"

_byte = np.arange(256)
_LETTER = ((_byte >= 97) & (_byte <= 122)) | ((_byte >= 65) & (_byte <= 90)) | (_byte >= 128)
_EDGE = 32


def word_pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a slice in lower case, and start, end and row of the pieces of all words
    that have a letter."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    some = letters[ends] > letters[starts]
    starts, ends, rows = starts[some], ends[some], rows[some]
    count = -(-(ends - starts) // PIECE)
    stops = np.cumsum(count)
    place = np.arange(int(stops[-1]) if len(stops) else 0) - np.repeat(stops - count, count)
    first = np.repeat(starts, count) + PIECE * place
    return data, first, np.minimum(first + PIECE, np.repeat(ends, count)), np.repeat(rows, count)


def padded(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Pieces of one size as rows, with an edge before and after."""
    out = np.full((len(starts), size + 2), _EDGE, np.uint8)
    out[:, 1:-1] = data[starts[:, None] + np.arange(size)]
    return out


@dataclass
class Network:
    """Weights of both directions (first axis 0: left to right) and of the output."""

    labels: list[str]
    inputs: np.ndarray  # 2, 256, 3 units: update gate, reset gate, candidate
    hidden: np.ndarray  # 2, units, 3 units
    output: np.ndarray  # 2 units, labels
    bias: np.ndarray

    @classmethod
    def new(cls, labels: list[str], rng: np.random.Generator) -> Network:
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        k = len(labels)
        return cls(labels, draw(2, 256, 3 * UNITS), draw(2, UNITS, 3 * UNITS), draw(2 * UNITS, k), np.zeros(k, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.hidden, self.output, self.bias]

    def run(self, pieces: np.ndarray) -> tuple[np.ndarray, list]:
        """States of both directions at every position, and what training needs of them."""
        n, size = pieces.shape
        state, saved = np.zeros((2, n, UNITS), np.float32), []
        states = np.zeros((2, size, n, UNITS), np.float32)
        for t in range(size):
            seen = np.stack([self.inputs[0][pieces[:, t]], self.inputs[1][pieces[:, size - 1 - t]]])
            own = state @ self.hidden
            gates = 0.5 * np.tanh(0.5 * (seen[:, :, : 2 * UNITS] + own[:, :, : 2 * UNITS])) + 0.5
            update, reset = gates[:, :, :UNITS], gates[:, :, UNITS:]
            candidate = np.tanh(seen[:, :, 2 * UNITS :] + reset * own[:, :, 2 * UNITS :])
            new = state + update * (candidate - state)
            saved.append((state, own, update, reset, candidate))
            state = new
            states[0, t], states[1, size - 1 - t] = state[0], state[1]
        return states, saved

    def labelled(self, states: np.ndarray) -> np.ndarray:
        """Probabilities: position, piece, label."""
        logits = states[0] @ self.output[:UNITS] + states[1] @ self.output[UNITS:] + self.bias
        logits -= logits.max(axis=-1, keepdims=True)
        out = np.exp(logits)
        return out / out.sum(axis=-1, keepdims=True)

    def gradients(self, pieces: np.ndarray, weight: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all positions; ``weight`` is 0 on padding."""
        n, size = pieces.shape
        states, saved = self.run(pieces)
        error = self.labelled(states)
        error[:, np.arange(n), truth] -= 1
        error *= (weight / weight.sum()).T[:, :, None]
        d_output = np.concatenate([np.einsum("tnu,tnk->uk", s, error, optimize=True) for s in states])
        d_bias = error.sum(axis=(0, 1))
        d_states = np.stack([error @ self.output[:UNITS].T, error @ self.output[UNITS:].T])
        d_inputs, d_hidden = np.zeros_like(self.inputs), np.zeros_like(self.hidden)
        d_state = np.zeros((2, n, UNITS), np.float32)
        for t in range(size - 1, -1, -1):
            state, own, update, reset, candidate = saved[t]
            back = size - 1 - t
            d_new = d_state + np.stack([d_states[0, t], d_states[1, back]])
            d_candidate = d_new * update * (1 - candidate * candidate)
            d_update = d_new * (candidate - state) * update * (1 - update)
            d_reset = d_candidate * own[:, :, 2 * UNITS :] * reset * (1 - reset)
            d_seen = np.concatenate([d_update, d_reset, d_candidate], axis=2)
            d_own = np.concatenate([d_update, d_reset, d_candidate * reset], axis=2)
            d_hidden += state.transpose(0, 2, 1) @ d_own
            d_state = d_new * (1 - update) + d_own @ self.hidden.transpose(0, 2, 1)
            np.add.at(d_inputs[0], pieces[:, t], d_seen[0])
            np.add.at(d_inputs[1], pieces[:, back], d_seen[1])
        return [d_inputs, d_hidden, d_output, d_bias]

    def piece_sums(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each piece the sum of its positions' probabilities, edges left out."""
        out = np.zeros((len(starts), len(self.labels)), np.float32)
        sizes = ends - starts
        order = np.argsort(sizes, kind="stable")
        for size in np.unique(sizes).tolist():
            own = order[np.searchsorted(sizes[order], size) : np.searchsorted(sizes[order], size, side="right")]
            for k in range(0, len(own), 4096):
                some = own[k : k + 4096]
                states, _ = self.run(padded(data, starts[some], size))
                out[some] = self.labelled(states)[1:-1].sum(axis=0)
        return out


def train(texts: list[str], labels: list[str], seed: int = 11) -> Network | None:
    """Fit on sampled texts; none if there is no word to learn from."""
    names = sorted(set(labels))
    data, starts, ends, rows = word_pieces(pa.array(texts, pa.string()))
    if not len(starts):
        return None
    rng = np.random.default_rng(seed)
    net = Network.new(names, rng)
    truth = np.searchsorted(names, labels)[rows]
    by_label = [np.flatnonzero(truth == k) for k in range(len(names))]
    by_label = [own for own in by_label if len(own)]
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, STEPS + 1):
        own = np.concatenate([rng.choice(x, -(-BATCH // len(by_label))) for x in by_label])
        sizes = ends[own] - starts[own]
        place = np.arange(PIECE)
        pieces = np.full((len(own), PIECE + 2), _EDGE, np.uint8)
        inside = place < sizes[:, None]
        pieces[:, 1:-1][inside] = data[(starts[own][:, None] + place)[inside]]
        weight = np.zeros(pieces.shape, np.float32)
        weight[:, 1:-1] = inside
        rate = RATE * (1 - step / (STEPS + 1))
        for w, g, a, b in zip(net.weights(), net.gradients(pieces, weight, truth[own]), first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def sampled_words(text: str) -> str:
    """SAMPLE_CHARS characters of a text at most, in words drawn from the whole of it."""
    if len(text) <= SAMPLE_CHARS:
        return text
    words = re.findall(r"\S{1,64}", text)
    order = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace"))).permutation(len(words))
    upto = np.cumsum([len(words[k]) + 1 for k in order])
    return " ".join(words[k] for k in np.sort(order[: np.searchsorted(upto, SAMPLE_CHARS + 1, side="right")]))


def learn(docs: DataFrame) -> Network | None:
    """Train on a sample of the labelled documents, in one task: of every language SAMPLE
    documents at most, fewer from a hundred languages on, drawn by a hash of their ids, with
    words from all over each text. None if there is nothing to learn from."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(fold != 0)
    # Distinct ids, so that an id on many rows is one of them.
    counts = written(known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")), "languages")
    languages = counts.count()
    if not languages:
        return None
    bound = max(1, min(SAMPLE, SAMPLE_ALL // languages))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # Some more than needed: of few documents all, as the hash leaves a small language out by chance.
    share = F.lit(1.5 * bound + 20) / F.col("n") * (1 << 20)
    drawn = (
        known.join(F.broadcast(counts), "lang")
        .where(chance < share)
        .groupBy("lang", "doc_id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("row"))
        .select("doc_id", "lang", "row.text", chance.alias("chance"))
    )
    first = Window.partitionBy("lang").orderBy("chance", "doc_id")
    sample = drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= bound).drop("place")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([sampled_words(t) for t in batch.column("text").to_pylist()], pa.string())
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", texts)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("chance", "doc_id", "text", "lang")
        rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in columns)))
        net = train([r[2] for r in rows], [r[3] for r in rows])
        if net is not None:
            weights = [w.tobytes() for w in net.weights()]
            yield pa.RecordBatch.from_arrays([pa.array([net.labels]), pa.array([weights])], ["labels", "weights"])

    short = sample.mapInArrow(cut, sample.schema)
    fitted = short.repartition(1).mapInArrow(fit, "labels array<string>, weights array<binary>").first()
    if fitted is None:
        return None
    shapes = [(2, 256, 3 * UNITS), (2, UNITS, 3 * UNITS), (2 * UNITS, -1), (-1,)]
    weights = [np.frombuffer(w, np.float32).reshape(s) for w, s in zip(fitted["weights"], shapes)]
    return Network(list(fitted["labels"]), *weights)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (doc_id, text, lang,
    anything else).

    Learns from rows with a language, a text and an id outside the held-out fold. A text
    without a letter, also an empty or null one, is ``und`` with score 0, as is every text if
    there is nothing to learn from. Of equal probabilities the first label in alphabetical
    order counts. A null doc_id is labelled and not held out.
    """
    net = learn(docs)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                pooled = np.zeros((part.num_rows, len(net.labels)))
                data, starts, ends, rows = word_pieces(part.column("text"))
                if len(starts):
                    hashes = span_hashes(data, starts, ends)
                    _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
                    sums = net.piece_sums(data, starts[where], ends[where])
                    for k in range(len(net.labels)):
                        pooled[:, k] = np.bincount(rows, sums[which, k], part.num_rows)
                total = pooled.sum(axis=1)
                best = pooled.argmax(axis=1)
                score = pooled[np.arange(part.num_rows), best] / np.maximum(total, 1e-9)
                names = pa.array([net.labels[k] for k in best], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lettered"), names, pa.array(np.minimum(score, 1.0))],
                    ["doc_id", "lettered", "lang_pred", "score"],
                )

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lettered.alias("lettered"))
    if net is None:
        read = source.select("doc_id", F.lit(False).alias("lettered"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        read = source.mapInArrow(label, "doc_id long, lettered boolean, lang_pred string, score double")
    return read.select(
        "doc_id",
        held_out.alias("held_out"),
        F.when(F.col("lettered"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
    )
