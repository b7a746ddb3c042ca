"""Toxic text by a support vector machine over a subsequence string kernel.

The unit is a word of a sentence, without its punctuation and in lower case; letters
spaced out one by one count as one word. Two words are as similar as the four-symbol
subsequences that they share, where every skipped symbol costs a factor: an inserted
character or a gap weakens an insult, but does not hide it. Word edges are symbols too.

Training sees a bounded sample of labelled documents. A label says that some word of
a document is toxic, not which: witnesses are chosen, a machine is trained on them, and
the witnesses are chosen again with it. Nyström landmarks make the kernel finite: the
machine is linear in the similarities to a few dozen words. Summed over the landmarks it
is one weight per subsequence, so scoring all words of the corpus is one look-up per
subsequence. A document scores by its two worst words: a harmless word that happens to
look like an insult seldom comes twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.hashing import mix, ngrams, slices, span_hashes, text_bytes, word_spans
from tillroll.llm.stages import lean

SAMPLE_TOXIC = 1_500  # labelled documents of either kind that training reads at most
SAMPLE_CLEAN = 3_000
SAMPLE_CHARS = 16_000  # longer documents are not in the sample
LANDMARKS = 160
ROUNDS = 4
THRESHOLD = 0.3
FLOOR = -0.5  # words below are harmless alike

_SYMBOLS = 64  # 0 is a word's edge
_DECAY = 0.5
_STEPS = tuple(product((1, 2), repeat=3))
_FADE = tuple(np.float32(_DECAY ** (sum(s) - 3)) for s in _STEPS)


def _symbol_table() -> np.ndarray:
    """Bytes to symbols; 0 for what is no letter. Either case of a Latin letter is one."""
    table = np.zeros(256, np.uint8)
    for b in range(26):
        table[ord("a") + b] = table[ord("A") + b] = b + 1
    for b in range(0x80, 0x100):
        table[b] = 32 + (b & 31) if b < 0xC0 else 27 + min(max(b - 0xC2, 0), 4)
    return table


_SYMBOL = _symbol_table()


def word_symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a slice: symbols with an edge before and after each word, the words'
    starts and ends in them, and each word's row."""
    data, offsets = text_bytes(column)
    starts, ends, rows = word_spans(data, offsets)
    symbols = _SYMBOL[data]
    upto = np.concatenate([[0], np.cumsum(symbols > 0)])
    sizes = upto[ends] - upto[starts]
    starts, rows, sizes = starts[sizes > 0], rows[sizes > 0], sizes[sizes > 0]
    letters = symbols[symbols > 0]
    # Single letters in a row are one word.
    joined = np.zeros(len(sizes), bool)
    joined[1:] = (sizes[1:] == 1) & (sizes[:-1] == 1) & (rows[1:] == rows[:-1])
    first = np.flatnonzero(~joined)
    rows, sizes = rows[first], np.add.reduceat(sizes, first) if len(first) else sizes
    return *edged(letters, sizes), rows


def edged(letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes + 2)
    starts = ends - sizes - 2
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    inner = np.ones(len(out), bool)
    inner[starts] = inner[ends - 1] = False
    out[inner] = letters
    return out, starts, ends


def distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``word_symbols`` with every word once, and for each occurrence its word and row."""
    symbols, starts, ends, rows = word_symbols(column)
    hashes = span_hashes(symbols, starts, ends)
    _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
    return *take_words(symbols, starts[where], ends[where]), which, rows


def take_words(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = ends - starts
    stops = np.cumsum(sizes)
    place = np.arange(int(stops[-1]) if len(stops) else 0) - np.repeat(stops - sizes, sizes)
    return symbols[np.repeat(starts, sizes) + place], stops - sizes, stops


def subsequences(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.float32]]:
    """For each gap pattern: where a subsequence starts, its code, and its weight."""
    room = np.repeat(ends, ends - starts) - np.arange(len(symbols))
    wide = symbols.astype(np.int32)
    for (a, b, c), fade in zip(_STEPS, _FADE):
        at = np.flatnonzero(room > a + b + c)
        code = ((wide[at] * _SYMBOLS + wide[at + a]) * _SYMBOLS + wide[at + a + b]) * _SYMBOLS + wide[at + a + b + c]
        yield at, code, fade


def norms(sizes: np.ndarray) -> np.ndarray:
    """The length of a word's feature vector if no subsequence came twice."""
    total = np.full(len(sizes), 1e-6, np.float32)
    for s, fade in zip(_STEPS, _FADE):
        total += fade * fade * np.maximum(sizes - sum(s), 0)
    return np.sqrt(total)


@dataclass
class Model:
    """Weights of subsequences, and how a document's worst words become a probability."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float
    slopes: tuple[float, float]
    shift: float

    def table(self) -> np.ndarray:
        """Which subsequences have a weight."""
        out = np.zeros(_SYMBOLS**4, bool)
        out[self.codes] = True
        return out

    def word_scores(self, table: np.ndarray, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.float32)
        each = np.zeros(len(symbols), np.float32)
        for at, code, fade in subsequences(symbols, starts, ends):
            hit = np.flatnonzero(table[code])
            each[at[hit]] += fade * self.weights[np.searchsorted(self.codes, code[hit])]
        return np.add.reduceat(each, starts) / norms(ends - starts) + self.bias

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(worst @ np.array(self.slopes) + self.shift, -40, 40)))


def worst_words(scores: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """For each row how far its worst and its second worst word lie above FLOOR."""
    above = np.flatnonzero(scores > FLOOR)
    above = above[np.lexsort((-scores[above], rows[above]))]
    owner = rows[above]
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    place = np.arange(len(owner)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(owner) else owner
    out = np.zeros((count, 2))
    for k in range(2):
        out[owner[place == k], k] = scores[above[place == k]] - FLOOR
    return out


def _similarities(words: tuple, landmarks: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kernel of words and landmarks; the landmarks' subsequences and features."""
    marks, mark_starts, mark_ends = landmarks
    owner = np.repeat(np.arange(len(mark_starts)), mark_ends - mark_starts)
    parts = [(owner[at], code, np.full(len(at), fade)) for at, code, fade in subsequences(*landmarks)]
    owners, all_codes, fades = (np.concatenate(x) for x in zip(*parts))
    codes, column = np.unique(all_codes, return_inverse=True)
    features = np.zeros((len(mark_starts), len(codes)), np.float32)
    np.add.at(features, (owners, column), fades)
    features /= norms(mark_ends - mark_starts)[:, None]

    symbols, starts, ends = words
    place = np.full(_SYMBOLS**4, -1, np.int16)
    place[codes] = np.arange(len(codes))
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    out = np.zeros((len(starts), len(mark_starts)), np.float32)
    by_code = np.ascontiguousarray(features.T)
    for at, code, fade in subsequences(symbols, starts, ends):
        column = place[code]
        hit = column >= 0
        np.add.at(out, owner[at[hit]], fade * by_code[column[hit]])
    return out / norms(ends - starts)[:, None], codes, features


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps; the last column is the bias."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost[active, None]
        new = np.linalg.solve(xa.T @ (xa * ca) + ridge * np.eye(x.shape[1]), xa.T @ (ca[:, 0] * y[active]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def train(texts: list[str], toxic: list[int], rate: float) -> Model:
    """Fit on sampled documents; ``rate`` is the share of toxic ones among all labelled."""
    symbols, starts, ends, which, rows = distinct_words(pa.array(texts, pa.string()))
    y = np.asarray(toxic, dtype=np.int64)
    count = len(starts)
    constant = Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0, (0.0, 0.0), float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
    if not count or not y.any() or y.all():
        return constant

    # Near copies of one document would make its every word look toxic: one of them counts.
    pairs = np.unique(rows * np.int64(count) + which)
    doc, word = pairs // count, pairs % count
    keep = np.ones(len(y), bool)
    grams, inside = ngrams(which.astype(np.uint64), 3), np.flatnonzero(rows[2:] == rows[:-2])
    for salt in (1, 2, 3):
        least = mix(np.arange(len(y), dtype=np.uint64))
        least[rows[inside]] = np.iinfo(np.uint64).max
        np.minimum.at(least, rows[inside], mix(grams[inside] + np.uint64(salt)))
        fresh = np.zeros(len(y), bool)
        fresh[np.unique(least, return_index=True)[1]] = True
        keep &= fresh
    counted = keep[doc]
    words = (symbols, starts, ends)
    owner = np.repeat(np.arange(count), ends - starts)

    # A first guess: the word's subsequences that most exceed their share of toxic documents.
    toxic_words = np.bincount(word[counted], y[doc[counted]], count)
    clean_words = np.bincount(word[counted], 1 - y[doc[counted]], count)
    n_toxic, n_clean = max(1, (y[keep] == 1).sum()), max(1, (y[keep] == 0).sum())
    share = n_toxic / (n_toxic + n_clean)
    best = np.full((3, count), -9.0)
    for at, code, fade in subsequences(*words):
        codes, column = np.unique(code, return_inverse=True)
        hits = np.bincount(column, toxic_words[owner[at]], len(codes))
        due = share * (hits + np.bincount(column, clean_words[owner[at]], len(codes)))
        excess = ((hits - due) / np.sqrt(due + 1))[column]
        for k in range(3):
            held = best[k].copy()
            np.maximum.at(best[k], owner[at], excess)
            excess = np.where(excess >= best[k][owner[at]], held[owner[at]], excess)
    due = share * (toxic_words + clean_words)
    scores = np.maximum(best.mean(axis=0), (toxic_words - due) / np.sqrt(due + 1))

    rng = np.random.default_rng(7)
    clean_pool = np.unique(word[counted & (y[doc] == 0)])
    order = np.lexsort((-scores[word], doc))
    ranked_doc, ranked_word = doc[order], word[order]
    first = np.concatenate([[True], ranked_doc[1:] != ranked_doc[:-1]])
    place = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    model, table = constant, None
    for turn in range(ROUNDS):
        if turn:
            order = np.lexsort((-scores[word], doc))
            ranked_doc, ranked_word = doc[order], word[order]
        top = place < (2 if turn == 0 else 1)
        witness = (top | (scores[ranked_word] > 0) & (turn > 0)) & (y[ranked_doc] == 1) & keep[ranked_doc]
        positive, votes = np.unique(ranked_word[witness], return_counts=True)
        hard = np.unique(ranked_word[(place < 3) & (y[ranked_doc] == 0) & keep[ranked_doc]])
        drawn = rng.choice(clean_pool, min(len(clean_pool), 8_000), replace=False)
        negative = np.setdiff1d(np.union1d(hard, drawn), positive) if turn == 0 else np.union1d(hard, drawn)
        # A word that clean documents have about as often is no witness.
        fair = toxic_words[positive] / n_toxic > 2 * clean_words[positive] / n_clean
        positive, votes = positive[fair], votes[fair]
        negative = np.setdiff1d(negative, positive)
        if not len(positive) or not len(negative):
            break
        by_votes = positive[np.lexsort((positive, -votes))]
        near = np.concatenate([by_votes[: LANDMARKS // 2], rng.permutation(by_votes)[: LANDMARKS // 4]])
        marks = np.unique(np.concatenate([near, rng.permutation(hard)[: LANDMARKS // 4], drawn[: LANDMARKS // 8]]))
        landmarks = take_words(symbols, starts[marks], ends[marks])
        used = np.concatenate([positive, negative])
        kernel, codes, features = _similarities(take_words(symbols, starts[used], ends[used]), landmarks)
        among = features @ features.T
        value, vector = np.linalg.eigh(among.astype(np.float64))
        half = vector * (1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
        x = np.column_stack([kernel @ half, np.ones(len(used))])
        label = np.where(np.arange(len(used)) < len(positive), 1.0, -1.0)
        cost = np.where(label > 0, np.concatenate([votes, np.ones(len(negative))]), 1.0)
        cost[: len(positive)] *= len(negative) / cost[: len(positive)].sum()
        fitted = _machine(x, label, cost)
        weights = ((half @ fitted[:-1]) @ features).astype(np.float32)
        model = Model(codes, weights, float(fitted[-1]), (1.0, 0.0), 0.0)
        table = model.table()
        scores = model.word_scores(table, *words)
    if table is None:
        return constant

    # Documents by their worst words, with the weights that their kinds have among all.
    worst = worst_words(scores[which], rows, len(y))
    cost = np.where(y == 1, rate / max((y == 1).mean(), 1e-9), (1 - rate) / max((y == 0).mean(), 1e-9))
    x, w = np.column_stack([worst, np.ones(len(y))]), np.array([1.0, 0.0, -1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (cost * (p - y)) + 0.02 * w
        w = w - np.linalg.solve(x.T @ (x * (cost * p * (1 - p) + 1e-4)[:, None]) + 0.02 * np.eye(3), slope)
    return Model(model.codes, model.weights, model.bias, (float(w[0]), float(w[1])), float(w[2]))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a sample of the labelled documents, in one task: the sample is bounded. Only
    the labels are sorted; the documents are read for the chosen ids."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .where(fold != 2)
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
    )
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    by_chance = F.xxhash64("doc_id")
    chosen = [
        known.where(f"toxic = {kind}").orderBy(by_chance, "doc_id").limit(bound).select("doc_id", "toxic")
        for kind, bound in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN ids.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    # One row of each id, however many have it.
    sample = (
        docs.select("doc_id", "text")
        .where(F.length("text") <= SAMPLE_CHARS)
        .join(ids, "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("row"), F.first("toxic").alias("toxic"))
        .select("doc_id", "row.text", "toxic")
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))))
        model = train([r[1] for r in rows], [r[2] for r in rows], share)
        values = [model.codes.astype(np.int64).tobytes(), model.weights.tobytes(), model.bias, *model.slopes, model.shift]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["codes", "weights", "bias", "one", "two", "shift"])

    fitted = sample.select("doc_id", "text", "toxic").repartition(1).mapInArrow(
        lean(fit), "codes binary, weights binary, bias double, one double, two double, shift double"
    )
    row = fitted.first()
    if row is None:
        return train([], [], share)
    return Model(
        np.frombuffer(row["codes"], np.int64), np.frombuffer(row["weights"], np.float32),
        row["bias"], (row["one"], row["two"]), row["shift"],
    )


def toxicity(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` (doc_id, text, anything else) with a score between 0 and 1 added; a column
    of that name is replaced. A text without letters, also an empty or null one, scores as
    one whose every word is harmless."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for part in slices(batch, "text"):
                symbols, starts, ends, which, rows = distinct_words(part.column("text"))
                scores = model.word_scores(table, symbols, starts, ends)[which]
                worst = worst_words(scores, rows, part.num_rows)
                chance = pa.array(model.probability(worst), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, chance], [*part.schema.names, name])

    kept = docs.drop(name)
    return kept.mapInArrow(lean(score), T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Learns from labels (doc_id, toxic) outside the held-out fold. Labels that are null or
    contradict each other are left out; without labels of both kinds all documents get
    the share of toxic ones as their score. A null doc_id is scored and not held out.
    """
    model = learn(docs, labels)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
