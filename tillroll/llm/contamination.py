"""Benchmark passages in training documents: n-gram seeds, then Smith-Waterman.

All n-grams of a test item are its seeds, however many documents have them: what many
documents kept of an edited item is common. Documents are scanned for seeds. Where one
shares enough of them with an item, as far as an alignment reaches, the passage around
them is aligned with it: a copy with words changed, dropped or put in keeps most of the
item's score.

Words are runs of letters and digits, or single characters in scripts without spaces;
their case does not count. The test items are a
query set: tasks get them in blocks of bounded size, one scan for each block.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import LOWER, SPACE, ngrams, slices, span_hashes, text_bytes
from tillroll.llm.stages import lean, written

GRAM = 3
BLOCK = 1_000_000  # words of test items that a scan is sent, about
PAIRS = 1 << 20  # of seeds and items that are looked at together
CELLS = 1 << 16  # words of passages that are aligned together
SEEDS = 2  # that a passage must share with an item; one if the item has only one
THRESHOLD = 0.5  # of the score of the whole item
MATCH, MISMATCH, GAP = 2, -1, -1

_byte = np.arange(256)
_APART = SPACE | ((_byte < 128) & ~np.isin(_byte, [*range(48, 58), *range(65, 91), *range(97, 123)]))
# Letters of scripts that put no space between words: each is a word of its own.
_UNSPACED = [
    (0x0E01, 0x0E4E), (0x0E81, 0x0ECE), (0x0EDC, 0x0EDF), (0x1000, 0x103F), (0x1050, 0x108F), (0x109A, 0x109F),
    (0x1780, 0x17D3), (0x1950, 0x19DF), (0x1A20, 0x1A7F), (0x1B00, 0x1B4F), (0x2E80, 0x2FDF), (0x3005, 0x3007),
    (0x3021, 0x302F), (0x3031, 0x3035), (0x3038, 0x303C), (0x3041, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0xA48C), (0xA980, 0xA9C0), (0xA9E0, 0xA9EF), (0xA9FA, 0xA9FE), (0xAA60, 0xAADF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
]
_JOINERS = (0xAD, 0x200C, 0x200D)  # inside words


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The code points where another kind of character begins, and the kinds: 0 in words, 1
    between them, 2 a word of its own."""
    kinds = np.zeros(0x110000, np.uint8)
    for first, last in _UNSPACED:
        kinds[first : last + 1] = 2
    for point in [*range(0x40000), *range(0xE0000, 0xE1000)]:
        kind = unicodedata.category(chr(point))
        if kind[0] in "ZPS" or kind == "Cc" or kind == "Cf" and point not in _JOINERS:
            kinds[point] = 1
    starts = np.flatnonzero(np.diff(kinds, prepend=255))
    return starts, kinds[starts]


_STARTS, _KINDS = _kinds()


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of UTF-8 texts."""
    apart = _APART[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at]
    # Of a text cut within a character, what is there.
    size = np.minimum(2 + (lead >= 0xE0) + (lead >= 0xF0), len(data) - at)
    # Five, four or three low bits of the lead byte, then six of each that follows.
    point = (lead & (0xFF >> (size + 1)).astype(np.uint8)).astype(np.int64)
    for k in range(1, 4):
        more = size > k
        point[more] = point[more] << 6 | data[at[more] + k] & 0x3F
    kind = _KINDS[np.searchsorted(_STARTS, point, side="right") - 1]
    for k in range(4):
        apart[at[(kind == 1) & (size > k)] + k] = True
    alone = kind == 2
    edge[at[alone]] = True
    edge[at[alone] + size[alone]] = True
    first, last = ~apart, ~apart
    first[1:] &= apart[:-1] | edge[1:-1]
    last[:-1] &= apart[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def passage_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and for each row where its words start."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    # Two-byte Latin letters: upper and lower case are 32 apart.
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[upper] += 32
    starts, ends, rows = word_places(data, offsets)
    return span_hashes(data, starts, ends), np.searchsorted(rows, np.arange(len(offsets)))


def row_grams(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that lie in one row, and their places."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.flatnonzero(rows[n - 1 :] == rows[: len(rows) - n + 1]) if len(rows) >= n else np.zeros(0, np.int64)
    return ngrams(words, n)[place], place


class Grams:
    """A set of n-grams that finds its members in an array."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.unique(grams.astype(np.int64).view(np.uint64))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.grams >> np.uint64(44)).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are members, and which members they are."""
        some = np.flatnonzero(self.maybe[(values >> np.uint64(44)).astype(np.int64)])
        if not len(some):
            return some, some
        place = np.minimum(np.searchsorted(self.grams, values[some]), len(self.grams) - 1)
        same = self.grams[place] == values[some]
        return some[same], place[same]


class Items:
    """Test items, looked up by their seeds: ``holders[first[g] : first[g + 1]]`` have gram g."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.sizes = np.array([len(w) for w in words], np.int64)
        # An item of fewer words is a seed as a whole.
        spans = np.minimum(self.sizes, GRAM)
        self.spans = np.unique(spans).tolist()
        grams = [np.unique(ngrams(w, n)[: len(w) - n + 1]) for w, n in zip(words, spans.tolist())]
        counts = np.array([len(g) for g in grams], np.int64)
        every = np.concatenate(grams)
        self.grams = Grams(every)
        gram = np.searchsorted(self.grams.grams, every)
        order = np.argsort(gram, kind="stable")
        self.holders = np.repeat(np.arange(len(words)), counts)[order]
        self.first = np.searchsorted(gram[order], np.arange(len(self.grams.grams) + 1))
        self.enough = np.minimum(counts, SEEDS)

    def passages(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """``row, item, low, high``: where a row shares enough seeds with an item. No alignment
        that reaches half of an item's score is longer than twice the item, so seeds that are
        farther apart count apart, and a passage goes so far beyond its first and last seed."""
        hits = []
        for n in self.spans:
            found, place = row_grams(words, bounds, n)
            hit, gram = self.grams.places(found)
            hits.append((place[hit], gram))
        at, gram = (np.concatenate(x) for x in zip(*hits))
        order = np.argsort(at, kind="stable")
        at, gram = at[order], gram[order]
        rows = np.searchsorted(bounds, at, side="right") - 1
        many = self.first[gram + 1] - self.first[gram]
        upto = np.cumsum(many)
        ends = np.append(np.flatnonzero(np.diff(rows)) + 1, len(rows)) if len(rows) else rows
        start = 0
        while start < len(rows):
            # Whole rows, of at most PAIRS pairs of a seed and an item if they are several.
            limit = (upto[start - 1] if start else 0) + PAIRS
            stop = ends[max(np.searchsorted(ends, start, side="right"), np.searchsorted(upto[ends - 1], limit, side="right") - 1)]
            some = np.repeat(np.arange(start, stop), many[start:stop])
            nth = np.arange(len(some)) - np.repeat(upto[start:stop] - many[start:stop] - (upto[start - 1] if start else 0), many[start:stop])
            item = self.holders[self.first[gram[some]] + nth]
            order = np.lexsort((at[some], item, rows[some]))
            some, item = some[order], item[order]
            new = np.ones(len(some), bool)
            new[1:] = (np.diff(rows[some]) != 0) | (np.diff(item) != 0) | (np.diff(at[some]) > 2 * self.sizes[item[1:]])
            passage = np.cumsum(new) - 1
            # Distinct seeds of each passage.
            pair = np.lexsort((gram[some], passage))
            fresh = np.ones(len(pair), bool)
            fresh[1:] = (np.diff(passage[pair]) != 0) | (np.diff(gram[some][pair]) != 0)
            shared = np.bincount(passage[pair][fresh])
            opens = np.flatnonzero(new)
            last = np.append(opens[1:], len(some)) - 1
            keep = shared >= self.enough[item[opens]]
            opens, last = opens[keep], last[keep]
            row, item = rows[some][opens], item[opens]
            low = np.maximum(bounds[row], at[some][opens] - 2 * self.sizes[item])
            high = np.minimum(bounds[row + 1], at[some][last] + GRAM + 2 * self.sizes[item])
            yield row, item, low, high
            start = stop


def item_words(items: DataFrame) -> DataFrame:
    """``item_id, words``: of each test item that has a word, in order."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, bounds = passage_words(part.column("text"))
                lists = pa.array([words[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("item_id"), lists], ["item_id", "words"])

    source = items.where("item_id is not null").selectExpr("cast(item_id as long) item_id", "text")
    return source.mapInArrow(lean(build), "item_id long, words array<bigint>").where(F.size("words") > 0)


def _blocks(items: DataFrame) -> Iterator[Items]:
    """The test items in blocks of about BLOCK words; all seeds of an item are in one block."""
    count = max(1, -(-(items.agg(F.sum(F.size("words"))).first()[0] or 0) // BLOCK))
    for k in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(count)) == k).toArrow().combine_chunks()
        if own.num_rows:
            words = [np.asarray(x.values, np.int64).view(np.uint64) for x in own["words"]]
            yield Items(own["item_id"].to_numpy(), words)


def alignment(item: np.ndarray, passage: np.ndarray) -> int:
    """The best local alignment's score; gaps cost the same for every word."""
    place = np.arange(1, len(passage) + 1)
    above = np.zeros(len(passage) + 1, np.int64)
    best = 0
    for word in item:
        step = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        step = np.maximum(step, 0)
        # A gap along the passage: the best start to the left, less its length.
        row = np.maximum.accumulate(step - GAP * place) + GAP * place
        above = np.concatenate([[0], row])
        best = max(best, int(row.max(initial=0)))
    return best


def alignments(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """``alignment`` of many pairs at once."""
    wide, long = max(map(len, passages)), max(map(len, items))
    # What fills up the shorter ones equals nothing, so it adds to no score.
    known, text = np.zeros((long, len(items)), np.uint64), np.zeros((len(items), wide), np.uint64)
    for k, (item, passage) in enumerate(zip(items, passages)):
        known[: len(item), k], text[k, : len(passage)] = item, passage
    filled = np.arange(wide) < np.array([len(x) for x in passages])[:, None]
    sizes = np.array([len(x) for x in items])
    place = np.arange(1, wide + 1, dtype=np.int32)
    above, best = np.zeros((len(items), wide + 1), np.int32), np.zeros(len(items), np.int32)
    for n, word in enumerate(known):
        same = (text == word[:, None]) & filled & (n < sizes)[:, None]
        step = np.maximum(above[:, :-1] + np.where(same, np.int32(MATCH), np.int32(MISMATCH)), above[:, 1:] + np.int32(GAP))
        step = np.maximum(step, 0)
        above[:, 1:] = np.maximum.accumulate(step - np.int32(GAP) * place, axis=1) + np.int32(GAP) * place
        best = np.maximum(best, above.max(axis=1))
    return best


def _scored(docs: DataFrame, items: Items) -> DataFrame:
    """``key, item_id, score`` of the passages of documents that share enough seeds with an item."""
    wanted = docs.sparkSession.sparkContext.broadcast(items)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        for batch in batches:
            for part in slices(batch, "text"):
                words, bounds = passage_words(part.column("text"))
                keys = part.column("key").to_numpy()
                for row, item, low, high in known.passages(words, bounds):
                    order = np.lexsort((known.sizes[item], high - low))
                    row, item, low, high = row[order], item[order], low[order], high[order]
                    start = 0
                    while start < len(row):
                        # Like sizes together; the widest passage is the last one.
                        ends = np.minimum(start + 256, len(row))
                        stop = start + max(1, int(np.searchsorted((high - low)[start:ends] * np.arange(1, ends - start + 1), CELLS, side="right")))
                        own = [known.words[i] for i in item[start:stop]]
                        best = alignments(own, [words[a:b] for a, b in zip(low[start:stop], high[start:stop])])
                        share = best / (MATCH * known.sizes[item[start:stop]])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[row[start:stop]]), pa.array(known.ids[item[start:stop]], pa.int64()), pa.array(share, pa.float64())],
                            ["key", "item_id", "score"],
                        )
                        start = stop

    return docs.select("key", "text").mapInArrow(lean(score), "key long, item_id long, score double")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key, item_id, score`` of the best aligned item of each document that shares enough
    seeds with one. ``docs`` has ``key, text``; ``benchmark`` has ``item_id, text``."""
    items = written(item_words(benchmark), "items")
    scored = [_scored(docs, block) for block in _blocks(items)]
    if not scored:
        return docs.sparkSession.createDataFrame([], "key long, item_id long, score double")
    best = F.max(F.struct("score", (-F.col("item_id")).alias("first")))
    return (
        reduce(DataFrame.unionByName, scored)
        .groupBy("key")
        .agg(best.alias("best"))
        .select("key", (-F.col("best.first")).alias("item_id"), F.col("best.score").alias("score"))
    )


def row_key() -> Column:
    """What tells a document: rows of the same id and text are judged alike."""
    return F.xxhash64("doc_id", "text")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, item_id, score`` for every row of ``docs`` (doc_id, text,
    anything else).

    The score is that of the best alignment with a test item, as a share of what the whole
    item would score, and null with the item where no passage shares enough seeds with one.
    From THRESHOLD on the document is contaminated. Items with a null id or without a
    word, and null or empty texts, match nothing; an item of one or two words matches where
    a text has them in order. Of equal scores the smallest item
    counts. Repeated items count once. Empty tables give no rows or no contamination.
    """
    keyed = docs.select("doc_id", "text", row_key().alias("key"))
    found = leaks(keyed, benchmark.dropDuplicates(["item_id", "text"]))
    return keyed.select("doc_id", "key").join(found, "key", "left").select(
        "doc_id", F.coalesce(F.col("score") >= THRESHOLD, F.lit(False)).alias("contaminated"), "item_id", "score"
    )
