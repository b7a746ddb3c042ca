"""Token counts of a unigram vocabulary, without making the tokens.

Aho-Corasick finds every piece of the vocabulary in a word; dynamic programming carries,
for each place, the best score of a path to it and how many tokens that path has. The
rules are those of unigram tokenizers: a path is better only if its score is higher, so
of equal paths that whose last piece starts earlier stays; a character that is no piece
costs ten more than the worst piece and counts as its bytes.

A space is the piece mark, and one is put before each text. No piece has the mark behind
another character and none has tabs or line feeds, so texts fall apart there, and each
distinct word of a slice is counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillroll.llm.hashing import slices, span_hashes, text_bytes

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MODEL = "piece_bpe_32k.model"
KNOWN = 300_000  # words whose counts a task remembers; then it starts anew

_byte = np.arange(256)
_OTHER_SPACE = np.isin(_byte, [9, 10])  # in no piece


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def vocabulary(model: str) -> dict[str, float]:
    """Pieces and scores of a piece model's file, the piece mark as a space."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    return {pieces.id_to_piece(i).replace(MARK, " "): pieces.get_score(i) for i in range(pieces.get_piece_size())}


class Counter:
    """Best score and number of tokens of words."""

    def __init__(self, scores: dict[str, float]):
        import ahocorasick

        inside = [p for p in scores if " " in p.lstrip(" ") or any(c in p for c in "\t\n")]
        if inside:
            raise ValueError(f"pieces that go across words: {inside[:3]}")
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.pieces = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()

    def count(self, word: str) -> int:
        best, tokens, at, single = [0.0], [0], 0, False
        top, number = None, 0

        def close() -> None:
            """The place behind character ``at``: its own character alone, if that is no piece."""
            nonlocal top, number, single, at
            if not single:
                alone = best[at] + self.unknown
                if top is None or alone > top:
                    top, number = alone, tokens[at] + len(word[at].encode())
            best.append(top)
            tokens.append(number)
            top, number, single, at = None, 0, False, at + 1

        for end, (size, score) in self.pieces.iter(word):  # by end, the longest first
            while at < end:
                close()
            start = end + 1 - size
            path = best[start] + score
            if top is None or path > top:
                top, number = path, tokens[start] + 1
            single = single or size == 1
        while at < len(word):
            close()
        return tokens[-1]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a slice with a space before each text; start, end and row of each word with
    the spaces before it; for each row how many tabs and line feeds it has."""
    column = column.cast(pa.large_string()).fill_null("")
    column = pc.replace_substring(column, MARK, " ")
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    marked = pc.if_else(pc.equal(column, nothing), nothing, pc.binary_join_element_wise(space, column, nothing))
    data, offsets = text_bytes(marked)
    other = _OTHER_SPACE[data]
    space = data == 32
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets] = True
    first = ~other
    first[1:] &= begin[1:-1] | other[:-1] | (space[1:] & ~space[:-1])
    starts = np.flatnonzero(first)
    stop = np.concatenate([first, [True]]) | np.concatenate([other, [True]]) | begin
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    upto = np.concatenate([[0], np.cumsum(other)])
    return data, starts, ends, rows, upto[offsets[1:]] - upto[offsets[:-1]]


def token_counts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_tokens`` for every row of ``docs`` (doc_id, text, anything else).

    A null or empty text has no tokens. Rows of equal or null doc_id are counted apart.
    ``model`` is the file of a piece model whose pieces and scores are the vocabulary.
    """
    scores = docs.sparkSession.sparkContext.broadcast(vocabulary(model or default_model()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = Counter(scores.value), {}
        for batch in batches:
            for part in slices(batch, "text"):
                data, starts, ends, rows, others = words_of(part.column("text"))
                hashes, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                raw = data.tobytes()
                sizes = np.zeros(len(where), np.int64)
                if len(known) > KNOWN:
                    known.clear()
                for i, (a, b) in enumerate(zip(starts[where].tolist(), ends[where].tolist())):
                    word = raw[a:b]
                    size = known.get(word)
                    if size is None:
                        size = known[word] = counter.count(word.decode())
                    sizes[i] = size
                total = np.bincount(rows, sizes[which], part.num_rows).astype(np.int64) + others
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(total, pa.int64())], ["doc_id", "n_tokens"])

    source = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return source.mapInArrow(count, "doc_id long, n_tokens long")
