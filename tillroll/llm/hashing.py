"""Words of UTF-8 texts as 64-bit numbers, one Arrow column slice at a time.

Everything here works on the bytes of many texts at once and holds a few arrays of
the slice's size; ``slices`` bounds that size. A single text larger than the bound
makes a slice of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 4 << 20
LONG_WORD = 4096

_byte = np.arange(256, dtype=np.uint8)
SPACE = np.isin(_byte, np.frombuffer(b" \t\n\v\f\r", np.uint8))
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts have at most ``limit`` bytes together."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    upto, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        base = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts and ends. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: a run of bytes outside ``apart`` within a row."""
    inside = ~apart[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    out = mix(left.astype(U) + U(0x9E3779B97F4A7C15))
    todo, at = np.flatnonzero((left > 0) & (left <= LONG_WORD)), 0
    while len(todo):
        part = eight[starts[todo] + at] & _MASK[np.minimum(left[todo] - at, 8)]
        out[todo] = mix(out[todo] * U(0xD6E8FEB86659FD93) + part)
        at += 8
        todo = todo[left[todo] > at]
    for i in np.flatnonzero(left > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = U(int.from_bytes(digest, "little"))
    return out


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and for each row where its words start."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    return span_hashes(data, starts, ends), bounds


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each position on; the last n - 1 run past the end."""
    wide = np.concatenate([words, np.zeros(n - 1, U)])
    out = mix(words + U(n))
    for k in range(1, n):
        out = mix(out * U(0xD6E8FEB86659FD93) + wide[k : k + len(words)])
    return out


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each row its sorted distinct n-word shingles; fewer words count as one shingle."""
    words, bounds = word_hashes(column)
    grams = ngrams(words, n)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield ngrams(words[a:b], b - a)[:1]
        else:
            yield words[:0]
