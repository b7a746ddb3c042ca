"""Cost-balanced packing of documents into training sequences.

A document becomes token ids and an end id. What fills whole sequences is cut off; what
is left of each document is packed: longest first, each to the sequence of the lowest
attention cost so far (linear plus quadratic in the length of each piece) that still has
room. Where no sequence has room for all of it, it is cut to fill one.

Documents are dealt to packs of about ``PACK`` pieces by their place in the input, so
packs are even whatever the ids and texts. A pack has as many sequences as its tokens
fill, so it loses less than one sequence to padding.
"""

from __future__ import annotations

import array
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.hashing import slices, span_hashes, text_bytes, word_spans
from tillroll.llm.stages import lean

SEQUENCE = 4096
PACK = 8_192
END_ID = 2
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
TOKENIZER = "word_bpe_49k.json"
_SLICE = 4 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def cost(tokens: int) -> float:
    """Of a piece that attends to itself only."""
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def _byte_characters() -> dict[int, int]:
    """Byte-level tokenizers write a byte as a character: a printable one as itself, the
    others as those from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


class WordTokens:
    """Token ids of texts, for a byte-level tokenizer that lowers case and drops white space.

    Words are encoded apart, each distinct word of a slice once. A word of ASCII and of
    Western letters is split here, and its parts go to the tokenizer's model; any other
    goes through the whole tokenizer.
    """

    KNOWN = 300_000  # parts whose ids are remembered; then it starts anew

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        letters = "a-z\u00df-\u00f6\u00f8-\u00ff"
        self.simple = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
        self.parts = re.compile(f"[{letters}]+|[0-9]|[^{letters}0-9]+").findall
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        self.characters = _byte_characters()
        self.known: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            if len(self.known) >= self.KNOWN:
                self.known.clear()
            as_bytes = part if part.isascii() else part.encode().decode("latin-1").translate(self.characters)
            ids = self.known[part] = array.array("I", [t.id for t in self.model.tokenize(as_bytes)]).tobytes()
        return ids

    def word(self, word: str) -> bytes:
        """The ids of a word as 32-bit numbers."""
        if word.isascii() and word.isalpha():
            return self.part(word.lower())
        if not self.simple(word) or self.special(word):
            return array.array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.part, self.parts(word.lower())))

    def ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        data, offsets = text_bytes(column)
        starts, ends, rows = word_spans(data, offsets)
        _, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        found = [self.word(raw[a:b].decode()) for a, b in zip(starts[where].tolist(), ends[where].tolist())]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        firsts = np.cumsum(sizes) - sizes
        bounds = np.searchsorted(rows, np.arange(len(offsets)))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = which[a:b]
            count = sizes[own]
            stops = np.cumsum(count)
            total = int(stops[-1]) if b > a else 0
            place = np.arange(total) + np.repeat(firsts[own] - stops + count, count)
            yield np.append(flat[place], np.uint32(END_ID))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_PIECE_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(sizes: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Place pieces of these sizes: (piece, start in it, length, sequence, offset).

    Sequences of the same room wait in one heap by cost, so finding the cheapest one with
    enough room looks at ``capacity`` heaps through a tree of minima, not at all sequences.
    """
    count = -(-int(sizes.sum()) // capacity)
    leaves = 1 << capacity.bit_length()
    heaps: list[list] = [[] for _ in range(capacity + 1)]
    heaps[capacity] = [(0.0, s) for s in range(count)]
    none = (float("inf"), -1)
    tree = [none] * (2 * leaves)

    def refresh(room: int) -> None:
        at = leaves + room
        tree[at] = heaps[room][0] if heaps[room] else none
        while at > 1:
            at //= 2
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def cheapest(room: int) -> tuple:
        """Of the sequences with at least this room: cost, sequence, leaf."""
        at, best, where = leaves + room, none, 0
        low, high = at, 2 * leaves
        while low < high:
            if low & 1:
                if tree[low] < best:
                    best, where = tree[low], low
                low += 1
            low //= 2
            high //= 2
        while where and where < leaves:
            where = 2 * where if tree[2 * where] == best else 2 * where + 1
        return (*best, where - leaves)

    refresh(capacity)
    out = []
    for piece in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        start, left = 0, int(sizes[piece])
        while left:
            spent, sequence, room = cheapest(left)
            if sequence < 0:
                spent, sequence, room = cheapest(1)
            take = min(left, room)
            heapq.heappop(heaps[room])
            refresh(room)
            out.append((piece, start, take, sequence, capacity - room))
            if room > take:
                heapq.heappush(heaps[room - take], (spent + cost(take), sequence))
                refresh(room - take)
            start, left = start + take, left - take
    return out


def pack_documents(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text, anything else) and where they are packed.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: each token of a
    document with its end id lies in one piece; the pieces of a sequence follow each other
    without a gap and hold ``sequence`` tokens at most. A null or empty text is the end id
    alone. Rows of equal or null doc_id are documents of their own. No rows, no pieces.

    ``tokenizer`` is the file of a tokenizer that drops white space.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    packs = max(1, -(-docs.count() // PACK))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part, place = WordTokens(definition.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "text", _SLICE):
                out: list[tuple] = []
                for doc, ids in zip(piece.column("doc_id").to_pylist(), words.ids(piece.column("text"))):
                    for start in range(0, len(ids), sequence):
                        some = ids[start : start + sequence]
                        whole = len(some) == sequence
                        out.append(
                            (
                                (part * 7919 + place) % packs,
                                doc,
                                start,
                                len(some),
                                crc(some),
                                len(ids),
                                2 * ((part << 40) + place) + 1 if whole else None,
                                None if whole else some.astype("<u4").astype(small).tobytes(),
                            )
                        )
                        place += 1
                for k in range(0, len(out), 4_096):
                    columns = zip(*out[k : k + 4_096])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["pack", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "ids"]
    types = [pa.int64()] * 7 + [pa.binary()]
    small = "<u2" if WordTokens(definition.value).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def place(key: tuple, pieces: pa.Table) -> pa.Table:
        whole = pieces.filter(pa.compute.is_valid(pieces["sequence_id"]))
        rest = pieces.filter(pa.compute.is_null(pieces["sequence_id"]))
        # By what the pieces are, not by the order in which they came.
        rest = rest.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        doc, start, total, ids = (rest[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        out = []
        for piece, begin, take, number, offset in pack(rest["length"].to_numpy(), sequence):
            own = np.frombuffer(ids[piece], small)[begin : begin + take]
            number = 2 * ((key[0].as_py() << 40) + number)
            out.append((doc[piece], start[piece] + begin, take, crc(own), total[piece], number, offset))
        columns = zip(*out) if out else [[]] * 7
        packed = pa.table([pa.array(c, t) for c, t in zip(columns, _PIECE.types)], schema=_PIECE)
        whole = whole.select(_PIECE.names[:-1]).append_column("offset", pa.array(np.zeros(whole.num_rows, np.int64)))
        return pa.concat_tables([packed, whole.cast(_PIECE)])

    source = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    schema = "pack long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, ids binary"
    return source.mapInArrow(lean(cut), schema).groupBy("pack").applyInArrow(place, _PIECE_SQL)
