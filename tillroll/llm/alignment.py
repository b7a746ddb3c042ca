"""Alignment of the tokens of two tokenizers over the same bytes, and how often ids meet.

Each tokenizer says where its tokens lie: character offsets for the byte-level one, spans of
the encoded text for the piece model. Those places cut the text coarsely. Where a character
is shared by several tokens, or a piece is a single byte with an empty span, the decoded
bytes of the tokens tell where they end. Bytes that two tokens share link them; a place
where a token of either side ends closes a group.

No token goes across a place where a space follows a character that is no white space, so
texts fall apart there, and each distinct part of a slice of texts is aligned once, all parts
in a few array operations. The tokenizers read many parts as one text, one behind another where
the text would fall apart again. Documents are lists of parts of their slice. How often two ids meet is counted over the distinct pairs of
a slice, added up over all slices, and goes back to each slice, where the values of its
parts and then of its documents are sums.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import slices, span_hashes, text_bytes
from tillroll.llm.packing import _byte_characters
from tillroll.llm.stages import written

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
MARK = "▁"
ENCODED = 128  # parts that are encoded as one text, at most
_RUN_BITS = 16  # and about 64 KB
_BLOCK_BITS = 18  # about 256 KB of parts are aligned at a time
_SLICE = 8 << 20
_COMPARED = 1 << 16


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)


class Tokens:
    """The tokens of one side for consecutive parts of a text."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, spans: np.ndarray):
        self.ids, self.counts = np.array(ids, np.int64), np.array(counts, np.int64)
        self.spans = spans  # the byte where each token ends in its part, -1 if its span does not say
        self.part = np.repeat(np.arange(len(counts)), self.counts)

    def ends(self, table: np.ndarray, offsets: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte of ``data`` where each token ends, and which parts have all their bytes.

        The spans say where tokens end; in between, the decoded bytes do, and they must fill
        what is between two spans. ``table`` has the bytes of all tokens, that of id i from
        ``offsets[i]`` on; part k is from ``bounds[k]`` on.
        """
        size = offsets[self.ids + 1] - offsets[self.ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        ends = upto[1:] - upto[np.cumsum(self.counts) - self.counts][self.part] + bounds[self.part]
        whole = np.bincount(self.part, size, len(self.counts)).astype(np.int64) == np.diff(bounds)
        whole[self.part[(self.spans >= 0) & (self.spans + bounds[self.part] != ends)]] = False
        some = np.flatnonzero(whole[self.part])
        size = size[some]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = table[np.repeat(offsets[self.ids[some]], size) + inside] == data[np.repeat(ends[some] - size, size) + inside]
        whole[np.repeat(self.part[some], size)[~same]] = False
        return ends, whole


class Parts:
    """Parts of texts in the tokens of both sides: numbers of tokens and groups, the groups as
    text, each with a semicolon behind it, and the links of all parts one after another."""

    def __init__(self, a: Tokens, ends_a: np.ndarray, b: Tokens, ends_b: np.ndarray, whole: np.ndarray, bounds: np.ndarray, names: np.ndarray):
        self.whole, n = whole, len(whole)
        in_a, in_b = whole[a.part], whole[b.part]
        ids_a, ids_b, ends_a, ends_b = a.ids[in_a], b.ids[in_b], ends_a[in_a], ends_b[in_b]
        # The ends of both sides cut the bytes into stretches of one token of each side.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        again = np.append(False, ends[1:] == ends[:-1])[: len(ends)]
        cuts, both = ends[~again], ends[again]
        self.links = ids_b[np.searchsorted(ends_b, cuts)] << 32 | ids_a[np.searchsorted(ends_a, cuts)]

        def count(ends: np.ndarray) -> np.ndarray:
            return np.bincount(np.searchsorted(bounds[1:], ends), minlength=n)

        self.n_a, self.n_b, self.n_groups, self.n_links = map(count, (ends_a, ends_b, both, cuts))
        side = np.concatenate([2 * np.searchsorted(both, ends_a), 2 * np.searchsorted(both, ends_b) + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        mark = np.append(side[1:] != side[:-1], True) * (1 + side % 2)
        written_out = names[mark, np.concatenate([ids_a, ids_b])[order]].tolist()
        bound = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        self.groups = ["".join(written_out[x:y]) for x, y in zip(bound[:-1], bound[1:])]

    @classmethod
    def joined(cls, blocks: list[Parts]) -> Parts:
        """The parts of all blocks, one behind another."""
        out = cls.__new__(cls)
        for c in ("whole", "n_a", "n_b", "n_groups", "n_links", "links"):
            setattr(out, c, np.concatenate([getattr(x, c) for x in blocks]))
        out.groups = list(chain.from_iterable(x.groups for x in blocks))
        return out


class Aligner:
    """Both tokenizers, for texts that begin with a space."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=model)
        others = _byte_characters()
        value = {chr(others.get(byte, byte)): byte for byte in range(256)}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        in_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            in_a[i] = bytes(map(value.get, token))
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.is_byte = np.array([self.b.is_byte(i) for i in range(len(names))])
        in_b = [bytes([int(n[1:-1], 16)]) if byte else n.replace(MARK, " ").encode() for n, byte in zip(names, self.is_byte)]
        self.bytes_a, self.bytes_b = map(self._table, (in_a, in_b))
        ids = range(max(len(in_a), len(in_b)))
        self.names = np.array([[f"{i}{mark}" for i in ids] for mark in ",|;"], object)

    @staticmethod
    def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])

    def parts(self, stretches: list[bytes]) -> Parts:
        """The parts that these stretches of text are, a space in front of each. One whose bytes
        a side does not give back is not whole and has no tokens."""
        block = np.cumsum([len(s) for s in stretches], dtype=np.int64) >> _BLOCK_BITS
        starts = [0, *(1 + np.flatnonzero(block[1:] != block[:-1])).tolist(), len(stretches)]
        return Parts.joined([self._block(stretches[x:y]) for x, y in zip(starts[:-1], starts[1:])])

    def _block(self, stretches: list[bytes]) -> Parts:
        data = np.frombuffer(b"".join(stretches), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in stretches], dtype=np.int64)]).astype(np.int64)
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # the byte of each character
        chars, runs = np.searchsorted(place, bounds), _runs(data, bounds)
        encoded = [self._encode(data, bounds, chars, i, j) for i, j in runs]
        sides = self._sides(encoded, data, bounds, place)
        # What is not given back may have taken bytes of its neighbours, so they are encoded apart.
        lost = [k for k, (i, j) in enumerate(runs) if j - i > 1 and not sides[-1][i:j].all()]
        for k in lost:
            alone = [self._encode(data, bounds, chars, x, x + 1) for x in range(*runs[k])]
            encoded[k] = tuple(map(np.concatenate, zip(*alone)))
        if lost:
            sides = self._sides(encoded, data, bounds, place)
        return Parts(*sides, bounds, self.names)

    def _encode(self, data: np.ndarray, bounds: np.ndarray, chars: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of either side for the stretches from i to j as one text, a row each: id,
        stretch, and where its span starts and ends, in characters or in bytes of ``data``."""
        text = data[bounds[i] : bounds[j]].tobytes().decode()
        e = self.a.encode(text, add_special_tokens=False)
        a = np.empty((len(e), 4), np.int64)
        a[:, 0], a[:, 2:] = e.ids, chars[i] + np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e)).reshape(-1, 2)
        proto = self.b.encode(text[1:], return_type="proto")
        pieces = list(proto.pieces)
        b = np.empty((len(pieces), 4), np.int64)
        b[:, 0], b[:, 3] = [p.id for p in pieces], [p.end for p in pieces]
        b[:1, 2], b[1:, 2] = [p.begin for p in pieces[:1]], b[:-1, 3]  # a span starts where the one before ends
        b[:, 2:] += bounds[i] + 1  # the space in front is in no span
        for side, starts in ((a, chars), (b, bounds)):
            side[:, 1] = i + np.searchsorted(starts[i + 1 : j], side[:, 2], side="right")
        return a, b

    def _sides(self, encoded: list[tuple[np.ndarray, np.ndarray]], data: np.ndarray, bounds: np.ndarray, place: np.ndarray) -> tuple:
        """The tokens of either side, the byte where each ends, and which parts are whole."""
        none, n = np.zeros((0, 4), np.int64), len(bounds) - 1
        a, b = (np.concatenate([none, *(e[k] for e in encoded)]) for k in range(2))
        # A span that the next one overlaps ends inside a character.
        inside = np.append(a[1:, 2] < a[:-1, 3], False)[: len(a)]
        spans_a = np.where(inside, -1, place[a[:, 3]] - bounds[a[:, 1]])
        # Of the bytes of a character the last one has the span.
        spans_b = np.where(self.is_byte[b[:, 0]] & (b[:, 2] == b[:, 3]), -1, b[:, 3] - bounds[b[:, 1]])
        a, b = (Tokens(x[:, 0], np.bincount(x[:, 1], minlength=n), spans) for x, spans in ((a, spans_a), (b, spans_b)))
        ends_a, whole_a = a.ends(*self.bytes_a, data, bounds)
        ends_b, whole_b = b.ends(*self.bytes_b, data, bounds)
        return a, ends_a, b, ends_b, whole_a & whole_b


def _runs(data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """First stretch and the one behind the last of each text that is encoded: stretches go
    together where the text that they make falls apart into them again."""
    apart = np.isin(bounds[:-1], _cuts(data, np.array([0, len(data)])), assume_unique=True)
    block = bounds[:-1] >> _RUN_BITS
    first = ~apart | (np.arange(len(apart)) % ENCODED == 0) | np.append(True, block[1:] != block[:-1])[: len(block)]
    starts = np.flatnonzero(first)
    return list(zip(starts.tolist(), np.append(starts[1:], len(apart)).tolist()))


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts fall apart: at spaces that have a character that is no white space before
    them and some character behind them."""
    at = np.flatnonzero(data == 32)
    inside = np.ones(len(data) + 1, bool)
    inside[offsets] = False
    at = at[inside[at] & inside[at + 1]]
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    wide |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    wide |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    wide |= (three == 0xE2) & (two == 0x81) & (one == 0x9F)
    wide |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    return at[(one > 32) & ~((one >= 128) & wide)]


def stretches(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct stretches of a slice of texts with a space before each text; which one
    each is, in order; and for each row where its stretches start."""
    data, offsets = text_bytes(column)
    own = offsets[1:] > offsets[:-1]
    data = np.insert(data, offsets[:-1][own], 32)
    offsets = offsets + np.concatenate([[0], np.cumsum(own)])
    starts = np.sort(np.concatenate([offsets[:-1][own], _cuts(data, offsets)]), kind="stable")
    ends, raw = np.append(starts[1:], len(data))[: len(starts)], data.tobytes()
    _, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    # Equal hashes, equal bytes: each stretch is held against the one that stands for it.
    size, ahead = ends - starts, starts[where][which] - starts
    same = (size == size[where][which]).all()
    for k in range(0, len(starts), _COMPARED):  # a few at a time, as each byte takes many here
        some = slice(k, k + _COMPARED)
        own_bytes = np.arange(starts[some][0], ends[some][-1])
        same = same and (data[own_bytes + np.repeat(ahead[some], size[some])] == data[own_bytes]).all()
    if not same:
        index: dict[bytes, int] = {}
        which = np.array([index.setdefault(raw[a:b], len(index)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
        return list(index), which, np.searchsorted(starts, offsets)
    distinct = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())]
    return distinct, which, np.searchsorted(starts, offsets)


def _sums(values: np.ndarray, which: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each row, bounded in ``which``, the sum of the values it names."""
    upto = np.concatenate([[0], np.cumsum(values[which], dtype=np.int64)])
    return upto[bounds[1:]] - upto[bounds[:-1]]


_ROW = pa.schema(
    [
        ("slice", pa.int64()),
        ("is_doc", pa.bool_()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("parts", pa.list_(pa.int32())),  # of a document; of a slice, how many links each part has
        ("links", pa.list_(pa.int32())),  # of a slice: the pairs of its parts, by place
        ("pairs", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_ROW_SQL = (
    "slice long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "parts array<int>, links array<int>, pairs array<bigint>, counts array<bigint>"
)
_RESULT = [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())]
_RESULT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _aligned(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """A row for each document, with the parts it is made of, and one for each slice, with the
    links of all its parts and how often each pair of ids is linked."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, number = Aligner(*files.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in slices(batch, "text", _SLICE):
                texts, which, bounds = stretches(piece.column("text"))
                parts = aligner.parts(texts)
                n, length = piece.num_rows, bounds[1:] - bounds[:-1]
                whole = (length > 0) & (_sums(~parts.whole, which, bounds) == 0)
                digests, groups = [""] * n, parts.groups
                for row in np.flatnonzero(whole).tolist():
                    joined = "".join([groups[k] for k in which[bounds[row] : bounds[row + 1]].tolist()])
                    digests[row] = hashlib.sha256(joined[:-1].encode()).hexdigest()
                values = {c: np.where(whole, _sums(getattr(parts, c), which, bounds), 0) for c in ("n_a", "n_b", "n_groups", "n_links")}
                used = which[np.repeat(whole, length)]
                yield _batch(
                    slice=pa.array(np.full(n, number)),
                    is_doc=pa.array(np.ones(n, bool)),
                    doc_id=piece.column("doc_id"),
                    **{c: pa.array(v) for c, v in values.items()},
                    groups_sha256=pa.array(digests, pa.string()),
                    parts=_lists(used.astype(np.int32), np.where(whole, length, 0)),
                )
                pairs, place = np.unique(parts.links, return_inverse=True)
                times = np.bincount(used, minlength=len(texts))
                counts = np.bincount(place, np.repeat(times, parts.n_links), minlength=len(pairs)).astype(np.int64)
                one = lambda x: _lists(x, [len(x)])
                yield _batch(
                    slice=pa.array([number]),
                    is_doc=pa.array([False]),
                    parts=one(parts.n_links.astype(np.int32)),
                    links=one(place.astype(np.int32)),
                    pairs=one(pairs),
                    counts=one(counts),
                )
                number += 1

    files = docs.sparkSession.sparkContext.broadcast((definition, model))
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(align, _ROW_SQL)


def _lists(values: np.ndarray, sizes) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    n = len(columns["slice"])
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in _ROW], schema=_ROW)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how often two ids are linked in all documents, and whether no other
    id is linked more often with the second one."""
    found = aligned.where("not is_doc").select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    totals = written(found.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n")).where("n > 0"), "pairs")
    side_b = F.shiftright("pair", 32)
    most = totals.groupBy(side_b.alias("b")).agg(F.max("n").alias("most"))
    return totals.join(most, side_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, byte_tokenizer: str | None = None, piece_model: str | None = None) -> DataFrame:
    """The alignment of two tokenizers over every row of ``docs`` (doc_id, text, anything else).

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: tokens of
    either side, groups of tokens that end together, links between tokens that share bytes,
    those of them whose pair of ids no other first id exceeds for the second, the sum of
    the pairs' counts in all documents, and a digest of the groups. A text that is null or
    empty, or whose bytes a tokenizer does not give back, has no tokens: zeros and an empty
    digest, and it counts for no pair. Rows of equal or null doc_id are documents of their
    own. No rows give no rows.

    The arguments are the files of a byte-level tokenizer without a normalizer and of a BPE
    piece model with byte fallback that adds a space before the text.
    """
    default_a, default_b = (byte_tokenizer, piece_model) if byte_tokenizer and piece_model else default_files()
    with open(byte_tokenizer or default_a, encoding="utf-8") as a, open(piece_model or default_b, "rb") as b:
        definition, model = a.read(), b.read()
    aligned = written(_aligned(docs, definition, model), "aligned")
    of_slices = aligned.where("not is_doc").select(F.col("slice").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    known = of_slices.join(pair_counts(aligned), "pair").select("of", "place", "n", "best")

    def total(rows: pa.Table, looked: pa.Table) -> pa.Table:
        is_doc = rows["is_doc"]
        docs, own = rows.filter(is_doc), rows.filter(pa.compute.invert(is_doc))
        flat = lambda column: column.combine_chunks().flatten().to_numpy()
        sizes, links = flat(own["parts"]), flat(own["links"])
        place, bounds = looked["place"].to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
        which = flat(docs["parts"])
        ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(docs["parts"]).to_numpy())])
        out = {}
        for name, source in (("n_best", "best"), ("count_sum", "n")):
            by_place = np.zeros(len(links) + 1, np.int64)  # at least as many as places
            by_place[place] = looked[source].to_numpy()
            out[name] = pa.array(_sums(_sums(by_place, links, bounds), which, ends))
        return pa.table([out.get(n, docs[n] if n in docs.column_names else None) for n, _ in _RESULT], schema=pa.schema(_RESULT))

    columns = ["slice", "is_doc", *(n for n, _ in _RESULT if n not in ("n_best", "count_sum")), "parts", "links"]
    return aligned.select(*columns).groupBy("slice").cogroup(known.groupBy("of")).applyInArrow(total, _RESULT_SQL)
