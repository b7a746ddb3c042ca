"""Similarity join on word shingles: prefix filters under several global token orders.

Two sets with a Jaccard similarity of at least t share k tokens among the first
``n - ceil(t n) + k`` tokens of either one, whatever the order of the tokens. So a pair
must pass that test under each of several orders. The first order makes the candidates:
the prefixes are dealt out by token, and each pair's shared tokens are counted. The other
orders then test each candidate, before the whole sets are compared.

Every order puts the corpus's commonest shingles last and breaks ties by a hash of its
own: passages that many documents share stay out of the prefixes unless a document is
made of little else. Which shingles are common is counted over all documents; a shingle
missing there costs time, never a result.

Documents with equal sets are one node. A group of near copies is not joined pair by
pair: each token's documents are first compared with a few of them, then, for what this
leaves apart, with a few others, and only documents that are still in different components
are compared with each other. Links inside a component change nothing. So all links that
matter are found, and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.hashing import U, mix, shingle_sets, slices
from tillroll.llm.stages import lean, written

COMMON = 100_000  # shingles whose frequency class the orders know; bounds what tasks are sent
LOCAL_COUNT = 3  # a shingle is counted where so many documents of one slice have it
COUNT_SLICE = 8 << 20
ORDERS = 3
HUBS = (4, 8)  # documents of a token that its others are compared with, in each round
NAMED_BITS = 1 << 25  # of a bitmap of documents, 4 MB whatever their number; marks shared by two cost time, never a result
_BITMAP = 1 << 15  # bits in a row of it, as Spark's bitmap aggregate makes them
PREFIX_SHARED = 3  # k above; less where the smallest sets that can link share less
_CLASSES = 8
_SALTS = tuple(U(0x9E3779B97F4A7C15 * (k + 1) % 2**64) for k in range(ORDERS))
_LONG = pa.list_(pa.int64())


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), _as_long(flat))


def _set_rows(docs: DataFrame, words: int) -> DataFrame:
    """For each document its set's size and 128-bit signature (common = false), and shingles
    that several documents of a slice have, with their number (common = true)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", COUNT_SLICE):
                sets = list(shingle_sets(part.column("text"), words))
                size = np.array([len(s) for s in sets], np.int64)
                one = np.array([mix(s ^ U(1)).sum(dtype=np.uint64) for s in sets], np.uint64)
                two = np.array([mix(s ^ U(2)).sum(dtype=np.uint64) for s in sets], np.uint64)
                tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
                often = counts >= LOCAL_COUNT
                n, m = len(sets), int(often.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([False, True], [n, m])),
                        pa.concat_arrays([part.column("doc_id"), pa.nulls(m, pa.int64())]),
                        pa.array(np.concatenate([size, counts[often]])),
                        _as_long(np.concatenate([one, tokens[often]])),
                        _as_long(np.concatenate([two, np.zeros(m, np.uint64)])),
                    ],
                    ["common", "doc_id", "n", "one", "two"],
                )

    return docs.mapInArrow(lean(describe), "common boolean, doc_id long, n long, one long, two long")


class TokenOrder:
    """Keys that put tokens into global orders, the commonest ones last."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by_token = np.argsort(tokens)
        self.tokens = tokens[by_token]
        classes = 1 + np.log2(np.maximum(counts[by_token], 1)).astype(np.int64) // 2
        self.classes = np.minimum(classes, _CLASSES - 1).astype(np.uint64)

    def maybe(self) -> np.ndarray:
        """A quick test by a token's upper 20 bits."""
        out = np.zeros(1 << 20, bool)
        out[(self.tokens >> U(44)).astype(np.int64)] = True
        return out

    def keys(self, tokens: np.ndarray, maybe: np.ndarray, orders: int) -> list[np.ndarray]:
        top = np.zeros(len(tokens), np.uint64)
        some = np.flatnonzero(maybe[(tokens >> U(44)).astype(np.int64)])
        if len(some):
            place = np.searchsorted(self.tokens, tokens[some])
            place = np.minimum(place, len(self.tokens) - 1)
            known = self.tokens[place] == tokens[some]
            top[some[known]] = self.classes[place[known]] << U(61)
        return [top | (mix(tokens ^ salt) >> U(3)) for salt in _SALTS[:orders]]


@dataclass(frozen=True)
class Filter:
    """How much two sets must share to be similar."""

    percent: int
    least: int  # smaller sets are similar to none but equal ones
    common: int  # tokens that the prefixes of a pair must share

    @classmethod
    def of(cls, percent: int) -> Filter:
        least = -(-percent // (100 - percent)) if percent < 100 else 1 << 40
        return cls(percent, least, min(PREFIX_SHARED, -(-percent * least // 100)))

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + self.common

    def early(self, place: str, n: str, m: str) -> str:
        """Whether sets of n and m tokens that are similar share the first few of their tokens
        at this place of the one, or before."""
        most = f"(cast({n} as long) + {self.common - 1} - {place}) * {100 + self.percent}"
        return f"{most} >= {self.percent} * cast({n} + {m} as long)"

    def meets(self) -> str:
        """Whether a token that two sets share counts: their sizes fit, and it is early in
        either one."""
        return (
            f"100 * cast(least(n, m) as long) >= {self.percent} * cast(greatest(n, m) as long) "
            f"and m <= fits and n <= other_fits and {self.early('place', 'n', 'm')} and {self.early('other_place', 'm', 'n')}"
        )

    def alone(self) -> Column:
        """Whether no set with the token can be similar to this one and have it early enough.
        A smaller set is most like this one if it is the next smaller one, and leaves the token
        the most room if it is the smallest that is like this one; a larger one, if it is the
        next larger one."""
        least, below, above = (f"{x}(n) over (partition by token order by n, doc)" for x in ("first", "lag", "lead"))
        like = f"cast(ceil(cast(n as long) * {self.percent} / 100) as int)"
        smaller = f"100 * cast({below} as long) >= {self.percent} * cast(n as long) and {self.early('place', 'n', f'greatest({least}, {like})')}"
        larger = f"100 * cast(n as long) >= {self.percent} * cast({above} as long) and {self.early('place', 'n', above)}"
        return F.expr(f"not coalesce({smaller} or {larger}, false)")

    def fits(self, seen: Column) -> Column:
        """The size of the largest set that can be similar to one of ``n`` tokens and share its
        token at ``place``, up to which ``seen`` of its tokens are not alone. The others up to
        there are in no such set: its prefix would have them, as early."""
        n = F.col("n").cast("long")
        return F.floor((n - (F.col("place") + 1 - seen)) * (100 + self.percent) / self.percent - n).cast("int")

    def enough(self, shared: Column, total: Column) -> Column:
        """Whether so many shared tokens suffice for sets of so many tokens together."""
        return shared.cast("long") * (100 + self.percent) >= self.percent * total.cast("long")


def _postings(docs: DataFrame, words: int, rule: Filter, order: TokenOrder) -> DataFrame:
    """``token, doc, n, place``: each document's prefix under the first order. A task gives
    the prefix of equal sets once."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe, seen = order.maybe(), set()
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                out: list[tuple] = []
                for i, tokens in enumerate(shingle_sets(part.column("text"), words)):
                    n = len(tokens)
                    if n < rule.least:
                        continue
                    mark = (n, int(mix(tokens ^ U(1)).sum(dtype=np.uint64)), int(mix(tokens ^ U(2)).sum(dtype=np.uint64)))
                    if mark in seen:
                        continue
                    seen.add(mark)
                    head = np.sort(order.keys(tokens, maybe, 1)[0])[: rule.prefix(n)]
                    out.append((head, ids[i], n))
                sizes = np.array([len(h) for h, _, _ in out], np.int64)
                if not len(sizes):
                    continue
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        _as_long(np.concatenate([h for h, _, _ in out])),
                        pa.array(np.repeat(np.array([d for _, d, _ in out], np.int64), sizes)),
                        pa.array(np.repeat(np.array([n for _, _, n in out], np.int32), sizes)),
                        pa.array((np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32)),
                    ],
                    ["token", "doc", "n", "place"],
                )

    return docs.where("doc_id is not null").mapInArrow(lean(prefixes), "token long, doc long, n int, place int")


def _whole_sets(docs: DataFrame, words: int, rule: Filter, order: TokenOrder) -> DataFrame:
    """``doc, tokens`` and the prefixes under the other orders."""
    names = ["doc", "tokens", *(f"prefix{k}" for k in range(1, ORDERS))]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = order.maybe()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = list(shingle_sets(part.column("text"), words))
                heads: list[list[np.ndarray]] = [[] for _ in range(1, ORDERS)]
                for tokens in sets:
                    for k, key in enumerate(order.keys(tokens, maybe, ORDERS)[1:]):
                        heads[k].append(np.sort(key)[: rule.prefix(len(tokens))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _lists(sets), *(_lists(h) for h in heads)], names
                )

    schema = "doc long, " + ", ".join(f"{c} array<bigint>" for c in names[1:])
    return docs.mapInArrow(lean(build), schema)


def _candidates(met: DataFrame, rule: Filter) -> DataFrame:
    """Pairs of documents whose prefixes share enough. ``met`` has a row ``doc, n, place,
    other, m, other_place, weight`` for each token that two prefixes share, or for ``weight``
    tokens, with the place of the first one."""
    # What lies behind the last token shared can add no more than the shorter rest. A pair's
    # total is the same in all its rows, so it travels in the upper half of the same number.
    rest = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("other_place")) - 1
    total = F.col("n") + F.col("m")
    pairs = met.select(
        F.least("doc", "other").alias("a"),
        F.greatest("doc", "other").alias("b"),
        (F.shiftleft(total.cast("long"), 32) + rest).alias("bound"),
        "weight",
    )
    rest, total = F.col("bound").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("bound", 32)
    return (
        pairs.groupBy("a", "b")
        .agg(F.sum("weight").alias("shared"), F.min("bound").alias("bound"))
        .where((F.col("shared") >= rule.common) & rule.enough(F.col("shared") + rest, total))
        .select("a", "b")
    )


def _named(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is among ``ids``, and a few others. A bitmap of hashed
    ids is broadcast, so no text is shuffled."""

    def at(places: int) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(NAMED_BITS)) % places

    marks = ids.groupBy(F.floor(at(NAMED_BITS) / _BITMAP).alias("range")).agg(F.bitmap_construct_agg(at(_BITMAP)).alias("bits"))
    ranged = docs.where("doc_id is not null").withColumn("range", F.floor(at(NAMED_BITS) / _BITMAP)).withColumn("bit", at(_BITMAP))
    byte = F.expr("cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as long)")
    marked = F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1
    return ranged.join(F.broadcast(marks), "range").where(marked).select(*docs.columns)


def _links(pairs: DataFrame, docs: DataFrame, words: int, rule: Filter, order: TokenOrder) -> DataFrame:
    """The pairs (a, b) that share enough prefix tokens under every other order and, as whole
    sets, are similar. Sets are made for the documents of these pairs only; whole ones are
    read for the pairs that their prefixes leave."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    sets = written(_whole_sets(_named(docs, ids), words, rule, order), "tokens")

    def both(some: DataFrame, columns: list[str]) -> DataFrame:
        left = sets.select(F.col("doc").alias("a"), *[F.col(c).alias(f"a_{c}") for c in columns])
        right = sets.select(F.col("doc").alias("b"), *[F.col(c).alias(f"b_{c}") for c in columns])
        return some.join(left, "a").join(right, "b")

    prefixes = [f"prefix{k}" for k in range(1, ORDERS)]
    in_all = [F.size(F.array_intersect(f"a_{c}", f"b_{c}")) >= rule.common for c in prefixes]
    left = written(both(pairs, prefixes).where(reduce(Column.__and__, in_all)).select("a", "b").distinct(), "filtered")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    similar = rule.enough(shared, F.size("a_tokens") + F.size("b_tokens"))
    return written(both(left, ["tokens"]).where(similar).select("a", "b"), "links")


def _marks() -> list[Column]:
    """128 bits that tell which documents a token has, given once each."""
    return [F.bit_xor(F.xxhash64("doc", F.lit(k))) for k in (1, 2)]


def _as_one(shared: DataFrame) -> DataFrame:
    """Tokens that the very same documents share, told by the marks, as the least of them, with
    their number as ``weight``. Their first one has the same rank in the order for all
    documents, so its place bounds what two documents can share as it would alone."""
    one = shared.groupBy("doc", "mark1", "mark2", "n", "central").agg(
        F.min("token").alias("token"), F.min("place").alias("place"), F.max("fits").alias("fits"), F.count(F.lit(1)).alias("weight")
    )
    return one.select("token", "doc", "n", "place", "central", "fits", "weight")


def _apart(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """The shared tokens of documents that are in more than one component, with components."""
    located = shared.join(parts, shared["doc"] == parts["node"], "left").select(
        *shared.columns, F.coalesce("component", "doc").alias("component")
    )
    token = Window.partitionBy("token")
    mixed = F.min("component").over(token) != F.max("component").over(token)
    return located.withColumn("mixed", mixed).where("mixed").drop("mixed")


def _with_hubs(shared: DataFrame, salt: int, hubs: int) -> DataFrame:
    """Each document of a token with some of the token's documents: at first with those that
    share most of their prefixes, as an original does with its near copies, later with any."""
    first = F.desc("central") if salt == 0 else F.xxhash64("doc", F.lit(salt))
    ranked = shared.withColumn("rank", F.row_number().over(Window.partitionBy("token").orderBy(first, "doc")))
    few = ranked.where(F.col("rank") <= hubs).select(
        "token",
        F.col("doc").alias("other"),
        F.col("n").alias("m"),
        F.col("place").alias("other_place"),
        F.col("fits").alias("other_fits"),
        F.col("component").alias("other_component"),
        F.col("rank").alias("other_rank"),
    )
    return ranked.join(few, "token").where("rank > other_rank")


def _across(apart: DataFrame, rule: Filter) -> DataFrame:
    """All documents in different components that share a token early enough. First whole
    components meet, and they go on only if they share as many tokens as two of their
    documents must; so the pairs inside of one are never formed. Then the documents of the
    side with fewer of them meet the other component, and again only those that share enough
    with it go on to its documents."""
    sides = apart.repartition("token").groupBy("token", "component").agg(
        F.max("weight").alias("weight"),
        F.min("n").alias("low"),
        F.max("n").alias("high"),
        F.max("fits").alias("fits"),
        F.min("place").alias("early"),
        F.count(F.lit(1)).alias("docs"),
        *[x.alias(f"mark{k}") for k, x in enumerate(_marks(), 1)],
    )
    of_side = [x for x in sides.columns if x not in ("token", "weight")]
    left = sides.select("token", "weight", *[F.col(x).alias(f"c_{x}") for x in of_side])
    right = sides.select("token", *[F.col(x).alias(f"d_{x}") for x in of_side])
    meet = left.join(right, "token").where(
        f"c_component < d_component and d_low <= c_fits and c_low <= d_fits "
        f"and 100 * cast(c_high as long) >= {rule.percent} * cast(d_low as long) "
        f"and 100 * cast(d_high as long) >= {rule.percent} * cast(c_low as long) "
        f"and {rule.early('c_early', 'c_high', 'd_low')} and {rule.early('d_early', 'd_high', 'c_low')}"
    )
    # Tokens of the same documents on either side are one: the first, which all have earliest.
    values = [f"{x}_{y}" for x in "cd" for y in ("low", "high", "early", "fits", "docs")]
    meet = meet.groupBy("c_component", "d_component", *[f"{x}_mark{k}" for x in "cd" for k in (1, 2)]).agg(
        F.min_by("token", "c_early").alias("token"),
        F.sum("weight").alias("weight"),
        *[(F.min if x.endswith("early") else F.max)(x).alias(x) for x in values],
    )
    pair = Window.partitionBy("c_component", "d_component")
    met, turned = F.sum("weight").over(pair), F.sum("c_docs").over(pair) > F.sum("d_docs").over(pair)
    meet = meet.select("*", met.alias("met"), turned.alias("turned")).where(F.col("met") >= rule.common)
    # From here on c is the side with fewer documents.
    side = ("component", "low", "high", "early", "fits")
    meet = meet.select(
        "token",
        "weight",
        F.when(F.col("turned"), F.col("d_component")).otherwise(F.col("c_component")).alias("c_component"),
        *[F.when(F.col("turned"), F.col(f"c_{x}")).otherwise(F.col(f"d_{x}")).alias(f"d_{x}") for x in side],
    )
    first = apart.drop("weight").withColumnRenamed("component", "c_component")
    second = apart.select(
        "token",
        F.col("component").alias("d_component"),
        F.col("doc").alias("other"),
        F.col("n").alias("m"),
        F.col("place").alias("other_place"),
        F.col("fits").alias("other_fits"),
    )
    near = (
        meet.join(first, ["token", "c_component"])
        .where(f"d_low <= fits and n <= d_fits and {rule.early('place', 'n', 'd_low')} and {rule.early('d_early', 'd_high', 'n')}")
        .select("token", "weight", "d_component", "doc", "n", "place", "fits")
    )
    shared = F.sum("weight").over(Window.partitionBy("doc", "d_component"))
    near = near.withColumn("shared", shared).where(F.col("shared") >= rule.common).drop("shared")
    return near.join(second, ["token", "d_component"]).where(rule.meets())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, anything else) with its group of near copies.

    Returns ``doc_id, n_shingles, component_id``, one row per input row. Two documents link
    when 100 * shared shingles >= percent * shingles of either; the component is the
    smallest doc_id that links reach. A document with fewer words than a shingle has one
    shingle, all its words; one without words, or with a null text, has none and is alone.
    A row without doc_id makes no links; it belongs to the documents with its very set,
    or else has a null component. Rows that share a doc_id and differ in text are told
    apart by their sets, but link as one document. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = written(_set_rows(docs, words), "sets")
    common = (
        described.where("common")
        .groupBy("one")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "one")
        .limit(COMMON)
        .toPandas()
    )
    order = TokenOrder(common["one"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.int64))
    rows = described.where("not common").select("doc_id", "n", "one", "two")
    equal = rows.where("n > 0").groupBy("n", "one", "two").agg(F.min("doc_id").alias("rep"))

    rule = Filter.of(percent)
    document = Window.partitionBy("doc")
    prefixes = _postings(docs, words, rule, order)
    several = prefixes.withColumn("alone", rule.alone()).where("not alone").drop("alone")
    reps = rows.join(equal, ["n", "one", "two"]).where("doc_id is not null").select(F.col("doc_id").alias("doc"), "rep")
    nodes = several.join(reps.distinct(), "doc").select("token", F.col("rep").alias("doc"), "n", "place")
    nodes = nodes.repartition("token").distinct()  # dealt out once, for the windows too
    marks = [x.over(Window.partitionBy("token")).alias(f"mark{k}") for k, x in enumerate(_marks(), 1)]
    met = nodes.withColumn("alone", rule.alone()).where("not alone").drop("alone").select("*", *marks)
    often = met.withColumn("met", F.count(F.lit(1)).over(document)).where(F.col("met") >= rule.common)
    seen = F.row_number().over(document.orderBy("place"))
    placed = often.withColumn("central", (1000 * F.col("met") / F.col("n")).cast("int")).withColumn("fits", rule.fits(seen))
    shared = written(_as_one(placed), "shared")

    links = tried = docs.sparkSession.createDataFrame([], "a long, b long")
    apart, parts = shared.withColumn("component", F.col("doc")), None
    for turn in range(len(HUBS) + 1):
        if turn < len(HUBS):
            met = _with_hubs(apart, turn, HUBS[turn]).where(f"component != other_component and {rule.meets()}")
        else:
            met = _across(apart, rule)
        pairs = written(_candidates(met, rule).join(tried, ["a", "b"], "leftanti"), "pairs")
        tried = tried.unionByName(pairs)
        found = _links(pairs, docs, words, rule, order)
        if parts is None or not found.isEmpty():  # else all is as it was
            links = links.unionByName(found)
            parts = components(links)
            if turn < len(HUBS):
                apart = written(_apart(apart.drop("component"), parts), "apart")

    located = equal.join(parts, equal["rep"] == parts["node"], "left").select(
        "n", "one", "two", F.coalesce("component", "rep").alias("component_id")
    )
    return rows.join(located, ["n", "one", "two"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
