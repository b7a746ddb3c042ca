"""Resampling, alignment and sharding against plain versions."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import alignment, resampling, sharding

SCHEMA = "doc_id long, text string, rank long, shard string, part int, copies int"


def frame(spark, rows):
    """Documents with columns whose names the operators use."""
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], SCHEMA).repartition(5)


def wordy(rng, n):
    return " ".join(f"W{int(rng.paretovariate(0.7)) % 300}é" for _ in range(n))


def feature_buckets(text, run):
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", brute.lower(text))
    grams = [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % resampling.BUCKETS for g in grams]


def resampled(rows, target, run):
    found = [(i, *feature_buckets(t, run)) for i, t in rows]
    corpus, goal = Counter(), Counter()
    for *_, b in found:
        corpus.update(b)
    for t in target:
        goal.update(feature_buckets(t, run)[1])
    size, s_all, t_all = resampling.BUCKETS, sum(corpus.values()), sum(goal.values())
    out = []
    for i, n, b in found:
        weight = sum(math.floor(1000 * math.log((goal[k] + 1) * (s_all + size) / ((corpus[k] + 1) * (t_all + size)))) for k in b)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    order = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    k = 10 * len(order) // 100
    drawn = [(*r[:4], place) for place, r in enumerate(order[:k], 1)]
    return drawn + [(*r[:4], None) for r in order[k:]] + [(*r[:4], None) for r in out if r[4] < 20]


@pytest.mark.parametrize("run, pivots", [(1, 15), (2, 1)])
def test_resampling(spark, monkeypatch, run, pivots):
    """A third of all rows is one row; the sample ends among its copies."""
    monkeypatch.setattr(resampling, "PIVOTS", pivots)
    rng = random.Random(run)
    hot = wordy(rng, 40) + " words of the target" * 12
    rows = [(i, wordy(rng, rng.randrange(60))) for i in range(2_000)] + [(7, hot)] * 1_200 + [(None, wordy(rng, 30))] * 3
    rows += [(5_000, None), (5_001, ""), (5_002, "x" * 6_000 + " y"), (5_003, "?! -")]
    target = [hot] * 400 + ["", None]
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = [tuple(r) for r in resampling.resample(frame(spark, rows), items, run=run).collect()]
    want = resampled(rows, target, run)
    assert sorted(got, key=str) == sorted(want, key=str)
    places = [r[4] for r in got if r[0] == 7]
    assert None in places and any(places)


def test_the_kth_key_is_that_of_the_sorted_rows(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(-40, 40), rng.choice([None, *range(9)]), k, 0, rng.randrange(1, 4)) for k in range(500)]
    df = spark.createDataFrame(rows, "minus long, doc_id long, n_features long, part long, copies long")
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    upto = np.cumsum([r[4] for r in order])
    for k in (1, 2, int(upto[-1]) // 3, int(upto[-1])):
        assert tuple(resampling.kth(df, k)) == order[int(np.searchsorted(upto, k))][:4]


def test_crc_of_spans():
    data = np.frombuffer(b"alpha beta" + b"z" * 5_000, np.uint8)
    starts, ends = np.array([0, 6, 3, 10]), np.array([5, 10, 3, 5_010])
    got = resampling.crc_on(np.zeros(4, np.uint32), data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


PARTS = [
    " ", "  ", "   ", "\n", "\t", " ", "　", " ", "\x85", "\x1c", "a", "b", "'s", "'", "1", "é", "漢", "字", "😀",
    "<s>", "<0x0A>", "<|endoftext|>", "▁", "\x00", "!", "...", "the", " of", "Hello", "ﬁ", "é", "‍", "𝐱", "\r\n",
]


def test_alignment(spark):
    """Parts aligned apart give what whole texts give."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(30)))) for i in range(3_000)]
    rows += [(9_000, None), (9_001, ""), (9_002, "x" * 3_000), (9_003, "漢" * 2_000), (7, "a b"), (7, "a b"), (None, "a b"), (9_004, "Hello the " * 4_000)]
    got = sorted((tuple(r) for r in alignment.align_documents(frame(spark, rows)).collect()), key=str)
    assert got == sorted(brute.alignments(rows), key=str)


def test_alignment_with_small_slices(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(f"{rng.choice('abc')}{rng.randrange(50)}é" for _ in range(rng.randrange(60)))) for i in range(400)]
    monkeypatch.setattr(alignment, "ENCODED", 5)
    monkeypatch.setattr(alignment, "slices", lambda batch, column, limit: (batch.slice(k, 7) for k in range(0, batch.num_rows, 7)))
    got = sorted(tuple(r) for r in alignment.align_documents(frame(spark, rows)).collect())
    assert got == sorted(brute.alignments(rows))


def aligner():
    definition, model = alignment.default_files()
    with open(definition, encoding="utf-8") as a, open(model, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def test_many_parts_are_aligned_in_little_memory():
    parts = [f" w{k}é{k * k}".encode() for k in range(60_000)]
    one = aligner()
    one.parts(parts[:100])
    tracemalloc.start()
    whole = one.parts(parts).whole
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert whole.all() and peak < 100 * sum(map(len, parts))


def test_parts_are_encoded_together_but_a_lost_one_alone(monkeypatch):
    parts = [f" w{k}".encode() for k in range(300)] + [" ▁".encode(), b" a ", b" b"]
    one, asked = aligner(), []
    encode = one._encode
    monkeypatch.setattr(one, "_encode", lambda data, bounds, chars, i, j: asked.append((i, j)) or encode(data, bounds, chars, i, j))
    got = one.parts(parts)
    assert asked[:4] == [(0, 128), (128, 256), (256, 302), (302, 303)]
    assert asked[4:] == [(k, k + 1) for k in range(256, 302)]
    apart = [one.parts([part]) for part in parts]
    assert got.groups == [x.groups[0] for x in apart] and got.whole.tolist() == [x.whole[0] for x in apart]
    assert np.flatnonzero(~got.whole).tolist() == [300]


def test_spans_that_the_bytes_contradict():
    table, offsets = np.frombuffer("abéx".encode(), np.uint8), np.array([0, 2, 3, 4, 5])  # ab, two bytes of é, x
    data, bounds = np.frombuffer("abéabxabyab".encode(), np.uint8), np.array([0, 4, 7, 10, 12])
    tokens = alignment.Tokens([0, 1, 2, 0, 3, 0, 3, 0, 3], [3, 2, 2, 2], np.array([2, -1, 4, 2, 3, 2, 3, 1, 3]))
    ends, whole = tokens.ends(table, offsets, data, bounds)
    assert ends[:5].tolist() == [2, 3, 4, 6, 7] and whole.tolist() == [True, True, False, False]


def test_stretches_whose_hashes_collide(monkeypatch):
    monkeypatch.setattr(alignment, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    texts, which, bounds = alignment.stretches(pa.array(["ab cd ab", None, "", "cd"]))
    assert [[texts[k].decode() for k in which[a:b]] for a, b in zip(bounds[:-1], bounds[1:])] == [[" ab", " cd", " ab"], [], [], [" cd"]]


def shard_of(key, weights):
    def draw(shard):
        h = int(hashlib.md5(f"{'' if key is None else key}:{shard}".encode()).hexdigest()[:13], 16)
        return -math.log((h + 0.5) / 2**52) / weights[shard], shard

    return min(map(draw, range(len(weights))))[1]


def test_sharding(spark, monkeypatch):
    """A third of all rows is one row, and another third has one id."""
    monkeypatch.setattr(sharding, "MOST", 100)
    weights, grown = [1.0, 2.0, 0.5, 1.0], [1.0, 2.0, 0.5, 1.0, 3.0]
    rows = [(i, f"text é {i}") for i in range(1_000)] + [(3, "same")] * 1_000 + [(4, f"other {i}") for i in range(997)]
    rows += [(None, None), (None, ""), (-1, None)]
    got = sharding.shard_documents(frame(spark, rows), weights, grown).collect()
    plain = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", shard_of(i, weights), shard_of(i, grown)) for i, t in rows]
    assert sorted(((*r[:5], r.grown_shard) for r in got), key=str) == sorted(plain, key=str)
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    again = sharding.shard_documents(frame(spark, rows[::-1]), weights, grown).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_shares_follow_the_weights(spark):
    weights = [1.0, 2.0, 4.0, 1.0]
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = {r[0]: r[1] for r in ids.groupBy(sharding.shard_of("doc_id", weights).alias("shard")).count().collect()}
    assert all(abs(n[s] / 20_000 - w / 8) < 0.015 for s, w in enumerate(weights))
    with pytest.raises(ValueError):
        sharding.shard_of("doc_id", [1.0, 0.0])


def test_shards_are_written_whole(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", 5) for i in range(200)], "doc_id long, text string, slot int")
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(tuple(r)[:3] for r in back) == sorted(tuple(r) for r in docs.collect())
    assert all(r.shard == shard_of(r.doc_id, [1.0] * 8) for r in back)


def test_sharding_stays_native(spark):
    """No Python in the plan of the shards, nor in that of the places."""
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = sharding.shard_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
