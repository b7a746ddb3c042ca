"""How many rows the similarity join makes, and what it shuffles."""

from __future__ import annotations

import random

import brute
from pyspark.sql import functions as F

from tillroll.llm import jaccard


def near_misses(pairs):
    """Pairs of documents that share a passage of their own and are too far apart to link."""
    texts = []
    for k in range(pairs):
        passage = [f"p{k}_{i}" for i in range(300)]
        texts += [passage + [f"o{k}_{side}_{i}" for i in range(60)] for side in "ab"]
    return texts


def watched(monkeypatch):
    seen, real = {}, jaccard.written

    def written(df, name):
        seen.setdefault(name, []).append((df, real(df, name)))
        return seen[name][-1][1]

    monkeypatch.setattr(jaccard, "written", written)
    return seen


def test_tokens_of_the_same_documents_are_one_row(spark, docs, monkeypatch):
    seen = watched(monkeypatch)
    texts = near_misses(10)
    copy = texts[0][:100] + ["changed"] + texts[0][101:]
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, copy])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(*rows), 5, 80).collect()}
    assert got == brute.near_duplicates(rows, 5, 80) and got[20][1] == 0
    shared = seen["shared"][0][1]
    lone = shared.where("doc between 2 and 19")
    assert lone.count() == 18  # one row a document, for all tokens of its passage
    assert lone.where("weight < 3").isEmpty()


def test_tokens_shared_with_other_sizes_only_are_not_kept(spark, docs, monkeypatch):
    seen, rng = watched(monkeypatch), random.Random(2)
    texts = []
    for k in range(12):
        words = [f"w{k}_{i}" for i in range(400)]
        texts += [words, words[:300], words[:150] + [f"x{k}_{i}" for i in range(20)]]
        texts += [words[: rng.randrange(300, 400)] + [f"y{k}_{i}" for i in range(rng.randrange(60))] for _ in range(3)] * (k < 2)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(*rows), 5, 80).collect()}
    assert got == brute.near_duplicates(rows, 5, 80) and any(c != i for i, (_, c) in got.items())
    lone = [i for i, t in enumerate(texts) if i >= 12]
    assert seen["shared"][0][1].where(F.col("doc").isin(lone)).isEmpty()


def test_no_text_is_shuffled(spark, docs, monkeypatch):
    seen, rng = watched(monkeypatch), random.Random(1)
    texts = near_misses(3)
    texts += [[w if rng.random() < 0.99 else "x" for w in t] for t in texts]
    rows = [(i - 5, " ".join(t)) for i, t in enumerate(texts)] + [(None, "a b c d e f")]
    monkeypatch.setattr(jaccard, "HUBS", (1,))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(*rows), 5, 80).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {k: v for k, v in got.items() if k is not None} == brute.near_duplicates(rows[:-1], 5, 80)
    for df, _ in seen["tokens"]:
        assert "hashpartitioning(doc_id" not in df._jdf.queryExecution().executedPlan().toString()


def test_named_rows(spark, docs):
    table = docs(*[(i, "t") for i in range(-40, 40)], (None, "t"), (7, "again"))
    ids = spark.createDataFrame([(i,) for i in (-40, -1, 0, 7, 7, 39)], "doc_id long")
    found = jaccard._named(table.select("doc_id", "text"), ids)
    assert found.columns == ["doc_id", "text"]
    assert sorted(r.doc_id for r in found.collect()) == [-40, -1, 0, 7, 7, 39]
