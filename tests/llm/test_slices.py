"""Scores do not depend on where Arrow cuts its batches."""

import random

from tillroll.llm import backoff


def test_scores_with_small_batches(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randrange(1, 120)))) for i in range(400)]
    # With the ids a batch of 4 KB ends some rows earlier than without.
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = {r.doc_id: (r.n_words, round(r.score, 9)) for r in backoff.score_documents(docs).collect()}
    monkeypatch.setattr(backoff, "SLICE", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4096")
    try:
        got = {r.doc_id: (r.n_words, round(r.score, 9)) for r in backoff.score_documents(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert got == want and len(got) == 400
