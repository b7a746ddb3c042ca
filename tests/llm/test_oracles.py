"""Queries that SQL can express, against it; learned ones by held-out accuracy."""

import os

import duckdb
import pytest

from tillroll.llm.queries import ORACLES, QUERIES
from tillroll.llm.stages import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    connection = duckdb.connect()
    for view in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF_DIR}/{view}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == want


def test_language_of_held_out_documents(spark):
    got = QUERIES["op3_language_id"](spark, SF_DIR).where("held_out").join(table(spark, SF_DIR, "documents"), "doc_id")
    rows = got.select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_toxicity_learns_insults_with_gaps(spark):
    """Held-out documents with insults that are spaced out or have characters put in."""
    import random

    from tillroll.llm import toxicity

    rng = random.Random(5)
    plain = [f"{a}{b}" for a in ("ba", "lo", "ri", "mu", "te") for b in ("nor", "sa", "vil", "ko", "dem", "pra")]
    words = lambda n: [rng.choice(plain) for _ in range(n)]
    texts, marks = [], []
    for i in range(300):
        bad = i % 3 == 0
        extra = [rng.choice(["blockhead", "nitwit", "scoundrel"])] * 2 if bad else []
        text = words(30) + extra
        rng.shuffle(text)
        texts.append(" ".join(text))
        marks.append(int(bad))
    model = toxicity.train(texts, marks, 1 / 3)
    import pyarrow as pa

    hidden = ["n i t w i t", "block-head", "sco*un*drel", "blocxkhead", "NITWIT"]
    tries = [" ".join([*words(20), h, *words(5), h]) for h in hidden] + [" ".join(words(30)) for _ in range(20)]
    symbols, starts, ends, which, rows = toxicity.distinct_words(pa.array(tries))
    scores = model.word_scores(model.table(), symbols, starts, ends)[which]
    chance = model.probability(toxicity.worst_words(scores, rows, len(tries)))
    assert (chance[:5] >= toxicity.THRESHOLD).all() and (chance[5:] < toxicity.THRESHOLD).all()
