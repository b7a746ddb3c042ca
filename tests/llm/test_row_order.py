"""Inputs that give their rows in another order each time they are read, and keys of one hash."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillroll.functions.sharing import scratch_path
from tillroll.llm import naming, secrets

TEXTS = ["", None, "token: abcdefgh1", "a" * 40, "x" * 70, "x" * 69 + "y", "AKIA" + "Q" * 20, "password=correcthorse and 0123456789abcdef0123456789abcdef"]


@pytest.fixture
def restless(docs):
    """Every text under several ids, in an order drawn anew at each evaluation."""
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(120)] + [(5, TEXTS[5])] * 3 + [(None, "lonely")] * 2
    base = docs(*rows)
    columns = base.columns

    def shuffled(frames):
        import pandas as pd

        whole = pd.concat(list(frames) or [pd.DataFrame(columns=columns)])
        yield whole.sample(frac=1, random_state=random.SystemRandom().randrange(1 << 30))

    return base.mapInPandas(shuffled, base.schema)


def test_findings_belong_to_their_texts(spark, restless):
    got = secrets.scan_documents(restless, scratch_path(spark, "ledger")).where("doc_id is not null").distinct().collect()
    assert len(got) == 120
    for r in got:
        spans = sorted((a, k, rule.kind, b) for k, rule in enumerate(secrets.RULES) for a, b in rule.spans(TEXTS[r.doc_id % len(TEXTS)] or ""))
        assert r.spans == ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


@pytest.mark.parametrize("hashes", [None, 1, 3])
def test_the_kept_rows_are_the_right_ones(restless, monkeypatch, hashes):
    """With one or three hashes for all blocks, names rest on the blocks and run over every edge."""
    if hashes:
        monkeypatch.setattr(naming, "_deal", lambda keys: F.pmod(F.xxhash64(*keys), F.lit(hashes)))
    groups = {}
    for i in range(120):
        groups.setdefault(TEXTS[i % len(TEXTS)] or "", []).append(i)
    found = {r.text_sha256: (r.keep_id, r.group_size) for r in naming.exact_duplicates(restless, 16).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {sha(t): (max(ids), len(ids) + 3 * (t == TEXTS[5])) for t, ids in groups.items()}
    assert found == {**want, sha("lonely"): (None, 2)}

    kept = naming.without_duplicates(restless, 16).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == sorted([(str(max(i)), t) for t, i in groups.items()] + [("None", "lonely")])
