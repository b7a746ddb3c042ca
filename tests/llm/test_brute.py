"""Operators against plain versions, on small fixtures and the smallest tables."""

import os
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tillroll.llm import jaccard, packing, queries, viterbi
from tillroll.llm.stages import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 50)])
def test_groups_of_near_copies(spark, docs, words, percent):
    """A loose group around an original, chains of edits, a passage that many share."""
    rng = random.Random(words)
    texts, original = [], [f"w{k}" for k in range(60)]
    texts += [edited(rng, original, rng.randrange(5)) for _ in range(60)]
    step = [f"c{k}" for k in range(80)]
    for _ in range(15):
        step = edited(rng, step, 1)
        texts.append(step)
    passage = [f"p{k}" for k in range(40)]
    texts += [passage + [f"u{i}_{k}" for k in range(rng.randrange(2, 30))] for i in range(40)]
    texts += [[f"s{k}" for k in range(n)] for n in range(1, 14)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(*rows), words, percent).collect()}
    assert got == brute.near_duplicates(rows, words, percent)


@needs_tables
def test_near_duplicates_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.ngram_jaccard(spark, SF_DIR).collect()}
    assert got == brute.near_duplicates(rows, 4, 85)


def test_token_counts_follow_the_tokenizer():
    from tokenizers import Tokenizer, models

    scores = viterbi.vocabulary(viterbi.default_model())
    pieces = [(p.replace(" ", viterbi.MARK), s) for p, s in scores.items()]
    reference = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    texts = ["a  b\n\n c \t▁d é漢字😀xx <s>", "\n", " x", "foo ", "   multiple    spaces", "naïve\r\nline", "  "]
    counter = viterbi.Counter(scores)
    data, starts, ends, rows, others = viterbi.words_of(pa.array([*texts, "", None]))
    total = others.copy()
    for a, b, r in zip(starts, ends, rows):
        total[r] += counter.count(data[a:b].tobytes().decode())
    want = [len(reference.encode(viterbi.MARK + t.replace(" ", viterbi.MARK), add_special_tokens=False).ids) for t in texts]
    assert total.tolist() == [*want, 0, 0]


def test_token_ids_follow_the_tokenizer():
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        words = packing.WordTokens(file.read())
    texts = ["It's Don't 'S '''s x'y", "naïve É́ ÀÉÎ straße ßÄ x²½ ªº × ÷", "<|endoftext|>a", "Σας ΑΣ İI 漢字 😀x", "a_b-c__ 12ab34 ...!?", "t\x0bv\x85n", ""]
    for text, ids in zip(texts, words.ids(pa.array(texts))):
        assert ids.tolist() == [*words.tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_packs_are_full_and_balanced():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 400, 500)
    placed = packing.pack(sizes, 512)
    used = np.zeros(-(-sizes.sum() // 512), np.int64)
    for piece, start, length, sequence, offset in placed:
        assert offset == used[sequence]
        used[sequence] += length
    assert used.sum() == sizes.sum() and used.max() <= 512
    got = np.zeros(len(sizes), np.int64)
    for piece, start, length, *_ in placed:
        got[piece] += length
    assert (got == sizes).all()


@pytest.mark.parametrize("capacity, least, most", [(64, 1, 64), (512, 200, 400), (10, 1, 3)])
def test_pieces_go_to_the_cheapest_sequence_with_room(capacity, least, most):
    """Longest first; cut where no sequence has room. A packer that ignored the cost would fail."""
    sizes = np.random.default_rng(capacity).integers(least, most, 300)
    room = [capacity] * -(-int(sizes.sum()) // capacity)
    spent, want = [0.0] * len(room), []
    for piece in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        start, left = 0, int(sizes[piece])
        while left:
            able = [s for s in range(len(room)) if room[s] >= left] or [s for s in range(len(room)) if room[s]]
            s = min(able, key=lambda s: (spent[s], s))
            take = min(left, room[s])
            want.append((piece, start, take, s, capacity - room[s]))
            spent[s] += packing.cost(take)
            room[s] -= take
            start, left = start + take, left - take
    assert packing.pack(sizes, capacity) == want


@needs_tables
def test_pieces_hold_every_token(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    pieces = {}
    for r in queries.cost_packing(spark, SF_DIR).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for r in table(spark, SF_DIR, "documents").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        at = 0
        for p in sorted(pieces[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


@needs_tables
def test_pipeline(spark):
    """Each stage drops what its operator names, keeps the columns, and the last packs all."""
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = docs.count()
        assert 0 < after <= before
        before = after
        if name == "exact_dedup":
            texts = [r.text for r in docs.collect()]
            assert len(set(texts)) == len(texts)
        if name == "ngram_jaccard":
            groups = brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
            assert all(i == component for i, (_, component) in groups.items())
    kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()} == kept
