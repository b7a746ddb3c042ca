"""Benchmark items planted in documents, against every pair aligned."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import contamination


def benchmark(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def words_of(text):
    return contamination.passage_words(pa.array([text]))[0].view(np.int64)


def brute(rows, items):
    """{doc_id: (item_id, score)} of the best item by alignment with whole texts; none below the threshold."""
    out = {}
    for i, text in rows:
        found = [(contamination.alignment(words_of(x), words_of(text)) / (contamination.MATCH * len(words_of(x))), -k) for k, x in items]
        score, item = max(found)
        if score >= contamination.THRESHOLD:
            out[i] = (-item, round(score, 9))
    return out


def found(frame):
    return {r.doc_id: (r.item_id, round(r.score, 9)) for r in frame.collect() if r.contaminated}


def planted(rng, words):
    before, after = ([f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(30))] for _ in range(2))
    return " ".join([*before, *words, *after])


@pytest.mark.parametrize("edit", ["every fifth", "half"])
def test_an_edited_item_in_hundreds_of_documents(spark, docs, edit):
    rng = random.Random(5)
    item = [f"i{k}" for k in range(20)]
    kept = [w if k % 5 != 4 else None for k, w in enumerate(item)] if edit == "every fifth" else item[:11]
    rows = [(i, planted(rng, [w or f"e{rng.randrange(10**9)}" for w in kept])) for i in range(300)]
    items = [(7, " ".join(item)), (8, " ".join(f"o{k}" for k in range(20)))]
    want = brute(rows, items)
    assert len(want) == 300
    assert found(contamination.contamination(docs(*rows), benchmark(spark, *items))) == want


def test_the_seeds_of_an_item_are_in_one_block(spark, docs, monkeypatch):
    """Two seeds are left of each item, whatever the number of blocks."""
    rng = random.Random(6)
    items = [(k, " ".join(f"i{k}_{n}" for n in range(12))) for k in range(30)]
    rows = []
    for k, text in items:
        kept = [w if n < 4 or n % 2 == 0 else f"e{rng.randrange(10**9)}" for n, w in enumerate(text.split())]
        rows.append((k, planted(rng, kept)))
    want = brute(rows, items)
    assert len(want) == 30
    monkeypatch.setattr(contamination, "BLOCK", 60)
    assert found(contamination.contamination(docs(*rows), benchmark(spark, *items))) == want


def test_alignments_of_many_pairs():
    rng = np.random.default_rng(2)
    pairs = [[rng.integers(0, 4, rng.integers(1, 14)).astype(np.uint64) for _ in range(2)] for _ in range(60)]
    got = contamination.alignments([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [contamination.alignment(a, b) for a, b in pairs]


def split(text):
    """The words of a text by code points, as text."""
    data, starts, ends = (x := contamination.text_bytes(pa.array([text])))[0], *contamination.word_places(*x)[:2]
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]


def test_words_end_at_unicode_punctuation_and_spaces():
    assert split("“Naïve” —don’t… ２０，été​𝐱🙂я_σ") == ["Naïve", "don", "t", "２０", "été", "𝐱", "я", "σ"]
    assert split("漢字とA1か、ไทย。𠀀b") == ["漢", "字", "と", "A1", "か", "ไ", "ท", "ย", "𠀀", "b"]
    assert split("हिन्दी می‌خواهم 한국어") == ["हिन्दी", "می‌خواهم", "한국어"]


def test_items_in_any_script_and_of_any_length(spark, docs):
    items = [(1, "敏捷的棕色狐狸跳过了懒狗。"), (2, "สุนัขจิ้งจอกสีน้ำตาล"), (3, "“Zwei – Wörter”"), (4, "einzig"), (5, "the “quick” brown—fox jumps")]
    rows = [
        (1, "开头，敏捷的棕色狐狸跳过了懒狗！结尾"), (2, "ก ข สุนัขจิ้งจอกสีน้ำตาล ค"), (3, "so zwei wörter."), (4, "wörter zwei"),
        (5, "(EINZIG)"), (6, "einzigartig"), (7, "the quick brown fox jumps"), (8, "完全不同的句子"), (9, ""),
    ]
    got = found(contamination.contamination(docs(*rows), benchmark(spark, *items)))
    assert got == {1: (1, 1.0), 2: (2, 1.0), 3: (3, 1.0), 5: (4, 1.0), 7: (5, 1.0)}
