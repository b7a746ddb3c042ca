"""What the trained operators learn from."""

from tillroll.llm import language, toxicity

SCHEMA = "doc_id long, text string, lang string"


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "STEPS", 1)
    rows = [(i, f"wort{i % 130} text", f"l{i % 130}") for i in range(1300)]
    net = language.learn(spark.createDataFrame(rows, SCHEMA))
    assert net.labels == sorted({r[2] for r in rows})


def test_words_of_the_whole_text_and_rows_of_many_ids(spark, monkeypatch):
    def network(texts, labels, units=language.UNITS, make=language.Network):
        """Keeps the texts it was given where a trained one has its labels."""
        import numpy as np

        names = [f"{k}:{t}" for t, k in zip(texts, labels)]
        shapes = [(2, 256, 3 * units), (2, units, 3 * units), (2 * units, len(names)), (len(names),)]
        return make(names, *[np.zeros(s, np.float32) for s in shapes])

    monkeypatch.setattr(language, "train", network)
    head, tail = "license " * 400, " ".join(f"t{k}" for k in range(2000))
    rows = [(1, head + tail, "a")] * 900 + [(i, f"b{i}", "b") for i in range(2, 40)] + [(i, f"a{i}", "a") for i in range(40, 60)]
    texts = language.learn(spark.createDataFrame(rows, SCHEMA).repartition(3)).labels
    long = [t for t in texts if "license" in t]
    assert len(long) == 1 and len(long[0]) <= language.SAMPLE_CHARS + 2 and " t1" in long[0]
    assert sum(t.startswith("b:") for t in texts) > 20 and sum(t.startswith("a:a") for t in texts) > 10


def test_toxicity_learns_one_row_of_an_id(spark, monkeypatch):
    def count(texts, labels, share, make=toxicity.Model):
        import numpy as np

        return make(np.zeros(0, np.int64), np.zeros(0, np.float32), float(len(texts)), (0.0, 0.0), 0.0)

    monkeypatch.setattr(toxicity, "train", count)
    rows = [(1, f"text {i}") for i in range(500)] + [(i, "other") for i in range(2, 40)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), marks)
    assert 0 < model.bias <= 39
