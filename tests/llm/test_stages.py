"""The stages of the pipeline on clashing names, nulls, repeated rows and empty tables."""

import os

import pytest

import corpus_pipeline

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
EXTRA = ["toxicity_of_text", "naming_row", "kept_id", "leak_key", "key", "row", "score", "component_id", "KEPT_ID_"]
PROSE = "a plain sentence about rivers and hills that nobody would mind to read today"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_columns_of_any_name_stay(spark, tmp_path, name, stage):
    rows = [(1, None), (2, ""), (3, PROSE), (3, PROSE), (None, "another " + PROSE), (4, "some words more")]
    full = [(*r, *["clash"] * len(EXTRA)) for r in rows]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)
    spark.createDataFrame(full, schema).coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = stage(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert {r.text for r in got if r.text} == {r[1] for r in rows if r[1]}
    assert all(set(tuple(r)[2:]) == {"clash"} for r in got)
    assert len(got) == (4 if name == "exact_dedup" else 6)
    assert stage(spark, docs.where("doc_id = 0"), SF_DIR).collect() == []


def test_an_empty_table_packs_to_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, offset string")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect() == []
