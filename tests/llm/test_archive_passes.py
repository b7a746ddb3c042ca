from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.llm import archives


def test_records_without_contents_and_few_passes(spark, tmp_path, monkeypatch):
    rows = [(1, "u", "same " * 50), (2, "u", "same " * 50), (3, None, None), (None, "v", "é\r\n\r\nWARC/1.0")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    arc = archives.write_arc(pages, str(tmp_path / "arc"))
    whole, brief = archives.read_arc(spark, arc), archives.read_arc(spark, arc, contents=False)
    assert brief.where("head is not null or payload is not null").count() == 0
    rest = [c for c in whole.columns if c not in ("head", "payload")]
    assert sorted(brief.select(rest).collect(), key=str) == sorted(whole.select(rest).collect(), key=str)
    assert whole.where(F.octet_length("payload") != F.col("payload_bytes")).count() == 0

    asked: list[str] = []
    for name in ("read_arc", "read_warc"):
        real = getattr(archives, name)
        monkeypatch.setattr(archives, name, lambda *a, real=real, name=name, **k: asked.append(name) or real(*a, **k))
    found = {r["page_id"]: r for r in archives.archive_pages(pages, str(tmp_path / "all")).collect()}
    # The result reads rows that were written, no archive.
    assert asked == ["read_arc", "read_arc", "read_warc"]
    assert [found[k]["refers_to"] for k in (1, 2, 3, None)] == [None, 1, None, None]
    assert [found[k]["payload_bytes"] for k in (1, 2, 3, None)] == [250, 250, 0, 14]
