"""Secrets in texts, by an incremental ledger of blobs.

Every version of a text is a blob, named by its SHA-256. A ledger in a shared folder
holds which blobs were scanned with which version of which rule, and what was found. A
run scans only pairs of blob and rule version that the ledger lacks, each blob once
however many rows hold it, and joins the findings back to all rows. A new rule version
rescans old blobs with that rule alone; a new text costs one scan.

The ledger only grows, by one folder a run. Findings are written before the note that
the pairs were scanned, so a run that fails in between leaves pairs to be scanned
again; findings that are then there twice count once.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.hashing import slices
from tillroll.llm.stages import written


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that do not overlap; those whose ``group`` is shorter than ``least``
    are dropped. Another ``version`` makes the ledger scan again."""

    kind: str
    version: int
    pattern: str
    flags: int
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern, self.flags).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        2,
        8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", re.ASCII, 0, 16),
    # Runs of 32 and more: the same as all runs less the shorter ones, without matching those.
    Rule("hex", 1, r"[0-9a-f]{32,}", re.ASCII, 0, 32),
)
RULES = (*BASE_RULES, Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", re.ASCII, 0, 27))


def _ledger_table(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """All increments of a ledger's table; none of a ledger that does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{ledger}/{name}")


def _findings(unseen: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, rule, kind, start, end`` of blobs with their text and the rules to apply."""
    by_key = {r.key: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for blob, text, keys in zip(*(part.column(c).to_pylist() for c in ("blob", "text", "rules"))):
                    for key in keys:
                        rule = by_key[key]
                        out += [(blob, key, rule.kind, a, b) for a, b in rule.spans(text)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["blob", "rule", "kind", "start", "end"]
    types = [pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return unseen.select("blob", "text", "rules").mapInArrow(
        scan, "blob binary, rule string, kind string, start long, end long"
    )


def scan_versions(docs: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Bring the ledger up to date with all rows of ``docs`` (doc_id, text) and return
    ``doc_id, blob`` of every row. A null text is an empty one."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))
    versions = written(named.select("doc_id", "blob"), "versions")
    scanned = _ledger_table(spark, ledger, "scanned", "blob binary, rule string").distinct()
    pairs = versions.select("blob").distinct().select("blob", F.explode(F.array(*[F.lit(r.key) for r in rules])).alias("rule"))
    unseen = written(
        pairs.join(scanned, ["blob", "rule"], "leftanti").groupBy("blob").agg(F.collect_list("rule").alias("rules")),
        "unseen",
    )
    # A text comes with its own digest, in whatever order the rows come; copies merge before the shuffle.
    texts = named.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob")
    increment = uuid.uuid4().hex
    _findings(texts, rules).write.parquet(f"{ledger}/findings/{increment}")
    unseen.select("blob", F.explode("rules").alias("rule")).write.parquet(f"{ledger}/scanned/{increment}")
    return versions.select("doc_id", "blob")


def findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, rule, kind, start, end`` of all blobs, for these rule versions."""
    found = _ledger_table(spark, ledger, "findings", "blob binary, rule string, kind string, start long, end long")
    return found.where(F.col("rule").isin([r.key for r in rules])).distinct()


def scan_documents(docs: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, anything else) with what is found in its text.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: spans are kind:start:end in
    code points, by start and then in the rules' order, joined by commas; the digest is that
    of the base rules' spans alone. A null or empty text has none. Rows of equal text, also
    of equal or null doc_id, get the same findings. No rows give no rows.
    """
    versions = scan_versions(docs, ledger, rules)
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    by_blob = (
        findings(docs.sparkSession, ledger, rules)
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", place[F.col("kind")].alias("place"), "kind", "end"))).alias("found"))
    )

    def shown(spans: Column) -> Column:
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    base = [r.kind for r in BASE_RULES]
    of_kind = lambda k: F.filter("found", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    digests = by_blob.select(
        "blob",
        *counts,
        shown(F.filter("found", lambda s: s["kind"].isin(base))).alias("base"),
        shown(F.col("found")).alias("spans"),
    )
    return versions.join(digests, "blob", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
