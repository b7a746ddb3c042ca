"""Web archives: legacy ARC files to WARC files, and WARC files to rows.

An ARC file starts with a version block that names its version and the fields of its
header lines: five in version 1, ten in version 2. A header line ends with the declared
length of the content that follows. The converter reads by these lengths and makes what
WARC wants and ARC lacks: record identifiers, ISO dates, record types and digests.
Equal payloads are stored once; later records of the same payload are revisits.

Files are written by Spark's text writer, a record a row, zipped, and read whole, so a
file has to fit into a task: ``FILE_BYTES`` is what the writers aim at before zipping.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.stages import written

FILE_BYTES = 8 << 20
SEQUENCE = "X-Archive-Sequence"  # HTTP header with a record's place in the crawl
_ORIGIN = "tillroll"
# Zipping took most of the time of writing; the level of Hadoop's codecs is theirs to read.
_ZIPPED = {"lineSep": "\n", "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_DATE = "20240101000000"
#: The header fields of either version, and the WARC profile of revisits.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _raw_strings(parts: list[bytes]) -> pa.Array:
    """Strings of any bytes, also those that are no UTF-8."""
    raw = pa.array(parts, pa.binary())
    return pa.StringArray.from_buffers(len(raw), raw.buffers()[1], raw.buffers()[2])


def _files(df: DataFrame, size: Column) -> int:
    """How many files hold rows of this size."""
    return 1 + int((df.agg(F.sum(size)).first()[0] or 0) // FILE_BYTES)


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing ARC ----------------------------------------------------------------------


def _version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 {_ORIGIN}\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": _DATE, "Content-type": "text/plain"}
    return _header_line(version, values, len(body)) + body


def _header_line(version: int, values: dict[str, str], length: int) -> bytes:
    fields = [str(length) if f == "Archive-length" else values.get(f, "-") for f in ARC_FIELDS[version]]
    return (" ".join(re.sub(r"\s", "%20", f) or "-" for f in fields) + "\n").encode()


def write_arc(pages: DataFrame, path: str) -> str:
    """Write ``pages`` (page_id, url, html) as ARC files, every other one of version 2."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, begun = 1 + part % 2, False
        for batch in batches:
            out = [] if begun else [_version_block(version, f"pages-{part}.arc")]
            begun = True
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                body = (html or "").encode()
                sequence = "" if page is None else f"{SEQUENCE}: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{sequence}Content-Length: {len(body)}\r\n\r\n"
                values = {"URL": url or "about:blank", "IP-address": "0.0.0.0", "Archive-date": _DATE, "Content-type": "text/html", "Result-code": "200"}
                content = head.encode() + body
                out.append(_header_line(version, values, len(content)) + content)
            for k in range(0, len(out), 256):
                yield pa.RecordBatch.from_arrays([_raw_strings(out[k : k + 256])], ["value"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    files = _files(source, F.coalesce(F.octet_length("html"), F.lit(0)) + 512)
    dealt = source.repartition(files, F.xxhash64("page_id", "url"))
    dealt.mapInArrow(records, "value string").write.options(**_ZIPPED).text(path)
    return path


# --- reading ARC ----------------------------------------------------------------------


def _unpacked(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes, str | None]]:
    """Offset, header fields, content and what is wrong, of each record but the version block.

    A content that ends before its declared length is given as far as it goes. From a
    header line that cannot be read on, the rest is one record with that error.
    """
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        stop = data.find(b"\n", at)
        stop = len(data) if stop < 0 else stop
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r").split(" ")
        known = fields or (ARC_FIELDS[2] if len(line) == len(ARC_FIELDS[2]) else ARC_FIELDS[1])
        if len(line) != len(known) or not line[-1].isdigit():
            yield at, {}, data[at:], "unreadable header line"
            return
        header = dict(zip(known, line))
        length = int(line[-1])
        content = data[stop + 1 : stop + 1 + length]
        if fields is None:
            if not header["URL"].startswith("filedesc:"):
                yield at, {}, data[at:], "no version block"
                return
            version = content.split(b" ", 1)[0]
            fields = ARC_FIELDS.get(int(version)) if version.isdigit() else None
            if fields is None:
                yield at, {}, data[at:], "unknown version"
                return
        else:
            yield at, header, content, None if len(content) == length else "truncated"
        at = stop + 1 + length


def iso_date(digits: str) -> str:
    """ARC's 14 digits as WARC's date; missing or impossible parts become the least ones."""
    digits = re.sub(r"\D", "", digits)[:14]
    least, most = (1, 1, 1, 0, 0, 0), (9999, 12, 31, 23, 59, 59)
    cuts = (0, 4, 6, 8, 10, 12, 14)
    parts = [digits[a:b] for a, b in zip(cuts, cuts[1:])]
    values = [min(max(int(p), low), high) if p else low for p, low, high in zip(parts, least, most)]
    return "{:04d}-{:02d}-{:02d}T{:02d}:{:02d}:{:02d}Z".format(*values)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """An HTTP response's header, with its empty line, and its body."""
    stop = content.find(b"\r\n\r\n")
    return (content[: stop + 4], content[stop + 4 :]) if stop >= 0 else (content, b"")


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("latin-1") if found else None


_ARC_SQL = (
    "record_id string, rank long, type string, uri string, ip string, date string, mime string, head binary, "
    "payload binary, payload_bytes long, digest string, sha256 string, error string"
)
_ARC = pa.schema(
    [
        *((c, pa.string() if c != "rank" else pa.int64()) for c in ("record_id", "rank", "type", "uri", "ip", "date", "mime")),
        *((c, pa.binary()) for c in ("head", "payload")),
        ("payload_bytes", pa.int64()),
        *((c, pa.string()) for c in ("digest", "sha256", "error")),
    ]
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 256 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > limit:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def read_arc(spark: SparkSession, path: str, contents: bool = True) -> DataFrame:
    """One row per ARC record, with the WARC identifier, type, date and digests it gets.
    Without ``contents``, head and payload are read but not given: they are null."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for file, data in zip(batch.column("path"), batch.column("content")):
                name = os.path.basename(file.as_py())
                for at, header, content, error in parse_arc(_unpacked(data.as_py())):
                    identifier = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}')}>"
                    uri = header.get("URL", "")
                    http = content.startswith(b"HTTP/")
                    head, payload = split_http(content) if http else (b"", content)
                    rank = http_field(head, SEQUENCE) or ""
                    kind = "response" if http else "resource" if header else "metadata"
                    yield (
                        identifier,
                        int(rank) if re.fullmatch(r"-?\d{1,18}", rank) else None,
                        kind,
                        uri,
                        header.get("IP-address"),
                        iso_date(header.get("Archive-date", "")),
                        "application/http; msgtype=response" if http else header.get("Content-type", "application/octet-stream"),
                        head if contents else None,
                        payload if contents else None,
                        len(payload),
                        _sha1(payload),
                        hashlib.sha256(payload).hexdigest(),
                        error,
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda batches: _batches(rows(batches), _ARC), _ARC_SQL)


# --- WARC -----------------------------------------------------------------------------


def _warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without its last line feed, which the text writer adds."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None)
    return f"WARC/1.0\r\n{lines}\r\n".encode() + block + b"\r\n\r"


def arc_to_warc(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0) -> str:
    """Convert the ARC files of a folder to WARC files in another.

    Of responses with equal payloads of at least ``least_bytes`` that with the smallest
    sequence number (none counts last; then the smallest identifier) is written whole, the
    others as revisits that refer to it. Records that cannot be read become metadata.
    """
    columns = ["record_id", "type", "uri", "ip", "date", "mime", "head", "payload", "digest", "error"]
    records = read_arc(spark, arc).select(*columns)
    responses = (F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes)
    # Written, as it is read several times and each time would read all archives.
    brief = written(
        read_arc(spark, arc, contents=False).where(responses).select(
            "record_id", "digest", F.unhex("sha256").alias("sha256"), "payload_bytes", F.col("rank").isNull().alias("unranked"), "rank"
        ),
        "responses",
    )
    equal = ["digest", "sha256", "payload_bytes"]
    first = brief.groupBy(*equal).agg(F.min(F.struct("unranked", "rank", "record_id")).alias("first"))
    revisits = (
        brief.join(first, equal)
        .where(F.col("record_id") != F.col("first.record_id"))
        .select("record_id", F.col("first.record_id").alias("refers_to"))
    )
    files = _files(brief, F.col("payload_bytes") + 1024)
    joined = records.repartition(files, "record_id").join(revisits.repartition(files, "record_id"), "record_id", "left")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = f"software: {_ORIGIN}\r\nformat: WARC File Format 1.0\r\n".encode()
        out = [
            _warc_record(
                [("WARC-Type", "warcinfo"), ("WARC-Date", iso_date(_DATE)), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")],
                info,
            )
        ]
        size = 0
        for batch in batches:
            parts = (batch.slice(k, 256).to_pylist() for k in range(0, batch.num_rows, 256))
            for r in chain.from_iterable(parts):
                block = r["head"] if r["refers_to"] else r["head"] + r["payload"]
                fields = [
                    ("WARC-Type", "revisit" if r["refers_to"] else r["type"]),
                    ("WARC-Target-URI", r["uri"]),
                    ("WARC-Date", r["date"]),
                    ("WARC-Record-ID", r["record_id"]),
                    ("WARC-IP-Address", r["ip"]),
                    ("WARC-Profile", REVISIT_PROFILE if r["refers_to"] else None),
                    ("WARC-Refers-To", r["refers_to"]),
                    ("WARC-Truncated", "length" if r["error"] == "truncated" else None),
                    ("WARC-Payload-Digest", f"sha1:{r['digest']}"),
                    ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
                    ("Content-Type", r["mime"]),
                ]
                out.append(_warc_record(fields, block))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([_raw_strings(out)], ["value"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([_raw_strings(out)], ["value"])

    joined.mapInArrow(encode, "value string").write.options(**_ZIPPED).text(warc)
    return warc


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        stop = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        yield fields, data[stop + 4 : stop + 4 + length]
        at = stop + 4 + length


def read_warc(spark: SparkSession, path: str, contents: bool = True) -> DataFrame:
    """One row per WARC record: ``record_id, type, uri, date, refers_to, head, payload,
    declared_digest, digest, payload_bytes``; digest and size are of the payload that is
    there. Without ``contents``, the payload is read but not given: it is null."""
    names = ("record_id", "type", "uri", "date", "refers_to", "head", "payload", "declared_digest", "digest", "payload_bytes")
    kinds = {"head": "binary", "payload": "binary", "payload_bytes": "long"}
    types = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c, types[kinds.get(c, "string")]) for c in names])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for data in batch.column("content"):
                for fields, block in parse_warc(_unpacked(data.as_py())):
                    head, payload = split_http(block) if block.startswith(b"HTTP/") else (b"", block)
                    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    yield (
                        fields.get("warc-record-id"),
                        fields.get("warc-type"),
                        fields.get("warc-target-uri"),
                        fields.get("warc-date"),
                        fields.get("warc-refers-to"),
                        head,
                        payload if contents else None,
                        declared,
                        _sha1(payload),
                        len(payload),
                    )

    files = spark.read.format("binaryFile").load(path).select("content")
    sql = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in names)
    return files.mapInArrow(lambda batches: _batches(rows(batches), schema), sql)


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write all ``pages`` (page_id, url, html, anything else) as ARC files below ``folder``,
    convert them to WARC files, and read those back.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, one row per page:
    of equal payloads the smallest page_id is the response, all others are revisits that
    refer to it; of rows that share that page_id one is. A null html is an empty payload; a
    null url is about:blank; a null page_id comes last. No pages give no rows.
    """
    spark = pages.sparkSession
    warc = arc_to_warc(spark, write_arc(pages, f"{folder}/arc"), f"{folder}/warc")
    sequence = F.regexp_extract(F.decode("head", "ISO-8859-1"), rf"(?im)^{SEQUENCE}:[ \t]*(-?\d+)", 1)
    # Written, as the join below reads it twice and each time would read all archives.
    found = written(
        read_warc(spark, warc, contents=False).where("type in ('response', 'revisit')").select(
            "record_id",
            "type",
            "refers_to",
            F.when(sequence != "", sequence.cast("long")).alias("page_id"),
            "payload_bytes",
            "digest",
        ),
        "records",
    )
    whole = found.where("type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("first_id"),
        F.col("payload_bytes").alias("first_bytes"),
        F.col("digest").alias("first_digest"),
    )
    return (
        found.join(whole, "refers_to", "left")
        .select(
            "page_id",
            F.coalesce("first_bytes", "payload_bytes").alias("payload_bytes"),
            F.coalesce("first_digest", "digest").alias("payload_digest"),
            F.col("type").alias("record_type"),
            F.col("first_id").alias("refers_to"),
        )
    )
