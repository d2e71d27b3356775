"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing stays inside Spark's text source: a record is one string, the line separator is the two line ends that close a
record. Pages of equal payloads of at least ``REVISIT_BYTES`` bytes are stored once; the others refer to it.

Reading trusts no magic. A task per archive emits every place where ``WARC/1.1`` occurs, with the offset behind the
record that would start there. Real records are those on the chain from the file's start. They are found by pointer
jumping: in each round the offsets reached double, and every pointer is replaced by the one twice as far, so a file of n
records takes log2(n) rounds. Magic inside payloads is not on the chain. A chain that does not end at the file's length
is an error.

Archives are cut at about ``ARCHIVE_BYTES`` (a number of records from their mean size), as a task holds one archive.

Defined results: a null html is the empty payload; the largest page_id of equal payloads is the response, as are all
rows that share it; a null page_id never is the one referred to; line ends in a url are dropped; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.staging import small, staged
from vecloom.session import new_folder

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
MAGIC = b"WARC/1.1\r\n"
CLOSE = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")
_CANDIDATE = (
    "file string, offset bigint, next bigint, length bigint, record_type string, page_id string, refers_to string, url string, "
    "payload_bytes bigint, payload_digest string"
)


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One record per row of ``pages`` (page_id, url, html), in files of about ``archive_bytes`` below ``path``."""
    rows = pages.select("page_id", "url", "html", F.octet_length(_payload()).alias("n"), F.sha1(_payload().cast("binary")).alias("sha1"))
    facts = staged(rows.select("page_id", "n", "sha1"), "page-digests")
    total, count = facts.agg(F.sum("n"), F.count("*")).first()
    per_file = max(1, int(archive_bytes // ((total or 0) / max(1, count) + 500)))
    equal = facts.where(F.col("n") >= revisit_bytes).groupBy("sha1").agg(F.max("page_id").alias("first"), F.count("*").alias("c"))
    equal = staged(equal.where("c > 1").select(F.col("sha1").alias("equal_sha1"), "first"), "equal-payloads")

    shared = (F.col("sha1") == F.col("equal_sha1")) & (F.col("n") >= revisit_bytes)
    told = rows.join(small(equal), shared, "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit(_HTTP), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    url = F.translate("url", "\r\n", "")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")),
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), _urn(F.col("first")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"),
        F.lit("\r\n\r\n"), http, F.when(revisit, "").otherwise(_payload()),
    )
    told.select(record.alias("value")).write.option("lineSep", CLOSE.decode()).option("maxRecordsPerFile", per_file).text(path)


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _urn_id(value: bytes | None) -> str | None:
    found = re.fullmatch(rb"<urn:page:(.*)>", value or b"")
    return _text(found[1]) if found and found[1] else None


def candidates(content: bytes) -> Iterator[tuple]:
    """Every offset at which a record might start, the offset behind it (-1: no record), and what it would hold."""
    at = content.find(MAGIC)
    while at >= 0:
        yield at, *_record(content, at)
        at = content.find(MAGIC, at + 1)


def _record(content: bytes, at: int) -> tuple:
    nothing = (-1, len(content), *[None] * 6)
    head = content.find(CLOSE, at)
    if head < 0:
        return nothing
    fields = {k.lower(): v for k, v in _FIELD.findall(content[at + len(MAGIC) : head])}
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        return nothing
    block, stop = head + 4, head + 4 + int(length)
    if content[stop : stop + 4] != CLOSE:
        return nothing
    kind = _text(fields.get(b"warc-type"))
    http = content.find(CLOSE, block, stop)
    inside = dict(_FIELD.findall(content[block:http])) if http >= 0 else {}
    if kind == "revisit":
        size = int(inside.get(b"Content-Length", b"0"))
        digest = _text(fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:"))
    else:
        payload = memoryview(content)[http + 4 if http >= 0 else block : stop]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    ids = _urn_id(fields.get(b"warc-record-id")), _urn_id(fields.get(b"warc-refers-to"))
    return stop + 4, len(content), kind, *ids, _text(fields.get(b"warc-target-uri")), size, digest


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _CANDIDATE.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows = [(path.rsplit("/", 1)[-1], *row) for row in candidates(content.as_py())]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), *[pa.int64()] * 3, *[pa.string()] * 4, pa.int64(), pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def reachable(pointers: DataFrame) -> DataFrame:
    """(file, offset) on the chains from offset 0 of ``pointers`` (file, offset, next), and the offset behind each chain."""
    jump = pointers
    reached = pointers.where("offset = 0").select("file", "offset")
    while True:
        step = reached.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        reached = staged(reached.union(step), "reached")
        far = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = staged(jump.join(far, ["file", "next"]).select("file", "offset", F.col("far").alias("next")), "jumps")
        if jump.isEmpty():
            return reached


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id (string), url, record_type, refers_to (string), payload_bytes, payload_digest of every real record."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    found = staged(files.select("path", "content").mapInArrow(_candidate_rows, _CANDIDATE), "candidates")
    reached = reachable(found.where("next > 0").select("file", "offset", "next"))
    ends = reached.join(found.select("file", F.col("length").alias("offset")).distinct(), ["file", "offset"], "left_semi")
    broken = files.select(F.regexp_extract("path", "[^/]+$", 0).alias("file")).join(ends, "file", "left_anti")
    if not broken.isEmpty():
        raise ValueError(f"no chain of records leads through {broken.first()['file']}")
    return found.join(reached, ["file", "offset"], "left_semi").drop("file", "offset", "next", "length")


def op3_warc_chain(spark, sf_dir):
    path = new_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return read_archives(spark, path).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
  f AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""
