"""WARC writing, reading and transaction assembly.

Writing: Spark's text writer with the record terminator ``\\r\\n\\r\\n`` as line
separator writes valid WARC/1.1 files in the shared folder, with the usual
commit protocol, so lost tasks are simply run again.  Each capture is three
records: request, response (or revisit) and metadata; request and metadata
name the response in ``WARC-Concurrent-To``.  Files are compressed as a whole.

Reading: whole files are parsed in tasks by ``Content-Length`` (never by
searching for separators), streaming through the decompressed bytes.
Assembly joins the three kinds of record through the concurrent-to
identifiers, wherever they were read, and emits one nested row per capture."""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, materialize

MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 4000
_END = "\r\n\r\n"

RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, "
    "payload_digest string, block_sha256 string, block_bytes bigint, fields map<string,string>, block binary"
)


def _record(headers: list, block):
    """A record as text: the version line, headers, a blank line, the block."""
    lines = [F.lit("WARC/1.1\r\n")]
    for name, value in headers:
        lines.append(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))
    size = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), size, F.lit("\r\n\r\n"), block)


def _uri(kind: str, ident):
    """Record ids name the kind and the page: stable when a task runs again."""
    return F.concat(F.lit(f"<urn:capture:{kind}:"), ident.cast("string"), F.lit(">"))


def first_of_equal(pages: DataFrame, ident: str, payload: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``payload_bytes``, ``digest`` and ``first_id``: the smallest id
    with an equal payload of at least ``min_bytes``, where that is another
    page.  Only digests that repeat are joined back."""
    sized = pages.withColumn("payload_bytes", F.octet_length(payload).cast("bigint")).withColumn("digest", F.sha2(F.col(payload).cast("binary"), 256))
    ids = sized.where(F.col("payload_bytes") >= min_bytes).select(F.col(ident).alias("id"), "digest")
    repeated = ids.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = ids.join(repeated, "digest").where("id <> first_id").select(F.col("id").alias(ident), "first_id").distinct()
    return sized.join(later, ident, "left")


def write_warc(pages: DataFrame, path: str, ident: str = "page_id", url: str = "url", payload: str = "html", date: str = "2025-01-01T00:00:00Z") -> None:
    """Write one capture per row of ``pages`` under ``path``.  A null payload
    or url is empty; line breaks in a url become spaces.  Rows need distinct
    ids to be told apart; a null id is written as ``null`` and never revisits,
    and captures that share an id share the requests and metadata of one of
    them.  Other columns are ignored.  Of equal payloads the smallest id is written as response and
    the others as revisits, which carry no payload again."""
    src = pages.select(
        F.col(ident).alias("id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\r\n]", " ").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    rows = first_of_equal(src, "id", "payload")
    ident_text = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    response = _uri("response", ident_text)
    revisit = F.col("first_id").isNotNull()
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))]
    answer = [("WARC-Record-ID", response), *common, ("WARC-Payload-Digest", digest)]
    whole = _record([("WARC-Type", F.lit("response")), *answer, ("Content-Type", F.lit("text/html"))], F.col("payload"))
    again = _record(
        [
            ("WARC-Type", F.lit("revisit")), *answer,
            ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Refers-To", _uri("response", F.col("first_id"))),
        ],
        F.lit(""),
    )
    asked = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uri("request", ident_text)), *common, ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    about = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uri("metadata", ident_text)), *common, ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("capture-id: "), ident_text, F.lit("\r\npayload-bytes: "), F.col("payload_bytes").cast("string"), F.lit("\r\n")),
    )
    value = F.concat(asked, F.lit(_END), F.when(revisit, again).otherwise(whole), F.lit(_END), about)
    writer = rows.select(value.alias("value")).write.option("lineSep", _END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class _Inflating(io.RawIOBase):
    """A gzip stream (one or many members) as a readable; plain bytes pass through."""

    def __init__(self, raw: bytes):
        self.rest = memoryview(raw)
        self.packed = raw[:2] == b"\x1f\x8b"
        self.member = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while len(self.rest):
            if not self.packed:
                n = min(len(target), len(self.rest))
                target[:n] = self.rest[:n]
                self.rest = self.rest[n:]
                return n
            out = self.member.decompress(self.rest, len(target))
            left = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            self.rest = self.rest[len(self.rest) - len(left) :]
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            if out:
                target[: len(out)] = out
                return len(out)
        return 0


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of every record of a WARC file."""
    stream = io.BufferedReader(_Inflating(raw), 1 << 20)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers.get("content-length", 0))
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def read_warc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record under ``path`` (plain or gzip, any member layout).
    ``fields`` holds the lines of a warc-fields block; without ``blocks`` the
    block itself is left out and only its size and SHA-256 are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "concurrent_to", "refers_to", "payload_digest", "block_sha256")]
                           + [("block_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("block", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for h, block in parse_records(content.as_buffer().to_pybytes()):
                    lines = block.decode().splitlines() if h.get("content-type") == "application/warc-fields" else []
                    rows.append({
                        "record_id": h.get("warc-record-id"), "record_type": h.get("warc-type"), "target_uri": h.get("warc-target-uri"),
                        "concurrent_to": h.get("warc-concurrent-to"), "refers_to": h.get("warc-refers-to"), "payload_digest": h.get("warc-payload-digest"),
                        "block_sha256": hashlib.sha256(block).hexdigest(), "block_bytes": len(block),
                        "fields": [(a.strip(), b.strip()) for a, _, b in (x.partition(":") for x in lines) if a], "block": block if blocks else None,
                    })
                    held += len(block) if blocks else 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id, target_uri, answer, request,
    metadata``; answer is the response or revisit, joined with the request and
    metadata records that are concurrent to it.  An answer without them keeps
    null structs; records that name no answer found here are dropped.  If
    several records of a kind name one answer, the smallest record id counts."""
    body = F.struct("record_id", "record_type", "refers_to", "payload_digest", "block_sha256", "block_bytes", "fields", "block")
    answers = records.where(F.col("record_type").isin("response", "revisit")).select(F.col("record_id").alias("id"), "target_uri", body.alias("answer"))

    def side(kind: str) -> DataFrame:
        own = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        return own.groupBy(F.col("concurrent_to").alias("id")).agg(F.min_by(body, F.col("record_id")).alias(kind))

    return answers.join(side("request"), "id", "left").join(side("metadata"), "id", "left").withColumnRenamed("id", "record_id")


def with_repeated(captures: DataFrame) -> DataFrame:
    """``captures`` plus ``repeated``: for a revisit the response it refers to,
    null where that was not read.  Only responses that something refers to are
    joined, so a response with many revisits meets them as one small row."""
    named = captures.where("answer.record_type = 'revisit'").select(F.col("answer.refers_to").alias("target")).distinct()
    body = F.col("answer").dropFields("block").alias("repeated")
    found = captures.where("answer.record_type = 'response'").select(F.col("record_id").alias("target"), body).join(named, "target", "left_semi")
    first = found.groupBy("target").agg(F.min_by("repeated", F.col("repeated.block_sha256")).alias("repeated"))
    return captures.join(first, F.col("answer.refers_to") == F.col("target"), "left").drop("target")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC files, read back and assembled."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-warc-{uuid.uuid4().hex}"
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    records = materialize(read_warc(spark, path, blocks=False), "records")
    captures = with_repeated(assemble(records)).select(
        F.col("metadata.fields")["capture-id"].try_cast("bigint").alias("page_id"),
        F.col("answer.record_type").alias("record_type"),
        F.col("answer.refers_to").alias("refers"),
        F.coalesce("repeated", F.col("answer").dropFields("block")).alias("whole"),
        (F.col("request.block_bytes") > 0).alias("has_request"),
    )
    # sizes and digests are measured on blocks read back; a revisit's are
    # those of the response it refers to
    return captures.select(
        "page_id",
        F.col("whole.block_bytes").alias("payload_bytes"),
        F.col("whole.block_sha256").alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers", "response:(-?[0-9]+)>", 1).try_cast("bigint").alias("refers_to"),
        F.coalesce("has_request", F.lit(False)).alias("has_request"),
    )


OP8_SQL = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to, true AS has_request
FROM f
"""
