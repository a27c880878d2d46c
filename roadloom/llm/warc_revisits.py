"""WARC revisit resolution.

Every page becomes a record. Records are known by the SHA-1 and SHA-256 of their payload; only these headers are shuffled. Of equal
payloads of at least ``least_bytes`` the record with the largest page_id stays the response, the others become revisits that refer to it.
Archives are written with fresh headers, gzip-compressed, a bounded number of records per file, in the shared scratch folder or
a folder of the caller's. Reading takes whole archive files, follows Content-Length, digests every payload anew and gives revisits the
size and digest of the response they refer to.

Defined cases: a null html is an empty payload; control characters in a URL are written as %XX, a null URL is left out; rows that
repeat a page_id: where the largest page_id of equal payloads is on several rows, all those are responses, and other rows are judged one by
one; a row without page_id is a response of its own; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize, new_folder

RECORDS_PER_FILE = 2000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(batches):
    for batch in batches:
        payloads = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), pa.array([len(p) for p in payloads], pa.int64()), pa.array([base32_sha1(p) for p in payloads], pa.string()),
                pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
            ],
            names=["page_id", "payload_bytes", "payload_digest", "strong"],
        )


def resolve(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows (page_id, url, html, payload_digest, refers_to): refers_to is null for responses."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    headers = materialize(rows.select("page_id", "html").mapInArrow(_headers, "page_id long, payload_bytes long, payload_digest string, strong binary"), "headers")
    same = ["payload_digest", "strong", "payload_bytes"]
    shared = headers.where(F.col("payload_bytes") >= least_bytes).groupBy(*same).agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = headers.join(shared, same).where("page_id < largest").select("page_id", "payload_digest", "strong", F.col("largest").alias("refers_to")).distinct()
    payload = F.coalesce("html", F.lit("")).cast("binary")
    # a page_id is nearly always one payload; where rows repeat it with other payloads, the digest tells them apart
    return rows.join(revisits, (rows["page_id"] == revisits["page_id"]) & (F.unhex(F.sha2(payload, 256)) == revisits["strong"]), "left").select(
        rows["page_id"], "url", "html", "refers_to"
    )


def _record_id(page_id) -> str:
    return f"<urn:uuid:{hashlib.md5(b'page' + str(page_id).encode()).hexdigest()}>"


def _texts(date: str):
    def run(batches):
        for batch in batches:
            out = []
            for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                html = html or ""
                payload = html.encode("utf-8", "surrogatepass")
                lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
                if page_id is not None:
                    lines.append(f"X-Page-ID: {page_id}")
                if url is not None:
                    lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
                lines.append(f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}")
                if refers is not None:
                    lines += [f"WARC-Refers-To: {_record_id(refers)}", f"X-Refers-To-Page-ID: {refers}", f"WARC-Profile: {PROFILE}"]
                    html, payload = "", b""
                lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
                out.append("\r\n".join(lines) + "\r\n\r\n" + html)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return run


def write_archives(resolved: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", records: int = RECORDS_PER_FILE) -> str:
    """Write the records under ``path``; the two line ends after a record's block are the text writer's separator."""
    resolved.mapInArrow(_texts(date), "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records).text(path)
    return path


def parse(data: bytes):
    """(headers, payload) of every record in an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8", "surrogatepass").split("\r\n")[1:])
        begin = end + 4
        at = begin + int(head["Content-Length"])
        yield head, data[begin:at]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end with two line ends")
        at += 4


def _records(batches):
    for batch in batches:
        for blob in batch.column("content"):
            data = zlib.decompressobj(31).decompress(blob.as_buffer())
            rows: list[tuple] = []
            for head, payload in parse(data):
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = head["WARC-Type"]
                if kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} does not have the digest in its header")
                number = lambda k, head=head: int(head[k]) if k in head else None
                rows.append((number("X-Page-ID"), head.get("WARC-Target-URI"), len(payload) if kind == "response" else None, digest, kind, number("X-Refers-To-Page-ID"), payload.decode("utf-8", "surrogatepass") if kind == "response" else None))
                if len(rows) == 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, revisits with the size of the payload they stand for; ``payload`` is null for them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_records, RECORD)


def with_originals(records: DataFrame) -> DataFrame:
    """Join revisits to the responses they refer to, by page and digest."""
    plain = records.drop("payload")
    wanted = plain.where("record_type = 'revisit'")
    originals = plain.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("original_bytes")
    ).distinct()
    # several revisits of one response are split over salted copies of its header by the join's skew handling
    found = wanted.join(originals, ["refers_to", "payload_digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return plain.where("record_type = 'response'").select(columns).union(found.withColumn("payload_bytes", F.col("original_bytes")).select(columns))


def archive_pages(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write the pages' archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to, url."""
    spark = pages.sparkSession
    path = write_archives(resolve(pages, least_bytes), path or f"{new_folder(spark, 'warc')}/archives")
    return with_originals(materialize(read_archives(spark, path).drop("payload").withColumn("payload", F.lit(None).cast("string")), "records"))
