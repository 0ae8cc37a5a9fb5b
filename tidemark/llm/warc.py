"""Content-addressed WARC archive.

``write_archive`` stores two tables in one folder: ``payloads`` holds each distinct payload once,
compressed, under its SHA-256; ``records`` holds the exact header bytes of every record with its
digest. Equal digests are verified by length and a second hash before one payload stands for all.
``read_archive`` joins both again, checks every payload against the digest in its header, and gives
back the records. ``export_warc`` and ``import_warc`` write and read ordinary WARC files.

Of the records whose equal payload has at least ``least`` bytes, those with the smallest id are
responses and the others revisit it; smaller payloads are responses always.

Defined cases: a NULL payload is empty; a NULL URL is an empty target; control characters and
blanks in a URL are percent-encoded; rows with a NULL id never become the target of revisits, and
if a payload has no id at all its records are responses; repeated rows give a record each (those
of the smallest id are all responses). Payloads are stored whole; an empty table makes an empty archive;
extra columns are left out.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.arrow import named
from tidemark.llm.graph import stored

LEAST = 100
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 2000
_RECORD_END = "\r\n\r\n"


def _packed(batches):
    """(id, url, payload) to (id, url, size, digest, second hash, compressed payload)."""
    import xxhash

    for batch in batches:
        raw = [(v or "").encode("utf-8", "surrogatepass") for v in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1),
            pa.array(list(map(len, raw)), pa.int64()),
            pa.array([hashlib.sha256(r).digest() for r in raw], pa.binary()),
            pa.array([xxhash.xxh3_64_intdigest(r) >> 1 for r in raw], pa.int64()),
            pa.array([zlib.compress(r, LEVEL) for r in raw], pa.binary()),
        ], names=["id", "url", "size", "digest", "second", "packed"])


def _percent(url: Column) -> Column:
    """Blanks and control characters of a header value as %XX."""
    for i in [*range(33), 127]:
        url = F.replace(url, F.lit(chr(i)), F.lit(f"%{i:02X}"))
    return url


def _header(url: Column, digest: Column, size: Column, kind: Column, target: Column) -> Column:
    """Exact bytes before the payload: the WARC header, and the HTTP header of the response."""
    def urn(value: Column) -> Column:
        h = F.md5(F.coalesce(value.cast("string"), F.lit("null")).cast("binary"))
        cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        parts = F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts])
        return F.concat(F.lit("<urn:uuid:"), parts, F.lit(">"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"), F.lit("\r\n\r\n"),
    )
    revisit = kind == "revisit"
    block = F.length(http) + F.when(revisit, F.lit(0)).otherwise(size)
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        _percent(F.coalesce(url, F.lit(""))),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.lower(F.hex(digest)),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                  "identical-payload-digest\r\nWARC-Refers-To: "), urn(target),
            F.lit("\r\nX-Refers-To-Key: "), target.cast("string"),
        )).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block.cast("string"), F.lit("\r\n\r\n"), http,
    ).cast("binary")


def write_archive(
    pages: DataFrame, folder: str, by: str = "page_id", url: str = "url", payload: str = "html",
    least: int = LEAST,
) -> str:
    """Write both tables under ``folder`` and return it."""
    rows = pages.select(
        named(by).cast("long").alias("id"), named(url).alias("url"), named(payload).alias("html")
    ).mapInArrow(
        _packed, "id long, url string, size long, digest binary, second long, packed binary"
    )
    same = (F.min("size") == F.max("size")) & (F.min("second") == F.max("second"))
    # Equal payloads meet once per map task, then once: a very frequent one never gathers.
    rows.groupBy("digest").agg(
        same.alias("same"), F.first("packed").alias("packed")
    ).select("digest", F.when(F.col("same"), F.col("packed")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads under "), F.hex("digest")))
    ).alias("packed")).write.option("compression", "uncompressed").parquet(f"{folder}/payloads")
    # The same digests without the payloads, from Spark's own functions.
    data = F.coalesce(named(payload), F.lit("")).cast("binary")
    narrow = stored(pages.select(
        named(by).cast("long").alias("id"), named(url).alias("url"),
        F.octet_length(data).cast("long").alias("size"),
        F.unhex(F.sha2(data, 256)).alias("digest"),
    ), "record_digests")
    first = narrow.where(F.col("size") >= least).groupBy("digest").agg(
        F.min("id").alias("target"), F.count("*").alias("n")
    ).where("n > 1 and target is not null").select(F.col("digest").alias("d"), "target")
    joined = narrow.join(first, F.col("digest") == F.col("d"), "left")
    revisit = F.col("target").isNotNull() & ~F.col("id").eqNullSafe(F.col("target"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    joined.select(
        "id", "digest", _header(
            F.col("url"), F.col("digest"), F.col("size"), kind, F.col("target")
        ).alias("header"),
    ).write.parquet(f"{folder}/records")
    return folder


def _restored(batches):
    for batch in batches:
        digests, packed = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        out = []
        for digest, value in zip(digests, packed):
            raw = zlib.decompress(value)
            if hashlib.sha256(raw).digest() != digest:
                raise ValueError(f"payload does not match its digest {digest.hex()}")
            out.append(raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.binary())],
            names=["id", "header", "payload"],
        )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: id, header (its exact bytes) and payload, also of revisits."""
    records, payloads = (spark.read.parquet(f"{folder}/{t}") for t in ("records", "payloads"))
    stray = payloads.withColumnRenamed("digest", "d")
    joined = records.join(stray, records["digest"] == stray["d"]).select(
        "id", "header", "digest", "packed"
    )
    return joined.mapInArrow(_restored, "id long, header binary, payload binary")


def fields(records: DataFrame) -> DataFrame:
    """id, payload size and digest, and type and target as the header states them."""
    header = F.decode("header", "UTF-8")

    def value(name: str) -> Column:
        found = F.regexp_extract(header, f"\r\n{name}: ([^\r]*)\r\n", 1)
        return F.when(found != "", found)

    return records.select(
        "id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        F.regexp_extract(header, "^WARC/1\\.1\r\nWARC-Type: ([a-z]+)\r\n", 1).alias("record_type"),
        value("X-Refers-To-Key").cast("long").alias("refers_to"),
    )


def export_warc(records: DataFrame, folder: str) -> str:
    """Gzip WARC files: every record's header, the payload of responses, and the end mark."""
    text = F.decode("header", "UTF-8")
    body = F.when(
        text.startswith("WARC/1.1\r\nWARC-Type: revisit\r\n"), F.lit("")
    ).otherwise(F.decode("payload", "UTF-8"))
    records.select(F.concat(text, body).alias("value")).write.option(
        "lineSep", _RECORD_END
    ).option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(folder)
    return folder


def import_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of gzip or plain WARC files by their Content-Length: header and block bytes.

    A file is read by one task, so files must be small enough for its memory; exported ones hold
    ``RECORDS_PER_FILE`` records at most.
    """
    def parsed(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                at, heads, blocks = 0, [], []
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    head = data[at:end]
                    length = next(
                        int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))
                        if k.lower() == b"content-length"
                    )
                    heads.append(head)
                    blocks.append(data[end:end + length])
                    at = end + length + 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(heads, pa.binary()), pa.array(blocks, pa.binary())],
                    names=["header", "block"],
                )

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(parsed, "header binary, block binary")


def report(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` to an archive in ``folder``, read it back and describe each record."""
    write_archive(pages, folder)
    return fields(read_archive(pages.sparkSession, folder)).withColumnRenamed("id", "page_id")
