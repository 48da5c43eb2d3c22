"""WARC archives in which equal payloads are stored once.

Revisit resolution: the headers of all captures (page id, size, payload digest) are
shuffled by digest, without payloads, and reduced to the first capture of each digest that
occurs again. Captures are joined with that reduced table and written, responses with
payload, the others as ``revisit`` records that name their original, all under fresh
headers. Reading joins revisits to the responses they refer to.

A record is text in UTF-8 and ends with two line breaks, which is what Spark's text
writer puts behind each row, so archives are written by Spark into any file system it
knows, and read again as binary files. Framing goes by ``Content-Length`` alone; payloads
may hold anything, record starts included.

Defined results: payload null: empty. Payloads below ``MIN_BYTES`` are never revisits.
page_id null: stored, never an original. Rows that repeat the page_id of the original:
responses as well. Url null: the header is left out; line breaks in it are escaped. An
empty table gives no records. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, shared_folder, table, written

MIN_BYTES = 100
#: Captures of this size and more get a file of their own; of the others, so many share one.
LARGE_BYTES = 1 << 20
FILE_RECORDS = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, record_type string, refers_to long, header_digest string, payload_digest string, payload_bytes long"


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, bytes, digest of each row."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("digest")
    )


def originals(found: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(digest, original) of the payloads that occur more than once: a shuffle of headers alone."""
    return (
        found.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("copies"))
        .where("copies > 1 and original is not null")
        .select("digest", "original")
    )


def record_text(date: F.Column) -> F.Column:
    """A WARC record but for the two line breaks at its end."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, body)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    headers = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("original").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(headers, F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> None:
    """Deduplicated archives of all rows, as gzip files below ``folder``."""
    found = captures(pages)
    first = written(originals(found, min_bytes))
    large = found.where(F.col("bytes") >= LARGE_BYTES).select("page_id").take(1)
    date = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    typed = found.join(first, "digest", "left").withColumn(
        "record_type",
        F.when(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.lit("revisit"))
        .otherwise(F.lit("response")),
    )
    for name, rows, limit in (
        ("shared", typed.where(F.col("bytes") < LARGE_BYTES), FILE_RECORDS),
        ("single", typed.where(F.col("bytes") >= LARGE_BYTES), 1),
    ):
        if name == "shared" or large:
            rows.select(record_text(date).alias("value")).write.option("lineSep", "\r\n\r\n").option(
                "maxRecordsPerFile", limit
            ).option("compression", "gzip").text(f"{folder}/{name}")


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record starts at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield headers, data[start:stop]
        at = stop + 4


def _page(uri: str | None) -> int | None:
    name = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("", "none") else int(name)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RECORDS.split(", ")])
    for batch in batches:
        for packed in batch.column(0):
            rows = []
            for headers, block in parsed(zlib.decompress(packed.as_buffer(), 31)):
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                kept = headers["WARC-Type"] == "response"
                rows.append((
                    _page(headers["WARC-Record-ID"]),
                    headers["WARC-Type"],
                    _page(headers.get("WARC-Refers-To")),
                    headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                    hashlib.sha256(payload).hexdigest() if kept else None,
                    len(payload) if kept else None,
                ))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Per record: what its headers say and, from the payload itself, digest and size.

    Revisits take both from the response they refer to.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
    records = files.load(folder).select("content").mapInArrow(_records, RECORDS)
    records = written(records)
    payloads = (
        records.where("record_type = 'response' and page_id is not null")
        .select(
            F.col("page_id").alias("original"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes")
        )
        .dropDuplicates(["original", "digest"])
    )
    revisits = records.where("record_type = 'revisit'").join(
        payloads, (F.col("refers_to") == F.col("original")) & (F.col("header_digest") == F.col("digest")), "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.where("record_type = 'response'").select(columns).union(
        revisits.select("page_id", "bytes", "digest", "record_type", "refers_to")
    )


SQL = """
WITH captured AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM captured
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM firsts
"""


@query("op5_warc_revisits", SQL)
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder)
