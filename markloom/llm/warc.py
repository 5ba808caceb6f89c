"""WARC archives with revisit resolution.

1. Headers (page, payload digest, payload size) are shuffled by digest, without payloads. Of equal payloads
   of at least ``least`` bytes the one with the largest page id is the original response; the decision is a
   combining aggregate, so a payload that a third of all pages share is one row of each task.
2. Headers join their original; pages join their decision. Responses carry their payload, revisits only a
   header that refers to the original.
3. Records are written as WARC/1.1 text with Spark's text writer, whose line separator is the blank line that
   ends a record; files are cut at the number of records that hold ``FILE_BYTES`` on average, and compressed whole.
4. ``read_archives`` reads the files as binary and parses records by their Content-Length.

Defined results: a null html is the empty payload; a null url has no WARC-Target-URI; a null page_id has no
page header and comes back null, and counts as smaller than any other id; of rows equal in page_id and html one is
the response and the others revisit it; an empty table gives an empty archive and no rows; line breaks in
a url become blanks; columns besides page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import through_table, work_dir

#: Payload bytes per archive file, on average.
FILE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: Column) -> Column:
    """SHA-1 in base 32, upper case: every five hexadecimal digits are four of base 32."""
    sha = F.sha1(payload.cast("binary"))
    part = lambda k: F.lpad(F.conv(F.substring(sha, 5 * k + 1, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[part(k) for k in range(8)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def resolve(pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per distinct (page_id, digest): n (rows), size, original (page id) and whether it is the original."""
    heads = pages.select("page_id", digest(_payload()).alias("digest"), F.octet_length(_payload()).cast("long").alias("size"))
    heads = heads.groupBy("page_id", "digest").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    first = heads.groupBy("digest").agg(F.max("page_id").alias("original"))
    return heads.join(first, "digest").select(
        "page_id", "digest", "size", "n", "original",
        (F.col("page_id").eqNullSafe(F.col("original")) | (F.col("size") < least)).alias("is_original"),
    )


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per page: its record without the closing blank line, and the payload's size."""
    decided = through_table(resolve(pages, least), "revisits")
    decided = decided.select(*[F.col(c).alias(f"r_{c}") for c in decided.columns])
    keyed = pages.select("page_id", "url", _payload().alias("payload")).withColumn("digest", digest(F.col("payload")))
    same = F.col("page_id").eqNullSafe(F.col("r_page_id")) & (F.col("digest") == F.col("r_digest"))
    single = F.col("r_n") == 1
    rows = keyed.join(decided.where(single), same).withColumn("response", F.col("r_is_original"))
    if not decided.where(~single).isEmpty():
        # Rows equal in page and payload are one group; its records are made from one of them and its count.
        several = keyed.join(decided.where(~single), same)
        ends = [F.max(c).alias(c) for c in several.columns if c not in ("r_page_id", "r_digest")]
        once = several.groupBy("r_page_id", "r_digest").agg(*ends)
        originals = F.when(F.col("r_size") < least, F.col("r_n")).otherwise(F.col("r_is_original").cast("long"))
        kinds = F.concat(
            F.array_repeat(F.lit(True), originals.cast("int")),
            F.array_repeat(F.lit(False), (F.col("r_n") - originals).cast("int")),
        )
        rows = rows.unionByName(once.withColumn("response", F.explode(kinds)))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    some = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.col("r_size")), F.lit("\r\n")
    )
    block = F.when(F.col("response"), F.concat(http, F.col("payload"))).otherwise(http)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("response"), F.lit("response")).otherwise(F.lit("revisit"))),
        some("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        line("WARC-Date", F.lit(DATE)),
        some("X-Page-Id", F.col("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("r_size")),
        F.when(F.col("response"), F.lit("")).otherwise(
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                some("X-Refers-To-Page-Id", F.col("r_original")),
            )
        ),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("block")),
        F.lit("\r\n"),
    )
    return rows.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = 0, file_bytes: int = FILE_BYTES) -> None:
    mean = pages.agg(F.coalesce(F.avg(F.octet_length("html")), F.lit(0.0)).alias("b")).first().b  # one number
    out = records(pages, least).write.option("maxRecordsPerFile", max(1, int(file_bytes / (mean + 500))))
    out.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        body = end + 4
        at = body + int(head["Content-Length"]) + 4
        kind = head["WARC-Type"]
        payload = data[data.index(b"\r\n\r\n", body) + 4 : at - 4] if kind == "response" else None
        size, sha = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
        if payload is not None and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != sha):
            raise ValueError(f"the payload that ends at byte {at} differs from its digest")
        number = lambda name: int(head[name]) if name in head else None  # noqa: B023, E731
        yield number("X-Page-Id"), size, sha, kind, number("X-Refers-To-Page-Id"), payload


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives below a folder."""
    names = [f.split()[0] for f in READ.split(", ")]
    schema = READ if with_payload else READ.rpartition(",")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        width = len(names) - (not with_payload)
        for batch in batches:
            for content in batch.column("content"):
                data = zlib.decompress(content.as_py(), 47)
                rows, held = [], 0
                for r in parse(data):
                    rows.append(r)
                    held += len(r[5] or b"") if with_payload else 100
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)][:width], names[:width])
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)][:width], names[:width])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, schema)


def warc_rows(pages: DataFrame) -> DataFrame:
    """Write the archives to the shared folder, read them back: the contract's columns."""
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)


SQL = """
WITH h AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT rid, page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS sha FROM h),
k AS (
  SELECT *, max(page_id) OVER (PARTITION BY sha) AS original, row_number() OVER (PARTITION BY page_id, sha ORDER BY rid) AS copy,
    translate(array_to_string(list_transform(range(0, 8), lambda i: to_base(('0x' || substr(sha, (5 * i + 1)::BIGINT, 5))::BIGINT, 32, 4)), ''),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest FROM s)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM original AND copy = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM original AND copy = 1 THEN NULL ELSE original END AS refers_to FROM k"""
