"""Operator 4: a content-addressed WARC archive.

The archive is two tables in one folder. `payloads` holds every distinct payload once, under its
SHA-256, and each digest is verified against the bytes when they are read. `headers` holds, for each
record, the exact bytes of its WARC and HTTP headers and the digest of its payload. The original
records come back by joining the two. Of records with equal payloads of at least `revisit_from`
bytes, that with the smallest id is a response and the others are revisits that carry headers only;
smaller payloads are always responses (but stored once all the same). Where rows repeat that id, one
of them is the response.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelyard.llm.common import stage

#: Format lines of WARC 1.1 records (fixed values of the format).
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _uuid(*columns: F.Column) -> F.Column:
    """A UUID made from a hash, so that a second run over the same files writes the same bytes."""
    h = F.md5(F.concat_ws("\x1f", *columns))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(cut[0], F.lit("-"), cut[1], F.lit("-3"), cut[2], F.lit("-a"), cut[3], F.lit("-"), cut[4])


def write(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_from: int = 100, date: str = "2024-01-01T00:00:00Z", rows_a_file: int = 200_000,
) -> None:
    """Write the archive of pages to path.

    Null payloads are empty ones; null urls are written as about:blank, and line ends in urls, which no
    header can hold, are left out. Repeated rows give a record each, with a record id of its own; of
    rows with one id and one payload the first by url, and then by place in the table, is the response. A
    null id is written as `null` and never chosen as the response while another record has the payload.
    Extra columns are not read, whatever their names. The payloads are shuffled once, by digest, with a
    partial aggregation first, so that a payload that a third of the rows share moves once a task; the
    rows without their payloads are a table of the archive (`rows`), so that a row keeps its place.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("about:blank")), r"[\r\n]", "").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    (
        rows.groupBy("digest").agg(F.first("payload").alias("payload"))
        .write.option("compression", "zstd").option("maxRecordsPerFile", rows_a_file).parquet(f"{path}/payloads")
    )
    (
        rows.select("page_id", "url", "digest", F.length("payload").cast("long").alias("size"), F.monotonically_increasing_id().alias("place"))
        .write.option("compression", "zstd").option("maxRecordsPerFile", 10 * rows_a_file).parquet(f"{path}/rows")
    )
    bare = spark.read.parquet(f"{path}/rows")
    first = (
        bare.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "place")).alias("first"))
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.place").alias("first_place"))
    )
    known = bare.join(first, "digest").withColumn(
        "record_type", F.when((F.col("size") >= revisit_from) & (F.col("place") != F.col("first_place")), "revisit").otherwise("response")
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    http = F.when(
        F.col("record_type") == "response",
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END)),
    ).otherwise(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8{END}"))
    block = F.length(http) + F.when(F.col("record_type") == "response", F.col("size")).otherwise(0)
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: <urn:uuid:"), _uuid(F.col("url"), page, F.col("digest"), F.col("place").cast("string")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nX-Page-Id: "), page,
        F.when(
            F.col("record_type") == "revisit",
            F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nX-Refers-To-Page-Id: "), F.coalesce(F.col("first_id").cast("string"), F.lit("null"))),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block, F.lit(END),
    )
    (
        known.select(F.col("digest"), head.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header"))
        .write.option("compression", "zstd").option("maxRecordsPerFile", 10 * rows_a_file).parquet(f"{path}/headers")
    )


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The records' headers, parsed from their bytes: no payload is read."""
    raw = spark.read.parquet(f"{path}/headers")
    head = F.col("warc_header").cast("string")

    def field(name: str) -> F.Column:
        got = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(got != "", got)

    page, refers = field("X-Page-Id"), field("X-Refers-To-Page-Id")
    return raw.select(
        "*",
        F.when(page != "null", page.cast("long")).alias("page_id"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Target-URI").alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("declared_digest"),
        F.when(refers != "null", refers.cast("long")).alias("refers_to"),
        field("Content-Length").cast("long").alias("content_length"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """digest, payload; bytes that don't have their digest end the job."""
    got = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    wrong = F.raise_error(F.concat(F.lit("payload is not what its digest says: "), F.col("digest")))
    return got.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong.cast("binary")).alias("payload"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records: the parsed header fields, `payload` (of revisits that of the record
    they refer to) and `record`, the exact bytes of the WARC record."""
    joined = read_headers(spark, path).join(read_payloads(spark, path), "digest")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.withColumn("record", F.concat("warc_header", "http_header", body, F.lit(END).cast("binary")))


def export_files(spark: SparkSession, path: str, to: str, records_a_file: int = 20_000) -> None:
    """Write plain .warc files (uncompressed text parts whose bytes are the records in id order)."""
    records = read_records(spark, path).repartitionByRange("page_id").sortWithinPartitions("page_id", "record_type")
    # a record ends with a line feed, which the text writer adds
    bare = F.expr("substring(record, 1, length(record) - 1)").cast("string")
    records.select(bare.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", records_a_file).text(to)


def archived(pages: DataFrame, path: str, **columns: str) -> DataFrame:
    """Write pages to an archive at path and read it back: one row for each record."""
    write(pages, path, **columns)
    records = read_records(pages.sparkSession, path)
    whole = F.length("http_header") + F.when(F.col("record_type") == "response", F.length("payload")).otherwise(0)
    wrong = F.raise_error(F.lit("a record's length is not what its header says")).cast("long")
    return records.select(
        "page_id",
        F.when(F.col("content_length") == whole, F.length("payload").cast("long")).otherwise(wrong).alias("payload_bytes"),
        F.col("declared_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
