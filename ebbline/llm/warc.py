"""Content-addressed web archive: payload bytes once, exact record headers apart, records rebuilt by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the archive format: version line, line end, revisit profile.
VERSION = "WARC/1.1"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"  # of records whose capture time is not known
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 160 bits are four groups of 40 bits, each eight digits of five bits."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    """One header line; nothing where the value is null, so that concat_ws leaves the line out."""
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, date: str = DATE, least_bytes: int = 0) -> None:
    """Write `pages` (page_id, url, html) as an archive of two Parquet tables under `path`.

    `payloads`: address (SHA-256), payload; each distinct payload is stored once. `headers`: page_id, header (the
    record's exact header block), address. Of the records whose payloads are equal and have `least_bytes` or more,
    the one with the largest page_id is the response and the others are revisits that refer to it.

    Two payloads under one digest stop the job (the digest is checked against the bytes), nothing is overwritten.
    Null html is the empty payload. Null url: no target line; line breaks in a url become %0D and %0A. A null
    page_id ranks below all others and has the id <urn:page:null>; rows repeating the largest page_id of a payload
    are all responses. Copies are combined in the tasks that read them, so a payload that fills a third of
    all rows is no hot spot; other columns of `pages` are not read.
    """
    rows = pages.select(
        "page_id",
        F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"address": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    rows.select("address", "payload").distinct().write.parquet(f"{path}/payloads")
    addresses = pages.sparkSession.read.parquet(f"{path}/payloads").groupBy("address").count()
    if clash := addresses.filter("count > 1").head():
        raise ValueError(f"two payloads share the digest {clash.address}")

    small = rows.select("page_id", "url", "address", "bytes", base32_sha1(F.col("payload")).alias("digest"))
    groups = small.groupBy("address").agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
    joined = small.join(groups, "address")
    revisit = (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    named = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    header = F.concat_ws(
        CRLF,
        F.lit(VERSION),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(named)),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("first_id")))),
        F.when(revisit, _line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
    )
    joined.select("page_id", header.alias("header"), "address").write.parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The archived records: page_id, header, payload (full, for revisits too), block (as in the record) and
    record: header, empty line, block, two line ends, byte for byte.

    Headers meet their payload by its address. Bytes whose digest isn't their address stop the job; a header
    without payload gives a null payload, so a lost payload shows.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    verified = stored.select(
        "address",
        F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("address"))).cast("binary"))
        .alias("payload"),
    )
    records = spark.read.parquet(f"{path}/headers").join(verified, "address", "left")
    revisit = F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    block = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    end = F.lit(CRLF + CRLF).cast("binary")
    record = F.concat(F.col("header").cast("binary"), end, F.col("block"), end)
    return records.withColumn("block", block).withColumn("record", record)


def header_field(name: str) -> Column:
    """The value of a header line; null where the record has no such line."""
    found = F.regexp_extract(F.col("header"), rf"\r\n{name}: ([^\r]*)", 1)
    return F.when(F.col("header").contains(f"{CRLF}{name}: "), found)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """What the records say: page_id, url, payload_bytes, payload_digest, record_type, refers_to, warc_date,
    record_bytes and record_sha256 (of the whole record, rebuilt). Sizes and digests are taken from the payload read
    back, types and references from the header; a header whose Content-Length isn't the length of its block, or whose
    WARC-Payload-Digest isn't that of the payload, stops the job.
    """
    records = read_records(spark, path)
    refers = page_of(header_field("WARC-Refers-To"))
    told = (header_field("Content-Length") == F.octet_length("block").cast("string")) & (
        header_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))
    )
    record = F.when(told | F.col("payload").isNull(), F.col("record")).otherwise(
        F.raise_error(F.concat(F.lit("header and payload differ: "), "header")).cast("binary")
    )
    return records.withColumn("record", record).select(
        "page_id",
        header_field("WARC-Target-URI").alias("url"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        F.when(F.length(refers) > 0, refers.cast("long")).alias("refers_to"),
        header_field("WARC-Date").alias("warc_date"),
        F.octet_length("record").cast("long").alias("record_bytes"),
        F.sha2("record", 256).alias("record_sha256"),
    )
