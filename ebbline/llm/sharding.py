"""Proportional stratified interleaving: shards of even size that all carry the corpus mixture of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.tables import whole_text
from ebbline.workspace import stage

ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 1_024


def _offsets(counts: DataFrame, within: list[str], bucket: str, name: str) -> DataFrame:
    """Rows in the buckets before each bucket, per group of `within`."""
    order = Window.partitionBy(*within).orderBy(bucket) if within else Window.orderBy(bucket)
    before = F.sum("rows_here").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn(name, F.coalesce(before, F.lit(0)))


def stratified_shards(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """Put every row of `docs` into one of `shards` shards; row counts differ by one at most.

    Rows are shuffled within their source by a seeded hash and ranked there; the fractional rank
    (2 rank + 1) / (2 rows of the source) orders all rows, and equal cuts of that order are the shards, so each
    shard holds every source in its corpus share, within one row or so. Ranks are exact at any size: hash
    ranges (then ranges of the fractional rank) are counted first, so a task ranks the rows of one range only and
    a source that holds most rows is spread over all tasks. The number of ranges changes no result.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot (from 0 in each shard),
    grown_shard (null: only a key law knows it), source.
    Null text: size 1 and the checksum of no bytes. Null source: a source of its own. Null doc_id: hashed as the
    text 'null'. Rows that repeat an id are ordered by checksum and size; rows equal in all of these change
    places without a trace. An empty table gives no rows. Other columns of `docs` are not read.
    """
    total = docs.count()
    buckets = max(LEAST_BUCKETS, -(-total // ROWS_PER_BUCKET))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("stratum"),
        key.alias("key"),
    )
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.shiftright(place * F.lit(buckets).cast("long"), 32))
    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("rows_here"))
    strata = _offsets(counts, ["stratum"], "bucket", "before").withColumn(
        "stratum_rows", F.sum("rows_here").over(Window.partitionBy("stratum"))
    )
    local = Window.partitionBy("stratum", "bucket").orderBy("key", "doc_id", "text_crc32", "size")
    fraction = (2 * F.col("rank") + 1).cast("double") / (2 * F.col("stratum_rows")).cast("double")
    ranked = (
        rows.withColumn("here", F.row_number().over(local))
        .join(strata.drop("rows_here"), ["stratum", "bucket"])
        .withColumn("rank", F.col("before") + F.col("here") - 1)
        .withColumn("fraction", fraction)
        .select(
            "doc_id", "source", "size", "text_crc32", "stratum", "fraction",
            F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)).alias("bucket"),
        )
    )
    ranked = stage(ranked, "shard-ranks")
    cuts = _offsets(ranked.groupBy("bucket").agg(F.count("*").alias("rows_here")), [], "bucket", "before")
    order = Window.partitionBy("bucket").orderBy("fraction", "stratum")
    everywhere = F.col("before") + F.row_number().over(order) - 1
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    return (
        ranked.join(cuts.drop("rows_here"), "bucket")
        .withColumn("place", everywhere)
        .withColumn("shard", shard.cast("int"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            F.expr(f"place - (shard * cast({total} as bigint) + {shards - 1}) div {shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "source",
        )
    )
