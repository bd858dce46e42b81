"""The stages of the corpus pipeline; each keeps documents as they are and drops some, the last encodes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.decontaminate import contamination
from ebbline.llm.exact import exact_duplicates
from ebbline.llm.pieces import round_trip
from ebbline.llm.queries import piece_model
from ebbline.llm.simhash import simhash_groups
from ebbline.llm.tables import ascii_lower, read_table, whole_text
from ebbline.llm.toxicity import fit_toxicity, score_column
from ebbline.workspace import stage

TOXIC_FROM = 0.5
SHINGLE_WORDS = 3
MAX_BITS = 3


def _kept_once(docs: DataFrame, mark: Column, keys: DataFrame) -> DataFrame:
    """One row of `docs` for each of `keys` (doc_id, mark of the text, rows that have both); other rows go.

    The keys are unique, so the join cannot multiply or pile up rows. Only rows that repeat a key are thinned out.
    """
    names = [f"__kept_{part}_{len(docs.columns)}" for part in ("id", "mark", "rows")]
    keys = stage(keys.toDF(*names), "pipeline-keys")
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (mark == F.col(names[1]))
    if keys.filter(F.col(names[2]) > 1).isEmpty():
        return docs.join(keys, same, "left_semi")
    again = docs.join(keys.filter(F.col(names[2]) > 1), same, "left_semi")
    again = again.withColumn(names[1], mark).dropDuplicates(["doc_id", names[1]]).drop(names[1])
    return docs.join(keys.filter(F.col(names[2]) == 1), same, "left_semi").unionByName(again)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below TOXIC_FROM; each row is judged where it is read."""
    score = score_column(spark, fit_toxicity(docs, read_table(spark, sf_dir, "labels")))
    return docs.filter(score(whole_text()) < TOXIC_FROM)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z the one with the largest id; a repeated row stays once."""
    kept = exact_duplicates(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("rows"))
    return _kept_once(docs, F.sha2(ascii_lower(whole_text()).cast("binary"), 256), kept)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the smallest id (null ids last, then the text's hash)."""
    rows = simhash_groups(docs, SHINGLE_WORDS, MAX_BITS).groupBy("component", "doc_id", "text_mark").agg(
        F.count("*").alias("rows")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_mark", "rows")).alias("first")
    kept = rows.groupBy("component").agg(first).select("first.doc_id", "first.text_mark", "first.rows")
    return _kept_once(docs, F.xxhash64(whole_text()), kept)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; rows stay where they are."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"), carry=True)
    return found.filter(F.size("spans") == 0).select("document.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, n_bytes and text_sha256 of the text decoded from the ids."""
    return round_trip(docs, piece_model()).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


PIPELINE = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]
