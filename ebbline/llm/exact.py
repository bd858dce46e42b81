"""Exact deduplication by composable polynomial fingerprints, confirmed by comparing bytes chunk by chunk."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.tables import ascii_lower, whole_text
from ebbline.workspace import stage

CHUNK_BYTES = 1 << 14
PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_023)

_MARKS = ["mark_a", "mark_b", "n_bytes"]


def powers(base: int, prime: int, count: int) -> np.ndarray:
    """base^(count-1), ..., base^1, base^0 modulo prime."""
    found = np.ones(count, dtype=np.uint64)
    for i in range(count - 2, -1, -1):
        found[i] = int(found[i + 1]) * base % prime
    return found


def chunk_hash(chunk: bytes, weights: np.ndarray, prime: int) -> int:
    """The polynomial with the chunk's bytes plus one as coefficients; sums stay below 2^64 up to 2^24 bytes."""
    values = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    return int(np.dot(values, weights[len(weights) - len(values):])) % prime


def _hasher(prime: int, chunk_bytes: int):
    weights = {base: powers(base, prime, chunk_bytes) for base in BASES}

    @F.pandas_udf("struct<mark_a: long, mark_b: long>")
    def shares(chunk: pd.Series, after: pd.Series) -> pd.DataFrame:
        """Each chunk's share of its document's fingerprint: its hash shifted by the bytes that follow it."""
        found = [
            [chunk_hash(c, weights[base], prime) * pow(base, int(n), prime) % prime for c, n in zip(chunk, after)]
            for base in BASES
        ]
        return pd.DataFrame({"mark_a": found[0], "mark_b": found[1]}, dtype="int64")

    return shares


def chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """doc_id, text_sha256, n_bytes, start, chunk: the lower-cased text in pieces, one row each (one for no text)."""
    whole = docs.select("doc_id", ascii_lower(whole_text()).cast("binary").alias("bytes"))
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length("bytes") - 1, F.lit(0)), F.lit(chunk_bytes))

    def piece(start: Column) -> Column:
        return F.struct(start.alias("start"), F.substring(F.col("bytes"), start + 1, F.lit(chunk_bytes)).alias("chunk"))

    return whole.select(
        "doc_id",
        F.sha2("bytes", 256).alias("text_sha256"),
        F.octet_length("bytes").cast("long").alias("n_bytes"),
        F.explode(F.transform(starts, piece)).alias("piece"),
    ).select("doc_id", "text_sha256", "n_bytes", "piece.start", "piece.chunk")


def fingerprints(docs: DataFrame, prime: int = PRIME, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, text_sha256, n_bytes, mark_a, mark_b, copies (rows of `docs` with this id and text).

    Chunks are hashed wherever they lie; a fingerprint is the plain sum of its chunks' shares, so they combine in
    any order, partly before the shuffle, and a huge document is never hashed as one piece.
    """
    after = F.col("n_bytes") - F.col("start") - F.octet_length("chunk")
    shares = chunks(docs, chunk_bytes).select(
        "doc_id", "text_sha256", "n_bytes", "start", _hasher(prime, chunk_bytes)("chunk", after).alias("share")
    )
    sums = shares.groupBy("doc_id", "text_sha256", "n_bytes").agg(
        F.sum("share.mark_a").alias("sum_a"),
        F.sum("share.mark_b").alias("sum_b"),
        F.count(F.when(F.col("start") == 0, 1)).alias("copies"),
    )
    return sums.select(
        "doc_id",
        "text_sha256",
        "n_bytes",
        F.expr(f"(sum_a div copies) % {prime}").alias("mark_a"),
        F.expr(f"(sum_b div copies) % {prime}").alias("mark_b"),
        "copies",
    )


def _compared(docs: DataFrame, suspects: DataFrame, chunk_bytes: int) -> DataFrame:
    """The chunks of the documents in `suspects`, with their fingerprints."""
    keys = suspects.select(
        F.col("doc_id").alias("key_id"), F.col("text_sha256").alias("key_digest"), "mark_a", "mark_b"
    )
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("text_sha256") == F.col("key_digest"))
    return chunks(docs, chunk_bytes).join(keys, same).drop("key_id", "key_digest")


def _members(marked: DataFrame, by: list[str]) -> DataFrame:
    return marked.groupBy(*by).agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("members")
    )


def exact_duplicates(docs: DataFrame, prime: int = PRIME, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z; the row with the largest doc_id of a group stays.

    Columns: doc_id, keep_id, group_size, kept, text_sha256; one row per row of `docs`.
    Equal fingerprints are not believed: the chunks of such documents meet by fingerprint and position and are
    compared as bytes. Tasks first keep one copy of each chunk, so a large group of copies travels once per task.
    Where a position holds two contents, its fingerprint's documents are told apart by the contents they hold.

    Null text is the empty text, and all empty texts are one group. A null doc_id ranks below every id; keep_id is
    null (and the row kept) where a group has no other. Rows that repeat id and text count in group_size and all
    carry the same result. An empty table gives no rows. Other columns are not read.
    """
    marked = stage(fingerprints(docs, prime, chunk_bytes), "exact-marks")
    shared = stage(_members(marked, _MARKS).filter("members > 1"), "exact-groups")
    suspects = marked.join(shared.select(*_MARKS), _MARKS, "left_semi")
    contents = (
        _compared(docs, suspects, chunk_bytes)
        .groupBy(*_MARKS, "start", "chunk").agg(F.count("*").alias("rows"))
        .groupBy(*_MARKS, "start").agg(F.count("*").alias("contents"))
    )
    clashes = stage(contents.filter("contents > 1").select(*_MARKS).distinct(), "exact-clashes")
    if clashes.isEmpty():
        grouped = marked.join(shared.drop("members"), _MARKS, "left")
    else:
        grouped = _told_apart(docs, marked, shared, clashes, chunk_bytes)
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (
        grouped.withColumn("keep_id", keep_id)
        .withColumn("group_size", F.coalesce("group_size", "copies").cast("long"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def _told_apart(
    docs: DataFrame, marked: DataFrame, shared: DataFrame, clashes: DataFrame, chunk_bytes: int
) -> DataFrame:
    """Groups where some fingerprints stand for more than one text: there, a group is a sequence of chunk contents."""
    unclear = stage(marked.join(clashes, _MARKS, "left_semi"), "exact-unclear")
    rows = stage(_compared(docs, unclear, chunk_bytes), "exact-unclear-chunks")
    position = [*_MARKS, "start"]
    named = rows.groupBy(*position, "chunk").agg(F.min(F.struct("doc_id", "text_sha256")).alias("content"))
    sequence = F.array_sort(F.collect_set(F.struct("start", "content"))).alias("sequence")
    document = [*_MARKS, "doc_id", "text_sha256"]
    texts = rows.join(named, [*position, "chunk"]).groupBy(*document).agg(sequence)
    texts = texts.withColumn("sequence", F.sha2(F.to_json("sequence"), 256)).withColumnsRenamed(
        {c: f"text_{c}" for c in document}
    )
    same = F.col("doc_id").eqNullSafe(F.col("text_doc_id")) & (F.col("text_sha256") == F.col("text_text_sha256"))
    unclear = unclear.join(texts.drop(*[f"text_{c}" for c in _MARKS]), same).drop("text_doc_id", "text_text_sha256")
    unclear = stage(unclear, "exact-sequences")
    apart = [*_MARKS, "sequence"]
    clear = marked.join(clashes, _MARKS, "left_anti").join(shared.drop("members"), _MARKS, "left")
    split = unclear.join(_members(unclear, apart).drop("members"), apart, "left")
    return clear.unionByName(split.drop("sequence"))
