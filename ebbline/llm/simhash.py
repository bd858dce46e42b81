"""SimHash near-duplicates: 64-bit fingerprints, candidates by pigeonring chains, linked components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.components import components
from ebbline.llm.tables import whole_text
from ebbline.workspace import stage

BITS = 64
HASH_SEED = 42
_SUM_BLOCK = 255  # rows of 0/1 bytes that a byte can sum
_ROWS_AT_ONCE = _SUM_BLOCK * 512


def shingle_hashes(text: str, width: int) -> list[int]:
    """XXH64 of every run of `width` words (the whole sequence if it is shorter); bytes.lower touches A-Z only,
    bytes.split cuts at the six ASCII white-space bytes only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(line, HASH_SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-width] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends[width - 1:].tolist())]


def fingerprint(text: str, width: int) -> int:
    """A bit is 1 if more than half of the hashes have it; a signed long, zero without words."""
    hashes = np.array(shingle_hashes(text, width), dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS_AT_ONCE):
        part = hashes[at:at + _ROWS_AT_ONCE]
        part = np.concatenate((part, np.zeros(-len(part) % _SUM_BLOCK, dtype=np.uint64)))
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, _SUM_BLOCK, BITS)
        ones += bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    marked = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(marked.view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_mark (a hash of the text that tells apart rows with one id), mark (the fingerprint, signed)."""

    @F.pandas_udf("long")
    def marks(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.select("doc_id", F.xxhash64(whole_text()).alias("text_mark"), marks(whole_text()).alias("mark"))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of max_bits + 1 segments that cover the 64 bits."""
    count = max_bits + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(mark: Column, shift: int, width: int) -> Column:
    if width == BITS:
        return mark
    return F.shiftrightunsigned(mark, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def close_marks(marks: DataFrame, max_bits: int) -> DataFrame:
    """Pairs a < b of the distinct `mark`s that differ in `max_bits` bits or fewer (a pair may come repeatedly).

    The segments form a ring. If all differences together are at most max_bits, some chain of consecutive
    segments stays, at every length l, within the proportional budget l * max_bits / segments, that is l - 1 bits
    for max_bits + 1 segments. So the chain's first segment is equal and the second differs in one bit at most: one
    side is looked up by these two segments, the other asks for them and for each one-bit change of the
    second. The next lengths of the chain prune what was met, the full count of differing bits decides.
    """
    segments = _segments(max_bits)
    count = len(segments)
    asked, offered = [], []
    for i, (shift, width) in enumerate(segments):
        next_shift, next_width = segments[(i + 1) % count]
        first, second = _segment(F.col("mark"), shift, width), _segment(F.col("mark"), next_shift, next_width)
        if count == 1:
            changes = [F.lit(0).cast("long")]
        else:
            changes = [F.lit(v).cast("long") for v in [0, *(1 << j for j in range(next_width))]]
        variants = [F.struct(F.lit(i).alias("start"), first.alias("first"), second.bitwiseXOR(v).alias("second")) for v in changes]
        asked.extend(variants)
        offered.append(variants[0])
    key = ["start", "first", "second"]
    asks = marks.select(F.col("mark").alias("a"), F.explode(F.array(*asked)).alias("k")).select("a", "k.*")
    offers = marks.select(F.col("mark").alias("b"), F.explode(F.array(*offered)).alias("k")).select("b", "k.*")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(True)
    for i in range(count):
        used, within = F.lit(0), F.lit(True)
        for length in range(1, count):
            shift, width = segments[(i + length - 1) % count]
            used = used + F.bit_count(_segment(differ, shift, width))
            within = within & (used <= length * max_bits // count)
        chain = chain & ((F.col("start") != i) | within)
    met = asks.join(offers, key).filter("a < b").filter(chain)
    return met.filter(F.bit_count(differ) <= max_bits).select("a", "b")


def simhash_groups(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """Near-duplicate components of `docs`: fingerprints link if they differ in `max_bits` bits or fewer.

    Columns: doc_id, fingerprint (16 lower-case hex digits), component_id (the smallest doc_id reachable over
    links, itself included), component (its smallest fingerprint, signed), text_mark; one row per row of `docs`.
    Equal fingerprints are one node from the start, so copies are never paired; all links between different
    fingerprints are found and only components are kept of them.

    Null text is the empty text: no words, fingerprint zero, which links like any other. Null ids are passed over
    when the smallest id is sought; a component of null ids only has a null component_id. Rows that repeat an id
    are rows of their own; ties cannot matter, as only the smallest id is used. An empty table gives no rows.
    Other columns are not read.
    """
    marked = stage(fingerprints(docs, width), "simhash-marks")
    marks = stage(marked.groupBy("mark").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    links = stage(close_marks(marks.select("mark"), max_bits), "simhash-links")
    found = components(links)
    linked = marks.join(found, F.col("mark") == F.col("node")).select("mark", "first_id", "component")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(smallest, "component").select("mark", "component", "component_id")
    named = marks.join(linked, "mark", "left").select(
        "mark",
        F.coalesce("component", "mark").alias("component"),
        F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return marked.join(stage(named, "simhash-components"), "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id", "component", "text_mark"
    )
