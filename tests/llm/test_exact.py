import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import exact
from ebbline.llm.exact import PRIME, chunk_hash, exact_duplicates, powers

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        low = (t or "").translate(LOWER)
        ids = [x for x in groups[low] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[low]), i == keep, hashlib.sha256(low.encode()).hexdigest()))
    return out


ROWS = [
    (1, None), (2, ""), (None, ""), (3, "Abc É"), (4, "aBC É"), (5, "abc é"), (None, "lonely"), (None, "pair"),
    (None, "Pair"), (6, "x" * 100 + "y"), (7, "X" * 100 + "Y"), (8, "x" * 100 + "z"), (9, "twice"), (9, "twice"),
    (9, "TWICE"), (10, "ab" * 3_000), (11, "ab" * 3_000), (12, "ba" * 3_000), (13, "\x00"), (14, "\x00\x00"), (7, "other"),
]


def check(spark, **settings):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("keep_id", "mark_a", "chunk", "start", "copies")}
    )
    rows = [tuple(r) for r in exact_duplicates(docs, **settings).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(rows, key=order) == sorted(plain(ROWS), key=order)


@pytest.mark.parametrize("chunk_bytes", [1 << 14, 16])
def test_equals_brute_force(spark, chunk_bytes):
    check(spark, chunk_bytes=chunk_bytes)


def test_clashing_fingerprints_are_told_apart(spark):
    """With so small a modulus most texts of one length share a fingerprint."""
    check(spark, prime=2, chunk_bytes=16)


def test_fingerprints_compose():
    draw = np.random.default_rng(0)
    text, base = draw.integers(0, 256, 1_000).astype(np.uint8).tobytes(), exact.BASES[0]
    weights = powers(base, PRIME, 1 << 14)
    whole = chunk_hash(text, weights, PRIME)
    for cut in (0, 1, 500, 999, 1_000):
        left, right = (chunk_hash(t, weights, PRIME) for t in (text[:cut], text[cut:]))
        assert (left * pow(base, len(text) - cut, PRIME) + right) % PRIME == whole


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
