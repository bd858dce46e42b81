import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.llm import lexical
from ebbline.llm.lexical import ImpactLists, ranked_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in held]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in set(items):
        scored = []
        for (doc, c), n in zip(held, lengths):
            score = 0
            for w in set(terms(text)):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * (10 + 90 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("n", "codes", "item", "score", "rank", "term")}
    )
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns(
        {c: F.lit(1) for c in ("doc_id", "rank", "item")}
    )
    return sorted([tuple(r) for r in ranked_documents(table.repartition(3), asked, **options).collect()], key=str)


def corpus(count, words, seed):
    draw = np.random.default_rng(seed)
    return [
        (i, " ".join(f"w{min(int(x), words)}" for x in draw.zipf(1.4, int(draw.integers(0, 60))))) for i in range(count)
    ]


def test_edges(spark):
    docs = [
        (1, None), (2, ""), (3, " .-\n"), (4, "Alpha beta"), (5, "alpha BETA"), (None, "alpha beta"), (6, "Äpfel äpfel 7"),
        (7, "gamma " * 200_000 + "alpha"), (7, "gamma"), (8, "alpha beta"), (8, "alpha beta"), (9, "a`b@c[d{e/f:g"),
    ]
    items = [
        (1, "alpha, beta!"), (1, "alpha, beta!"), (2, None), (3, ""), (4, "nowhere"), (None, "Äpfel"), (5, "gamma alpha"),
        (5, "7 b"), (6, "beta " * 1000),
    ]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, block_bytes=100) == plain(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_small_blocks_equal_brute_force(spark, monkeypatch):
    """Ties, blocks that follow each other in a task, and a term that all documents hold."""
    docs = corpus(400, 40, 1) + [(1000 + i, "w1 w2 w3") for i in range(50)]
    items = [(i, t) for i, t in corpus(30, 40, 2)]
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 32)
    monkeypatch.setattr(lexical, "FIRST_STEP", 1)
    assert found(spark, docs, items, k=7) == plain(docs, items, k=7)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6), st.integers(1, 12))
def test_search_equals_full_scores(seed, k, width):
    draw = np.random.default_rng(seed)
    size = 60
    held = [np.flatnonzero(draw.random(width) < 0.4).astype(np.int32) for _ in range(size)]
    times = [draw.integers(1, 4, len(c)).astype(np.int32) for c in held]
    lengths = np.array([int(t.sum()) for t in times])
    weights = draw.integers(0, 5, width) * 100
    ids = draw.permutation(size).tolist()
    lists = ImpactLists(
        ids, lengths, [c.tobytes() for c in held], [t.tobytes() for t in times], weights, size, int(lengths.sum())
    )
    scores = defaultdict(int)
    for i in range(size):
        spread = 10 + 90 * int(lengths[i]) * size // max(int(lengths.sum()), 1)
        for c, t in zip(held[i].tolist(), times[i].tolist()):
            scores[ids[i]] += int(weights[c]) * (1_000_000_000 * t // (1000 * t + 8 * spread))
    wanted = sorted((-s, d) for d, s in scores.items() if s > 0)[:k]
    best, _ = lists.search(np.flatnonzero(weights > 0), k, 0)
    assert [(-s, lists.ids[d]) for s, d in best] == wanted


def test_search_stops_early():
    """One document far ahead of a long tail: the tail is not read."""
    size = 5_000
    codes = [np.array([0], dtype=np.int32).tobytes()] * size
    times = [np.array([100 if i < 3 else 1], dtype=np.int32).tobytes() for i in range(size)]
    lists = ImpactLists(list(range(size)), np.full(size, 100), codes, times, np.array([500]), size, 100 * size)
    best, scored = lists.search(np.array([0]), 2, 0)
    assert [d for _, d in best] == [0, 1] and scored < 100
    assert lists.search(np.array([0]), 2, 10**12) == ([], 0)


@pytest.mark.parametrize("k", [1, 3])
def test_fewer_documents_than_asked(spark, k):
    docs, items = [(1, "one two"), (2, "two"), (3, "three three")], [(1, "one two")]
    assert found(spark, docs, items, k=k) == plain(docs, items, k=k)
