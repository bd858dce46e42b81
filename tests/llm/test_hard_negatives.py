import math

import numpy as np
from pyspark.sql import functions as F

from ebbline.llm import hard_negatives as module
from ebbline.llm.hard_negatives import HELD_SCORES, hard_negatives, scores


def plain(rows, every, positives=5, negatives=3):
    """The contract over lists of (vec_id, label, vector)."""
    valid = [
        (i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asking = {}
    for i, label, v in valid:
        if i % every == 0:
            asking[i] = min(asking.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in asking.items():
        met = [(-max(-HELD_SCORES, min(HELD_SCORES, sum(x * y for x, y in zip(v, w)))), i, other) for i, other, w in valid if i != a]
        same = sorted(x[:2] for x in met if x[2] == label)[:positives]
        for below, positive in same:
            ps = -below
            inside = sorted(x[:2] for x in met if x[2] != label and 50 * ps <= -100 * x[0] <= 95 * ps)[:negatives]
            out += [(a, positive, r, n, ps, -s) for r, (s, n) in enumerate(inside, 1)]
    return sorted(out)


def found(spark, rows, every, **options):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns(
        {c: F.lit("x") for c in ("score", "slot", "anchor_id", "rank", "vector", "nth")}
    )
    out = hard_negatives(table.repartition(4), F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in out.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(count, seed, coarse=False):
    draw = np.random.default_rng(seed)
    points = draw.normal(size=(count, 6))
    points = np.round(points) if coarse else points
    return [(i, int(draw.integers(0, 3)), [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]


def test_equals_brute_force(spark):
    assert found(spark, rows := vectors(300, 1), 10) == plain(rows, 10)


def test_ties_and_blocks(spark, monkeypatch):
    """Whole-numbered points tie often; anchors in several groups, scores in small pieces."""
    monkeypatch.setattr(module, "ANCHORS_AT_ONCE", 7)
    monkeypatch.setattr(module, "SCORES_AT_ONCE", 50)
    rows = vectors(200, 2, coarse=True)
    assert found(spark, rows, 9) == plain(rows, 9)
    assert found(spark, rows, 9, positives=2, negatives=1) == plain(rows, 9, 2, 1)


def test_edges(spark):
    rows = vectors(40, 3) + [
        (None, 1, [1.0] * 6), (100, None, [1.0] * 6), (110, 1, None), (120, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (130, 1, [float("nan")] + [1.0] * 5), (140, 1, [float("inf")] + [1.0] * 5), (150, 2, []), (160, 2, [2.0]),
        (0, 1, [9.0] * 6), (0, 1, [9.0] * 6), (3, 2, [5.0] * 6), (170, 7, [1.0] * 6), (-10, 1, [-2.0] * 6),
    ]
    assert found(spark, rows, 10) == plain(rows, 10)
    assert found(spark, [], 10) == []
    assert found(spark, rows[:5], 1000) == plain(rows[:5], 1000)


def test_very_large_components(spark):
    """Beyond the whole numbers of a double, and beyond a long."""
    rows = [(0, 1, [3e15, 1.0]), (1, 1, [1.0, 1e5]), (2, 2, [0.6, 7.0]), (3, 2, [0.9, 2.0]), (4, 1, [3e30, 0.0]), (5, 2, [2e30, 0.0])]
    assert found(spark, rows, 1) == plain([(i, c, [float(np.float32(x)) for x in v]) for i, c, v in rows], 1)
    exact = scores(np.array([[2.0**53, 1.0]]), np.array([[1.0, 1.0]]))
    assert exact.tolist() == [[2**53 + 1]]
