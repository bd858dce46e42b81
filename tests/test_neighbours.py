import bisect
import random

import numpy as np
import pandas as pd
import pytest
from ebbline.operators import knn, ladder, neighbours
from ebbline.operators.neighbours import donor_points, impute
from ebbline.workspace import new_path


def brute(pdf, k=5):
    donors = pdf[pdf["y"].notna()]
    out = {}
    for _, row in pdf[pdf["y"].isna()].iterrows():
        square = (donors["t"].astype(float) - row["t"]) ** 2 + (donors["m"] - row["m"]) ** 2
        near = donors.assign(square=square).sort_values(["square", "id"]).head(k)
        out[row["id"]] = near["y"].mean()
    return out


def imputed(spark, pdf):
    df = spark.createDataFrame(
        [(r.id, int(r.t), float(r.m), None if pd.isna(r.y) else float(r.y)) for r in pdf.itertuples()],
        "id string, t int, m double, y double",
    )
    donors = donor_points(df, "y", "t", "m", "id")
    out = impute(df, donors, "y", "t", "m").toPandas()
    assert len(out) == len(pdf)
    return {r.id: r.y for r in out.itertuples() if r.id in set(pdf[pdf["y"].isna()]["id"])}


@pytest.mark.parametrize("case", ["spread", "hot_point", "few_lines"])
def test_impute_matches_brute_force(spark, case):
    draw = random.Random(case)
    rows = []
    for i in range(400):
        t = draw.choice([1, 40]) if case == "few_lines" else draw.randint(0, 30)
        m = round(draw.uniform(0, 25), 1)
        if case == "hot_point" and i % 3 == 0:
            t, m = 12, 9.5  # a third of all rows, donors and gaps alike, at one point
        rows.append((f"c{i:03d}", t, m, None if draw.random() < 0.2 else round(draw.uniform(0, 99), 2)))
    pdf = pd.DataFrame(rows, columns=["id", "t", "m", "y"])
    got, want = imputed(spark, pdf), brute(pdf)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9)


def test_fewer_than_five_donors(spark):
    rows = [("a", 1, 1.0, 3.0), ("b", 9, 5.0, 6.0), ("c", 30, 2.0, 9.0), ("d", 4, 4.0, None)]
    pdf = pd.DataFrame(rows, columns=["id", "t", "m", "y"])
    assert imputed(spark, pdf) == {"d": 6.0}


def test_lines_far_apart_cost_what_exists(spark):
    """Absurd, negative and missing lines: the work follows the lines that hold donors, not the numbers between."""
    rows = [(f"d{i}", t, float(i), float(i * i)) for i, t in enumerate([0, 0, 0, 2_000_000_000, 2_000_000_000, -2_000_000_000, 7, 7])]
    rows += [("a", 5, 2.0, None), ("b", 2_000_000_000, 3.5, None), ("c", -1_000_000_000, 0.0, None), ("e", 1_000_000_000, 9.0, None)]
    pdf = pd.DataFrame(rows, columns=["id", "t", "m", "y"])
    got, want = imputed(spark, pdf), brute(pdf)
    assert got == pytest.approx(want, abs=1e-9) and len(got) == 4
    df = spark.createDataFrame([("x", None, 1.0, None), ("y", 3, 1.0, 2.0), ("z", 3, 1.5, None)], "id string, t int, m double, y double")
    out = {r.id: r.y for r in impute(df, donor_points(df, "y", "t", "m", "id"), "y", "t", "m").collect()}
    assert out == {"x": None, "y": 2.0, "z": 2.0}


def test_lines_are_visited_outward_until_none_can_be_nearer(spark, monkeypatch):
    """Many lines with one donor each, some of them far from the probe's place: several rounds, equal to brute force."""
    monkeypatch.setattr(neighbours, "_LINES_AT_ONCE", 2)
    draw = random.Random(4)
    rows = [(f"d{i:03d}", i - 150, draw.uniform(0, 400), draw.random()) for i in range(300) if i % 7]
    rows += [(f"g{i}", draw.randint(-200, 200), draw.uniform(-50, 450), None) for i in range(25)]
    pdf = pd.DataFrame(rows, columns=["id", "t", "m", "y"])
    got, want = imputed(spark, pdf), brute(pdf)
    assert got == pytest.approx(want, abs=1e-9)


def test_a_ladder_ranks_any_value(spark, monkeypatch):
    monkeypatch.setattr(ladder, "_LEAF", 4)
    monkeypatch.setattr(ladder, "_FAN", 4)
    draw = random.Random(2)
    for size in (0, 1, 3, 90):
        keys = sorted(draw.sample(range(-500, 500), size))
        made = ladder.Ladder.fit(spark.createDataFrame([(float(k),) for k in keys], "key double"), "ladder-test")
        assert [(r.key, r.slot) for r in made.keys.orderBy("slot").collect()] == [(float(k), i) for i, k in enumerate(keys, 1)]
        values = spark.createDataFrame([(v / 2,) for v in range(-1010, 1010, 3)], "v double")
        for found in made.place(values, "v", "rank").collect():
            assert found["rank"] == bisect.bisect_right(keys, found["v"])


def test_donors_survive_saving(spark):
    df = spark.createDataFrame([(f"c{i}", i % 9, i / 7, float(i) if i % 5 else None) for i in range(200)],
                               "id string, t int, m double, y double")
    donors, path = donor_points(df, "y", "t", "m", "id"), new_path(spark, "donors")
    donors.save(path)
    both = [sorted(map(tuple, impute(df, d, "y", "t", "m").collect())) for d in (donors, neighbours.Donors.load(spark, path))]
    assert both[0] == both[1]


def test_no_donors_leaves_the_gap(spark):
    pdf = pd.DataFrame([("a", 1, 1.0, None)], columns=["id", "t", "m", "y"])
    assert pd.isna(imputed(spark, pdf)["a"])


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("block", [4096, 16])
def test_knn_join_matches_brute_force(spark, metric, block, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6)) * 8
    points = np.vstack([centres[i % 4] + rng.normal(size=6) for i in range(160)])
    points[::3] = points[0]  # a third of the rows are copies of one vector
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    index = knn.KnnIndex.fit(df, "id", "v", metric=metric)
    got = index.neighbours(df, "id", "v", 3, other_than_self=True).toPandas()
    away = np.abs(points[:, None] - points[None]) if metric == "manhattan" else (points[:, None] - points[None]) ** 2
    dist = away.sum(axis=2) if metric == "manhattan" else np.sqrt(away.sum(axis=2))
    np.fill_diagonal(dist, np.inf)
    assert len(got) == 480
    for i, near in got.sort_values("rank").groupby("id"):
        want = np.lexsort((np.arange(len(points)), np.round(dist[i], 9)))[:3]
        np.testing.assert_allclose(near["distance"], dist[i][want], atol=1e-9)
        assert near["neighbour"].tolist() == want.tolist()


def test_cells_are_pruned_exactly():
    rng = np.random.default_rng(1)
    pivots = rng.normal(size=(8, 3)) * 50
    donors = np.vstack([p + rng.normal(size=(20, 3)) for p in pivots])
    away = knn.distances(donors, pivots, "euclidean")
    cell = away.argmin(axis=1)
    near = away[np.arange(len(donors)), cell]
    cells = knn.Cells(
        pivots, np.bincount(cell, minlength=8), np.array([near[cell == i].max(initial=0) for i in range(8)]),
        [sorted(near[cell == i])[:17] for i in range(8)], "euclidean",
    )
    queries = donors[:40] + 0.1
    visited = cells.visited(queries, 5)
    assert max(map(len, visited)) < 8
    for q, allowed in zip(queries, visited):
        best = np.argsort(np.linalg.norm(donors - q, axis=1))[:5]
        assert set(cell[best]) <= set(allowed)


def test_vote_by_distance(spark):
    rows = [("q", 1, 0.5, 0), ("q", 2, 1.0, 1), ("q", 3, 2.0, 1), ("z", 1, 0.0, 1), ("z", 2, 0.1, 0)]
    near = spark.createDataFrame(rows, "key string, rank int, distance double, label int")
    shares = {(r["key"], r["class"]): r["share"] for r in knn.vote(near, "key", "label", "distance").collect()}
    assert shares[("q", 0)] == pytest.approx(2 / 3.5)
    assert shares[("z", 1)] == 1.0 and shares[("z", 0)] in (0.0, None)


def test_clustered_vectors_visit_few_cells(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, 8)) * 30
    points = np.vstack([centres[i % 10] + rng.normal(size=8) for i in range(2_000)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    cells = knn.KnnIndex.fit(df, "id", "v").cells
    visited = cells.visited(points[:200], 5)
    assert sum(map(len, visited)) < 0.5 * 200 * int((cells.rows > 0).sum())


def test_vectors_without_numbers_are_left_out(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    near = knn.KnnIndex.fit(df, "id", "v").neighbours(df, "id", "v", 2, other_than_self=True).collect()
    assert {(r.id, r.neighbour) for r in near} == {(1, 2), (1, 6), (2, 1), (2, 6), (6, 1), (6, 2)}


def test_queries_travel_to_packs_not_to_cells(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1_500, 12))  # no clusters: hardly a cell can be ruled out
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    cells = knn.KnnIndex.fit(df, "id", "v").cells
    assert len(cells.rows) > 10 and cells.blocks().tolist() == [1]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_boxes_rule_out_packs_exactly(metric):
    rng = np.random.default_rng(6)
    marks = rng.integers(0, 2, size=(3_000, 10)) * 1.0  # indicators beside two numbers
    donors = np.hstack([marks[rng.integers(0, 12, 3_000)], rng.normal(size=(3_000, 2))])
    pivots = donors[:100]
    cell = knn._nearest_pivot(donors, pivots, metric)
    rows = np.bincount(cell, minlength=100)
    low = np.array([donors[cell == i].min(axis=0) if rows[i] else np.zeros(12) for i in range(100)])
    high = np.array([donors[cell == i].max(axis=0) if rows[i] else np.zeros(12) for i in range(100)])
    cells = knn.Cells(pivots, rows, np.zeros(100), [[]] * 100, metric, low, high, 200)
    queries = donors[:50] + 0.01
    home, names = cells.home(queries), np.arange(len(donors))
    pack, everywhere = cells.pack[cell], np.full(50, np.inf)
    away = knn.distances(queries, donors, metric)
    i, j, found = knn.nearest_in_pack(queries, np.arange(50), home, everywhere, donors, names, cell, cells, 4, False)
    assert np.bincount(i).tolist() == [4] * 50
    np.testing.assert_allclose(found.reshape(50, 4), np.sort(away, axis=1)[:, :4], atol=1e-9)
    limit = np.sort(away, axis=1)[:, 3]
    visited = cells.packs_within(queries, limit, home)
    assert sum(map(len, visited)) < 0.5 * 50 * (pack.max() + 1)
    for q in range(50):
        assert set(pack[np.argsort(away[q])[:4]]) <= {*visited[q], cells.pack[home[q]]}
