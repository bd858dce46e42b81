"""Fits that one task grows: the same as Spark's, and the whole grids that need them."""

import subprocess
import sys
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ebbline.catalog import all_queries, model_queries
from ebbline.operators.evaluate import ranking_metrics
from ebbline.plans import growth, models, training
from ebbline.plans.extra_trees import ExtraTreesGrower
from ebbline.plans.trees import Cut, Trees
from ebbline.workspace import stage

ROWS = 600


@pytest.fixture(scope="module")
def table():
    """Numbers with many and with few values, two columns that say the same, and one that says the contrary."""
    draw = np.random.default_rng(5)
    x = np.column_stack([
        draw.normal(size=ROWS), draw.exponential(size=ROWS).round(1), draw.integers(0, 2, ROWS), draw.integers(0, 5, ROWS),
    ])
    x = np.column_stack([x, 1 - x[:, 2], x[:, 2], np.ones(ROWS)])
    y = (draw.random(ROWS) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 2] - x[:, 3] / 2)))).astype(float)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, table):
    listed = [(i, float(y), 1.7 if y else 0.63, i % 2, [float(v) for v in x]) for i, (x, y) in enumerate(zip(*table))]
    df = spark.createDataFrame(listed, "key long, label double, class_weight double, fold int, at array<double>").coalesce(1)
    return stage(df.withColumn("features", array_to_vector("at")), "growth-rows")


@pytest.mark.parametrize("depth, share, columns", [(3, 1.0, "all"), (3, 0.8, "all"), (4, 1.0, "0.5"), (5, 0.8, "0.8")])
def test_boosted_trees_are_those_of_spark(rows, table, depth, share, columns):
    settings = dict(maxIter=8, stepSize=0.2, maxDepth=depth, subsamplingRate=share, featureSubsetStrategy=columns, seed=42)
    theirs = GBTClassifier(**settings).fit(rows).transform(rows).orderBy("key").select(vector_to_array("probability")[1]).collect()
    ours = growth.boosted_in_task(rows, 8, 0.2, depth, share, columns, 42, 1)
    assert len(ours.root) == 8
    assert ours.probability(table[0]) == pytest.approx([r[0] for r in theirs], abs=1e-12)


@pytest.mark.parametrize("depth, least, weight", [(4, 1, None), (30, 1, None), (30, 3, "class_weight")])
def test_a_tree_is_that_of_spark(spark, rows, table, depth, least, weight):
    theirs = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=least, seed=42)
    theirs = Trees.of_model(spark, (theirs.setWeightCol(weight) if weight else theirs).fit(rows))
    ours = growth.tree_in_task(rows, depth, least, weight).cut()
    assert len(ours.left) == len(theirs.left) and sorted(ours.rows) == sorted(theirs.rows)
    assert ours.probability(table[0]) == pytest.approx(theirs.probability(table[0]), abs=1e-12)


@pytest.mark.parametrize("gini", [True, False])
def test_counting_features_together_or_alone_and_in_parts_is_the_same(table, monkeypatch, gini):
    x, y = table
    value = y if gini else x[:, 0] * x[:, 3] + y
    grown = []
    for joint, cells, slots, few in (
        (1024, 1 << 18, 8192, 0), (1, 1 << 18, 8192, 0), (1024, 0, 8192, 0), (1024, 1 << 18, 3, 0), (1024, 1 << 18, 8192, 128),
    ):
        monkeypatch.setattr(growth, "_FEW_SLOTS", few)
        monkeypatch.setattr(growth, "_TABLE_CELLS", cells)
        monkeypatch.setattr(growth, "_SLOTS_AT_ONCE", slots)
        grown.append(growth.grow(growth.Binned(x, joint_cells=joint), value, None, None, 8, gini=gini))
    for other in grown[1:]:
        assert all(np.allclose(a, b) for a, b in zip(grown[0].arrays(), other.arrays()))


def test_spark_draws(spark):
    held = spark._jvm.org.apache.spark.util.random.XORShiftRandom
    for seed in (0, 43, -7):
        theirs = held(seed)
        assert growth.uniform(seed, 50).tolist() == [theirs.nextDouble() for _ in range(50)]


def test_candidate_splits_of_many_values():
    values = np.concatenate([np.zeros(500), np.arange(1, 501)])
    splits = growth.candidate_splits(values)
    assert len(splits) <= growth.MAX_BINS - 1 and splits[0] == 0.5 and (np.diff(splits) > 0).all()
    assert growth.candidate_splits(np.array([3.0, 1.0, 1.0])).tolist() == [2.0]
    assert growth.candidate_splits(np.ones(4)).tolist() == []


def test_extra_trees_of_one_task_are_the_same(rows):
    for settings in (ExtraTreesGrower(6, 5, weighted=True, seed=3), ExtraTreesGrower(4, None, 5, seed=9)):
        one, many = settings.fit_in_task(rows), settings.fit(rows.repartition(3))
        assert all(np.allclose(a, b) for a, b in zip(one.arrays(), many.arrays()))


def test_cuts_of_a_forest_grown_in_parts(spark, rows, monkeypatch):
    monkeypatch.setattr(growth, "FOREST_TASK_TREES", 4)
    train, held_out = rows.where("fold = 0"), rows.where("fold = 1")
    held_out = held_out.unionByName(held_out.limit(5)).withColumn("key", F.when(F.col("key") > 9, F.col("key")))  # keys twice and none
    cuts = [Cut(f"{n} {d} {s}", n, d, s) for n in (4, 7) for d, s in ((3, 2), (None, 20))]
    found = stage(growth.forest_candidates(train, 1_000_000, held_out, cuts, 30, 2, "class_weight", 42), "found")
    assert {r["model"]: r["count"] for r in found.groupBy("model").count().collect()} == {c.name: 305 for c in cuts}
    whole = growth.forest_in_task(train, 1_000_000, 7, 30, 2, "class_weight", 42)
    assert len(whole.root) == 7
    matrix = np.array([r["at"] for r in held_out.collect()])
    for c in cuts:
        wanted = Trees(whole.root[: c.trees], *whole.arrays()[1:]).cut(c.max_depth, c.least_rows)
        mine = sorted(r["probability"] for r in found.where(F.col("model") == c.name).collect())
        assert mine == pytest.approx(sorted(wanted.probability(matrix)), abs=1e-12)
    assert all(r["roc_auc"] > 0.7 for r in ranking_metrics(found.withColumn("prediction", F.lit(0))).collect())


def test_forest_parts_end_where_a_cut_ends():
    assert growth.forest_chunks([12, 25, 12], 500_000) == [(0, 10), (10, 12), (12, 22), (22, 25)]
    assert growth.forest_chunks([100, 300], 1_000) == [(0, 100), (100, 200), (200, 300)]


def test_large_fits_stay_with_spark(rows, monkeypatch):
    monkeypatch.setattr(growth, "IN_TASK_ROWS", ROWS - 1)
    point = {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 2, "subsample": 1.0}
    family = models.BY_NAME["Gradient Boosting"].family
    assert not isinstance(family.fit(point, rows, ROWS), Trees)
    assert isinstance(family.fit(point, rows, ROWS - 1), Trees)


def test_a_chosen_boosted_model_of_few_rows_is_that_of_spark(rows, monkeypatch):
    point = {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 2, "subsample": 1.0}
    spec = models.BY_NAME["Gradient Boosting"]
    assert not isinstance(training.fit_on_all(spec, point, rows), Trees)
    monkeypatch.setattr(growth, "EXACT_ROWS", ROWS - 1)
    assert isinstance(training.fit_on_all(spec, point, rows), Trees)


def test_in_task_growth_needs_no_installed_package(tmp_path):
    held = tmp_path / "task"
    held.write_bytes(cloudpickle.dumps((growth.boost, growth.grow_forest, ExtraTreesGrower(2))))
    read = "import sys; from pyspark import cloudpickle; cloudpickle.loads(open(sys.argv[1], 'rb').read())"
    done = subprocess.run([sys.executable, "-c", read, str(held)], cwd=tmp_path, env={}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_points_of_a_metric_share_one_pass_over_the_neighbours(spark, monkeypatch):
    listed = [(key, rank, d, float(y)) for key, found in ((1, [(0.0, 1), (0.0, 0), (2.0, 1), (3.0, 1)]), (2, [(0.5, 1), (1.0, 0), (4.0, 0)]))
              for rank, (d, y) in enumerate(found, 1)]
    near = stage(spark.createDataFrame(listed, "key long, rank int, distance double, label double"), "near")
    held_out = spark.createDataFrame([(1, 1.0), (2, 0.0)], "key long, label double").withColumn("features", array_to_vector(F.array(F.lit(0.0))))
    index = SimpleNamespace(neighbours=lambda *_: near)
    monkeypatch.setattr(models.SharedNeighbours, "fit", lambda *_: SimpleNamespace(index=index))
    points = [{"n_neighbors": k, "weights": w, "metric": "euclidean"} for k in (1, 3, 4) for w in ("uniform", "distance")]
    found = models.SharedNeighbours().candidates(points, held_out, 2, held_out)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1  # it was three a point
    got = {(r["model"], r["key"]): r["probability"] for r in found.collect()}
    for p in points:
        wanted = models.positive_share(near.where(F.col("rank") <= p["n_neighbors"]), p["weights"])
        for r in wanted.collect():
            assert got[str(p), r["key"]] == pytest.approx(r["probability"], abs=1e-12)
    assert len(got) == 12


def _asked(monkeypatch, name):
    """The grid that a model query searches."""
    class Searched(Exception):
        pass

    def cross_validate(spec, train, grid="short"):
        raise Searched(spec.name, grid)

    monkeypatch.setattr(training, "cross_validate", cross_validate)
    monkeypatch.setattr(model_queries, "prepared", lambda *_: SimpleNamespace(train=None))
    with pytest.raises(Searched) as found:
        all_queries()[name](None, "sf")
    return found.value.args


@pytest.mark.parametrize("query, model", [
    ("model_forest", "Random Forest"), ("model_gbt", "Gradient Boosting"), ("model_extra_trees", "Extra Trees"),
    ("model_gbt_variants", "XGBoost"),
])
def test_model_queries_search_the_full_grid(monkeypatch, query, model):
    assert _asked(monkeypatch, query) == (model, "full")


def test_cv_results_have_the_full_grids(monkeypatch):
    asked = []
    monkeypatch.setattr(training, "train_models", lambda data, names=None, grid="short": asked.append((names, grid)) or SimpleNamespace(cv="rows"))
    monkeypatch.setattr(model_queries, "prepared", lambda *_: "a training set")
    assert model_queries.cv_results(None, "sf") == model_queries.cv_results_full_grids(None, "sf") == "rows"
    assert asked == [(None, "full")]
