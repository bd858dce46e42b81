import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.plans import extra_trees
from ebbline.plans.extra_trees import ExtraTreesGrower
from ebbline.plans.models import scored
from ebbline.plans.trees import Cut, Trees, cut_probabilities
from ebbline.workspace import new_path, stage


@pytest.fixture(scope="module")
def rows(spark):
    def unit(i):
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1009)) / 1009

    df = spark.range(900).select("id", *[F.round(unit(i), 2).alias(f"x{i}") for i in range(5)], unit(7).alias("u"))
    df = df.withColumn("label", (F.col("u") < 0.15 + 0.7 * ((F.col("x0") > 0.5) != (F.col("x1") > 0.4)).cast("int")).cast("double"))
    out = VectorAssembler(inputCols=[f"x{i}" for i in range(5)], outputCol="features").transform(df)
    return stage(out.select(F.col("id").alias("key"), "label", "features", F.lit(1.0).alias("class_weight")), "tree-rows")


def by_key(df):
    return {r["key"]: r["probability"] for r in df.select("key", "probability").collect()}


def matrix(rows):
    held = rows.orderBy("key").select("key", "label", vector_to_array("features").alias("at")).collect()
    return np.array([r["at"] for r in held]), np.array([r["label"] for r in held]), [r["key"] for r in held]


@pytest.mark.parametrize("depth", [0, 1, 3, 7, None])
@pytest.mark.parametrize("leaf", [1, 6])
def test_a_cut_tree_is_the_tree_grown_with_that_depth(spark, rows, depth, leaf):
    def grown(max_depth):
        return DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=leaf, seed=1).fit(rows)

    deep = Trees.of_model(spark, grown(30))
    alone = by_key(scored(grown(30 if depth is None else depth), rows, "alone"))
    assert by_key(cut_probabilities(rows, deep, [Cut("c", 1, depth, 2)])) == pytest.approx(alone, abs=1e-12)
    assert by_key(scored(deep.cut(depth), rows, "cut")) == pytest.approx(alone, abs=1e-12)


@pytest.mark.parametrize("least", [10, 60, 2000])
def test_no_node_below_the_least_rows_is_split(spark, rows, least):
    deep = Trees.of_model(spark, DecisionTreeClassifier(maxDepth=30, seed=1).fit(rows))
    cut = deep.cut(None, least)
    inner = cut.left >= 0
    assert (cut.rows[inner] >= least).all()
    # By hand: go down the grown tree and stop at the first small node; siblings that predict the same are one leaf.
    x, y, _ = matrix(rows)

    def leaf_value(node, at):
        """(share, whether it is a leaf) of the subtree cut by hand."""
        if deep.left[node] < 0 or len(at) < least:
            return {tuple(at.tolist()): y[at].mean()}
        left = x[at, deep.feature[node]] <= deep.threshold[node]
        parts = [leaf_value(deep.left[node], at[left]), leaf_value(deep.right[node], at[~left])]
        if all(len(p) == 1 for p in parts) and len({next(iter(p.values())) > 0.5 for p in parts}) == 1:
            return {tuple(at.tolist()): y[at].mean()}
        return parts[0] | parts[1]

    wanted = np.zeros(len(y))
    for at, share in leaf_value(0, np.arange(len(y))).items():
        wanted[list(at)] = share
    assert cut.probability(x) == pytest.approx(wanted, abs=1e-9)


def test_forest_and_boosting_prefixes(spark, rows):
    forest = RandomForestClassifier(numTrees=8, maxDepth=6, seed=3).fit(rows)
    trees = Trees.of_model(spark, forest)
    assert by_key(scored(trees, rows, "t")) == pytest.approx(by_key(scored(forest, rows, "f")), abs=1e-9)
    x, _, keys = matrix(rows)
    first = dict(zip(keys, trees.cut(trees=3).probability(x)))
    assert by_key(cut_probabilities(rows, trees, [Cut("c", 3)])) == pytest.approx(first, abs=1e-12)
    assert len(trees.cut(trees=3).root) == 3

    boosted = [GBTClassifier(maxIter=n, maxDepth=3, stepSize=0.3, subsamplingRate=0.8, seed=5).fit(rows) for n in (6, 3)]
    margins = Trees.of_model(spark, boosted[0])
    found = cut_probabilities(rows, margins, [Cut("long", 6), Cut("short", 3)], "boosted")
    for name, model in zip(("long", "short"), boosted):
        alone = by_key(scored(model, rows, name))
        assert by_key(found.where(F.col("model") == name)) == pytest.approx(alone, abs=1e-9)


def test_extra_trees_draw_thresholds_for_every_node(rows):
    grown = ExtraTreesGrower(30, seed=7).fit(rows)
    inner = grown.left >= 0
    assert len(grown.root) == 30 and len(set(grown.threshold[inner].tolist())) > 0.9 * inner.sum()
    x, y, _ = matrix(rows)
    at = np.arange(len(y))
    for tree in range(3):  # counts and shares of every node, by hand
        todo = [(grown.root[tree], at)]
        while todo:
            node, held = todo.pop()
            assert grown.rows[node] == len(held) and grown.positive[node] == pytest.approx(y[held].mean())
            if grown.left[node] < 0:
                assert len(set(y[held])) == 1 or len(held) < 20
            else:
                left = x[held, grown.feature[node]] <= grown.threshold[node]
                assert 0 < left.sum() < len(held)
                todo += [(grown.left[node], held[left]), (grown.right[node], held[~left])]
    assert (np.abs(grown.probability(x) - y) < 0.5).mean() > 0.95


def test_extra_trees_limits_weights_and_seed(rows):
    shallow = ExtraTreesGrower(20, max_depth=4, least_rows=30, seed=1).fit(rows)
    assert shallow.depth.max() <= 4 and (shallow.rows[shallow.left >= 0] >= 30).all()
    again = ExtraTreesGrower(20, max_depth=4, least_rows=30, seed=1).fit(rows.repartition(5))
    assert all(np.allclose(a, b) for a, b in zip(shallow.arrays(), again.arrays()))
    heavy = rows.withColumn("class_weight", F.when(F.col("label") == 1, 5.0).otherwise(1.0))
    weighted = ExtraTreesGrower(20, max_depth=4, weighted=True, seed=1).fit(heavy)
    x, y, _ = matrix(rows)
    assert weighted.probability(x).mean() > shallow.probability(x).mean() + 0.1
    assert not len(ExtraTreesGrower(3).fit(rows.limit(0)).left[3:])


def test_saved_trees_are_the_same(spark, rows):
    grown = ExtraTreesGrower(5, max_depth=3).fit(rows)
    path = new_path(spark, "trees")
    grown.save(spark, path)
    loaded = Trees.load(spark, path)
    assert all(np.array_equal(a, b) for a, b in zip(grown.arrays(), loaded.arrays()))


def test_fits_pass_over_no_more_partitions_than_cores():
    from ebbline.plans.training import fit_partitions

    assert fit_partitions(1_500, 12) == 1
    assert fit_partitions(900_000, 12) == 12
    assert fit_partitions(5_400_000, 12) == 12  # it was 108, each with a result a pass
    assert fit_partitions(60_000_000, 12) == 120


def test_large_trees_grow_two_at_a_time(spark, monkeypatch):
    import threading
    from multiprocessing.pool import ThreadPool

    from ebbline.plans import models

    running, most, lock = 0, 0, threading.Lock()

    class Slow:
        def fit(self, train):
            nonlocal running, most
            with lock:
                running += 1
                most = max(most, running)
            threading.Event().wait(0.05)
            with lock:
                running -= 1

    monkeypatch.setattr(models.Trees, "of_model", classmethod(lambda cls, spark, model: None))
    family = models.SharedTrees(lambda point, rows: Slow())
    rows = spark.range(1)
    with ThreadPool(8) as pool:
        pool.map(lambda _: family.grow({"max_depth": None}, rows, 1), range(8), chunksize=1)
    assert most <= 2


def test_descent_in_one_tree_and_in_many_agree():
    from ebbline.plans.trees import Trees

    grown = Trees(
        np.array([0, 3]), np.array([1, -1, -1, -1]), np.array([2, -1, -1, -1]), np.array([1, 0, 0, 0]),
        np.array([0.5, 0, 0, 0]), np.array([3, 1, 2, 3]), np.array([0.3, 0.1, 0.4, 0.2]), np.array([0, 1, 1, 0]),
    )
    matrix = np.array([[9.0, 0.5], [9.0, 0.6], [9.0, np.nan]])
    assert grown.leaves(matrix).tolist() == [[1, 3], [2, 3], [2, 3]]


@pytest.mark.parametrize("sent", [Trees, extra_trees._ranges(None), extra_trees._counts(None)])
def test_tasks_need_no_installed_package(tmp_path, sent):
    held = tmp_path / "task"
    held.write_bytes(cloudpickle.dumps(sent))
    read = "import sys; from pyspark import cloudpickle; cloudpickle.loads(open(sys.argv[1], 'rb').read())"
    done = subprocess.run([sys.executable, "-c", read, str(held)], cwd=tmp_path, env={}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
