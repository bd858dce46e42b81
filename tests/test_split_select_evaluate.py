import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import evaluate, monitor, select, split


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1003).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 7 == 0).cast("int").alias("y")
    )


def test_split_is_a_partition_with_exact_shares(labelled):
    parts = split.train_test(labelled, "id", "y").toPandas()
    assert len(parts) == 1003 and parts["id"].is_unique
    for label, group in parts.groupby("y"):
        assert (group["split"] == "train").sum() == math.ceil(len(group) * 0.8)


def test_folds_differ_by_at_most_one(labelled):
    folds = split.stratified_folds(labelled, "id", "y").groupBy("y", "fold").count().toPandas()
    for _, group in folds.groupby("y"):
        assert len(group) == 5 and group["count"].max() - group["count"].min() <= 1


def test_split_does_not_depend_on_partitioning(labelled):
    one = {tuple(r) for r in split.train_test(labelled.repartition(1), "id", "y").collect()}
    assert one == {tuple(r) for r in split.train_test(labelled.repartition(7, "y"), "id", "y").collect()}


def test_class_weights(labelled):
    found = {r["y"]: r["weight"] for r in split.class_weights(labelled, "y").collect()}
    ones = sum(1 for i in range(1003) if i % 7 == 0)
    assert found[1] == pytest.approx(1003 / (2 * ones))
    assert found[0] == pytest.approx(1003 / (2 * (1003 - ones)))


def test_anova_and_information(spark):
    draw = random.Random(2)
    rows = [(i, float(y := i % 2), draw.gauss(y, 1), draw.gauss(0, 1), 3.0) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, y double, signal double, noise double, constant double")
    counts = select.counts_by_label(df, ["signal", "noise", "constant"], "y")
    f = {r["feature"]: r["score"] for r in select.anova_f(counts).collect()}
    x = np.array([r[2] for r in rows])
    y = np.array([r[1] for r in rows])
    groups = [x[y == c] for c in (0, 1)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    assert f["signal"] == pytest.approx(between / (within / 598))
    assert f["constant"] is None
    info = {r["feature"]: r["score"] for r in select.mutual_information(counts).collect()}
    assert info["constant"] == pytest.approx(0) and info["signal"] > info["noise"]
    ranked = [r["feature"] for r in select.top_features(select.anova_f(counts)).orderBy("rank").collect()]
    assert ranked == ["signal", "noise", "constant"]


def test_votes(spark):
    def chosen(*names):
        return spark.createDataFrame([(n,) for n in names], "feature string")

    votes = select.feature_votes({"a": chosen("x", "y"), "b": chosen("x"), "c": chosen("z", "z")})
    assert {(r["feature"], r["votes"], r["selected"]) for r in votes.collect()} == {
        ("x", 2, True), ("y", 1, False), ("z", 1, False)}


def scored(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "model string, label int, probability double, prediction int")


def test_metrics_with_tied_scores(spark):
    draw = random.Random(9)
    rows = [(draw.randint(0, 1), draw.randint(0, 20) / 20) for _ in range(300)]
    got = evaluate.classification_metrics(scored(spark, [(y, p, int(p > 0.5)) for y, p in rows])).head()
    pairs = [(p, q) for y, p in rows if y for z, q in rows if not z]
    auc = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in pairs) / len(pairs)
    positives, ap, recall = sum(y for y, _ in rows), 0.0, 0.0
    for cut in sorted({p for _, p in rows}, reverse=True):
        taken = [y for y, p in rows if p >= cut]
        ap += (sum(taken) / positives - recall) * sum(taken) / len(taken)
        recall = sum(taken) / positives
    assert got["roc_auc"] == pytest.approx(auc)
    assert got["avg_precision"] == pytest.approx(ap)
    points = evaluate.roc_curve(scored(spark, [(y, p, 0) for y, p in rows]))
    assert points.count() == len({p for _, p in rows}) + 1


def test_no_predicted_positives(spark):
    got = evaluate.classification_metrics(scored(spark, [(1, 0.2, 0), (0, 0.1, 0)])).head()
    assert (got["precision"], got["recall"], got["f1"]) == (0.0, 0.0, 0.0)


def test_one_class_has_no_auc(spark):
    assert evaluate.classification_metrics(scored(spark, [(1, 0.2, 0), (1, 0.9, 1)])).head()["roc_auc"] is None


def test_best_model_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", None)], "model string, roc_auc double")
    assert evaluate.best_model(df).head()["model"] == "a"


def test_drift(spark):
    old = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(100)], "x double, c string")
    new = spark.createDataFrame([(float(i + 30), "a") for i in range(100)], "x double, c string")
    found = {r["column"]: r["statistic"] for r in monitor.drift_check(old, new, ["x"], ["c"]).collect()}
    assert found["x"] == pytest.approx(0.3)
    assert found["c"] == pytest.approx(100 * 100 * 200 / (150 * 150) * (50 / 100) ** 2 * 150 / 50)
    same = {r["column"]: r["statistic"] for r in monitor.drift_check(old, old, ["x"], ["c"]).collect()}
    assert same == {"x": 0.0, "c": 0.0}


def test_performance_monitor(spark):
    df = spark.createDataFrame([("d1", 1, 1), ("d1", 0, 0), ("d2", 1, 0), ("d2", 0, 0)], "day string, label int, prediction int")
    assert {(r["day"], r["degraded"]) for r in monitor.performance_monitor(df, "day").collect()} == {("d1", False), ("d2", True)}
