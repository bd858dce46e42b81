import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbline.operators import profile
from ebbline.operators.encode import fit_levels, label_encode, level_codes, one_hot
from ebbline.operators.ordered import running_totals
from ebbline.operators.quantiles import QUARTILES, moments, quantiles, value_counts
from ebbline.operators.scale import RobustScale, median_fill


@pytest.fixture(scope="module")
def numbers(spark):
    draw = random.Random(5)
    # A third of the rows share one value; the rest is spread out and partly missing.
    rows = [(7.0 if i % 3 == 0 else draw.gauss(100, 30), draw.choice([1.0, 2.0, None]), 4.0) for i in range(3000)]
    pdf = pd.DataFrame(rows, columns=["hot", "few", "constant"]).astype(float)
    return spark.createDataFrame(rows, "hot double, few double, constant double").repartition(6), pdf


def test_running_totals_with_a_hot_group(spark):
    rows = [("a" if i % 3 else "b", float(i * 7919 % 10007), i % 5) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    out = running_totals(df, ["g"], "v", ["n"]).toPandas().sort_values(["g", "v"])
    want = pd.DataFrame(rows, columns=["g", "v", "n"]).sort_values(["g", "v"])
    assert out["upto_n"].tolist() == want.groupby("g")["n"].cumsum().tolist()
    assert out["all_n"].tolist() == want.groupby("g")["n"].transform("sum").tolist()


def test_running_totals_plan(spark):
    """The cuts are picked by a hash threshold, not by ranking a group, and the range is computed once per row."""
    df = spark.range(20000).select(
        (F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    plan = running_totals(df, ["g"], "v", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "pmod(xxhash64(" in plan and "row_number" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "isnotnull((reduce" not in plan and "isnotnull(coalesce" not in plan


def test_quantiles_match_pandas(numbers):
    df, pdf = numbers
    found = quantiles(value_counts(df, list(pdf)), QUARTILES).toPandas().set_index("column")
    for c in pdf:
        np.testing.assert_allclose(found.loc[c, list(QUARTILES)].astype(float), pdf[c].quantile([0.25, 0.5, 0.75]))


def test_moments_match_pandas(numbers):
    df, pdf = numbers
    found = moments(value_counts(df, list(pdf))).toPandas().set_index("column")
    for c in pdf:
        x = pdf[c]
        want = [x.mean(), x.var(), x.skew(), x.kurt(), x.min(), x.max(), x.mode().iloc[0]]
        got = found.loc[c, ["mean", "variance", "skewness", "kurtosis", "min", "max", "mode"]].astype(float)
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_outliers_are_strictly_outside(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 8.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    s = pd.Series(values)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    want = int(((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).sum())
    assert profile.iqr_outliers(df, ["x"]).head()["outliers"] == want


def test_histogram_matches_numpy(numbers):
    df, pdf = numbers
    labelled = df.withColumn("Churn", F.lit("No")).select("hot", "constant", "Churn")
    found = profile.class_histogram(labelled, ["hot", "constant"]).orderBy("column", "bin").toPandas()
    for c in ["hot", "constant"]:
        assert found[found["column"] == c]["n"].tolist() == np.histogram(pdf[c], bins=30)[0].tolist()


def test_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "x double")
    assert sorted(r[0] for r in median_fill(df, ["x"]).collect()) == [1.0, 3.0, 3.0, 10.0]


def test_robust_scale_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "c double, x double")
    scale = RobustScale.fit(df, ["c", "x"])
    assert scale.spread["c"] == 1.0
    assert [r["c"] for r in scale.transform(df).collect()] == [0.0, 0.0, 0.0]


def test_label_codes_of_many_levels(spark):
    rows = [(str(i),) for i in range(1500)] + [("7",)] * 700 + [(None,)]
    df = spark.createDataFrame(rows, "k string")
    want = {v: i for i, v in enumerate(sorted({r[0] for r in rows if r[0]}))}
    assert {r["level"]: r["code"] for r in level_codes(df, ["k"]).collect()} == want
    joined = label_encode(df.withColumn("raw", F.col("k")), ["k"])
    assert joined.count() == len(rows)
    assert all(r["k"] == want.get(r["raw"]) for r in joined.collect())


def test_all_levels_are_found(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("one").alias("c"))
    assert fit_levels(df, ["k", "c"]) == {"k": sorted(map(str, range(50))), "c": ["one"]}


def test_one_hot_unseen_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    out = one_hot(df, {"c": ["a", "b", "z"]})
    assert out.columns == ["c_b", "c_z"]
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_validation(spark):
    good = spark.createDataFrame([("1", "Yes"), ("2", "maybe")], "customerID string, Churn string")
    counts = {r["rule"]: r["violations"] for r in profile.validate_input(good).collect()}
    assert counts == {"table_is_empty": 0, "target_column_missing": 0, "target_not_yes_or_no": 1}
    assert {r["rule"]: r["violations"] for r in profile.validate_input(good.drop("Churn")).collect()}[
        "target_column_missing"] == 1
    with pytest.raises(ValueError):
        profile.require_valid(good.drop("Churn"))
    with pytest.raises(ValueError):
        profile.require_valid(good.limit(0))
