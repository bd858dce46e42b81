"""What must hold at any size: plans that leave tables in place, levels and folds without limits."""

import os

import pytest
from pyspark.sql import functions as F

from ebbline.operators import encode, keyed, ordered, split
from ebbline.plans import training
from ebbline.workspace import new_path, release, stage, staged_paths


def test_a_small_upsert_leaves_the_table_in_place(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("customerID"), F.lit("old").alias("Contract"))
    table = stage(rows, "table")
    batch = stage(spark.createDataFrame([("7", "new"), ("x", "new")], "customerID string, Contract string"), "batch")
    out = keyed.upsert(table, batch)
    assert out.count() == 20_001 and out.where("Contract = 'new'").count() == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    # The only hash exchanges are those of the known keys and the batch, never of the table with its columns.
    scans = [line for line in plan.splitlines() if "LeftOuter" in line]
    assert scans and all("BroadcastHashJoin" in line for line in scans)


def test_any_number_of_levels_trains_and_scores(spark):
    rows = spark.range(3_000).select(
        F.col("id").cast("string").alias("key"), F.concat(F.lit("St. "), F.col("id") % 1_000).alias("city"),
        (F.col("id") % 2).cast("double").alias("label"),
    )
    table = stage(rows, "cities")
    levels = encode.fit_levels(table, ["city"])
    assert len(levels["city"]) == 1_000
    codes = encode.label_encode(table, ["city"]).select("city").distinct()
    assert sorted(r.city for r in codes.collect()) == list(range(1_000))
    entries = encode.one_hot_entries(table, "key", ["city"])
    assert entries.count() == 3 * 999
    # A level with a dot names a column that the model must be able to read.
    few = encode.one_hot(table.where("city IN ('St. 1', 'St. 2', 'St. 3')"), {"city": ["St. 1", "St. 2", "St. 3"]})
    scores = training.tree_importance(few, ["city_St. 2", "city_St. 3"], "label", trees=3)
    assert scores.count() == 2


@pytest.mark.parametrize("folds", [2, 3, 7])
def test_folds_of_any_number(spark, folds):
    rows = spark.range(101).select(F.col("id").alias("key"), (F.col("id") % 2).alias("label"))
    sizes = split.stratified_folds(rows, "key", "label", folds).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.label == label]
        assert len(counts) == folds and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("n", [0, 1, 50, 5_000])
def test_running_totals_over_few_and_many_values(spark, n):
    rows = spark.range(n).select(F.lit("a").alias("g"), (F.col("id") * 7 % max(n, 1)).alias("x"), F.lit(1).alias("one"))
    found = ordered.running_totals(rows, ["g"], "x", ["one"]).collect()
    assert sorted((r.x, r.upto_one, r.all_one) for r in found) == [(i, i + 1, n) for i in range(n)]


def test_release_deletes_what_was_staged(spark):
    begin = staged_paths(spark)
    stage(spark.range(3), "gone")
    path = new_path(spark, "also")
    spark.range(3).write.parquet(path)
    assert release(spark, begin) == 2 and staged_paths(spark) == begin
    assert not os.path.exists(path.removeprefix("file://"))
