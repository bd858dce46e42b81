"""Exact stratified parts and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.fixed_values import CV_FOLDS
from ebbline.functions.expressions import named


def stratified_parts(df: DataFrame, key: str, label: str, shares: list[int], part: str = "part") -> DataFrame:
    """Assign each row of every class to part 0, 1, ... with exactly the given shares (percentages, or any weights).

    Rows of a class are taken in the order of md5(key). Counting by the first three hex digits
    fixes the part of nearly all rows without moving them; only rows of the ranges that a boundary
    falls into are ranked, each range on its own.
    """
    total = sum(shares)
    limits = [sum(shares[: i + 1]) for i in range(len(shares) - 1)]

    def part_of(rank: Column) -> Column:
        result = F.lit(0)
        for limit in limits:
            result = result + (rank * total >= F.col("_class_rows") * limit).cast("int")
        return result

    marked = df.where(named(label).isNotNull()).withColumn("_mark", F.md5(named(key).cast("string")))
    marked = marked.withColumn("_range", F.substring("_mark", 1, 3))
    earlier = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        marked.groupBy(label, "_range")  # at most 4096 rows per class
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_class_rows", F.sum("_n").over(Window.partitionBy(label)))
        .withColumn("_first", part_of(F.col("_before")))
        .withColumn("_last", part_of(F.col("_before") + F.col("_n") - 1))
    )
    placed = marked.join(F.broadcast(ranges), [label, "_range"])
    one_part = F.col("_first") == F.col("_last")
    inside = Window.partitionBy(label, "_range").orderBy("_mark", key)
    whole = placed.where(one_part).withColumn(part, F.col("_first"))
    divided = placed.where(~one_part).withColumn(part, part_of(F.col("_before") + F.row_number().over(inside) - 1))
    columns = [*[named(c) for c in df.columns], F.col(part).cast("int").alias(part)]
    return whole.select(*columns).unionByName(divided.select(*columns))


def train_test(df: DataFrame, key: str, label: str, test_percent: int = 20) -> DataFrame:
    """Add `split`: train or test."""
    parts = stratified_parts(df, key, label, [100 - test_percent, test_percent], "_part")
    return parts.withColumn("split", F.when(F.col("_part") == 0, "train").otherwise("test")).drop("_part")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = CV_FOLDS) -> DataFrame:
    """Add `fold`: equal parts of every class."""
    return stratified_parts(df, key, label, [1] * folds, "fold")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    sizes = df.where(named(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    everything = Window.partitionBy()  # one row per class
    return sizes.withColumn(
        "weight", F.sum("rows").over(everything) / (F.count("*").over(everything) * F.col("rows"))
    )


def with_class_weight(df: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    found = class_weights(df, label).collect()
    value = F.coalesce(*[F.when(named(label) == r[label], F.lit(r["weight"])) for r in found])
    return df.withColumn(weight, value)
