"""Exact value counts, quantiles and moments of many numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import named
from ebbline.operators.ordered import running_totals


def unpivot(df: DataFrame, columns: list[str], keep: list[str] = (), to: str = "double") -> DataFrame:
    """Long form (`keep`, column, value), one row per non-NULL value."""
    wide = df.select(*[named(k).alias(k) for k in keep], *[named(c).cast(to).alias(c) for c in columns])
    ids = [named(k) for k in keep]
    return wide.unpivot(ids, [named(c) for c in columns], "column", "value").where(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) of numeric columns; combines map-side, so a frequent value is no hot key.

    Spark's exact `percentile`, `median` and `mode` keep all distinct values of a group in one
    buffer; counts by value keep them spread out.
    """
    return unpivot(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def interpolated(ranked: DataFrame, by: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles from rows with `value`, `n`, `upto_n` and `all_n`."""
    first, last = F.col("upto_n") - F.col("n"), F.col("upto_n") - 1

    def value_at(position: Column) -> Column:
        return F.max(F.when((position >= first) & (position <= last), F.col("value")))

    aggregates = [F.max("all_n").alias("count")]
    for name, p in probabilities.items():
        place = F.lit(p) * (F.col("all_n") - 1)
        aggregates += [value_at(F.floor(place)).alias(f"_low_{name}"), value_at(F.ceil(place)).alias(f"_high_{name}")]
    found = ranked.groupBy(*by).agg(*aggregates)
    for name, p in probabilities.items():
        place = F.lit(p) * (F.col("count") - 1)
        step = F.col(f"_high_{name}") - F.col(f"_low_{name}")
        found = found.withColumn(name, F.col(f"_low_{name}") + step * (place - F.floor(place)))
    return found.select(*by, "count", *probabilities)


def quantiles(counts: DataFrame, probabilities: dict[str, float], by: list[str] = ("column",)) -> DataFrame:
    """One row per group of a value-count table with its exact quantiles."""
    return interpolated(running_totals(counts, list(by), "value", ["n"]), list(by), probabilities)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def moments(counts: DataFrame) -> DataFrame:
    """mean, min, max, mode, variance, std, skewness and excess kurtosis per column.

    Central sums around the mean (no cancellation), then the bias-corrected sample forms; the mode
    is the smallest of the most frequent values.
    """
    weight, value = F.col("n"), F.col("value")
    centre = counts.groupBy("column").agg(
        F.sum(weight).alias("count"),
        (F.sum(value * weight) / F.sum(weight)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max_by("value", F.struct("n", -value)).alias("mode"),
    )
    apart = value - F.col("mean")
    sums = (
        counts.join(F.broadcast(centre.select("column", "mean")), "column")
        .groupBy("column")
        .agg(*[F.sum(weight * F.pow(apart, F.lit(k))).alias(f"_s{k}") for k in (2, 3, 4)])
    )
    n, s2, s3, s4 = F.col("count"), F.col("_s2"), F.col("_s3"), F.col("_s4")
    g1 = (s3 / n) / F.pow(s2 / n, F.lit(1.5))
    g2 = (s4 / n) / F.pow(s2 / n, F.lit(2)) - 3
    spread = s2 > 0
    return (
        centre.join(sums, "column")
        .withColumn("variance", F.when(n > 1, s2 / (n - 1)))
        .withColumn("std", F.sqrt("variance"))
        .withColumn("skewness", F.when(n > 2, F.when(spread, g1 * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(0.0)))
        .withColumn(
            "kurtosis",
            F.when(
                n > 3,
                F.when(spread, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).otherwise(0.0),
            ),
        )
        .drop("_s2", "_s3", "_s4")
    )
