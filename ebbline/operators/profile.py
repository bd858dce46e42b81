"""Profiles of a table: shape, columns, statistics, outliers, distributions, plot data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.fixed_values import HISTOGRAM_BINS, LOW_CARDINALITY, TARGET
from ebbline.functions.expressions import named
from ebbline.operators.quantiles import QUARTILES, interpolated, moments, quantiles, unpivot, value_counts
from ebbline.operators.ordered import running_totals


def columns_of(df: DataFrame, numeric: bool) -> list[str]:
    """Names of the numeric, or of the text, columns."""
    wanted = T.NumericType if numeric else T.StringType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def columns_by_type(df: DataFrame) -> DataFrame:
    """One row per column with its kind and its non-NULL count."""
    kinds = {c: "numeric" for c in columns_of(df, True)} | {c: "categorical" for c in columns_of(df, False)}
    counted = df.agg(*[F.count(named(c)).alias(c) for c in kinds])
    long = counted.unpivot([], [named(c) for c in kinds], "column", "non_null")
    return long.withColumn("kind", F.element_at(_literal_map(kinds), F.col("column")))


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def validate_input(df: DataFrame, target: str = TARGET) -> DataFrame:
    """One row per rule with the number of violations; zero everywhere means valid input."""
    has_target = target in df.columns
    bad_target = (
        F.count_if(~F.coalesce(named(target).isin("Yes", "No"), F.lit(False))) if has_target else F.count("*")
    )
    counted = df.agg(
        (F.count("*") == 0).cast("long").alias("table_is_empty"),
        F.lit(0 if has_target else 1).cast("long").alias("target_column_missing"),
        bad_target.alias("target_not_yes_or_no"),
    )
    return counted.unpivot([], counted.columns, "rule", "violations")


def require_valid(df: DataFrame, target: str = TARGET) -> None:
    """Fail on input without rows or without the target column."""
    if target not in df.columns:
        raise ValueError(f"Target column {target!r} not found")
    if df.isEmpty():
        raise ValueError("Dataset is empty")


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("samples")).withColumn("features", F.lit(len(df.columns) - 1).cast("long"))


def _text_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) with the NULLs as their own group."""
    wide = df.select(*[named(c).cast("string").alias(c) for c in columns])
    return (
        wide.unpivot([], [named(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type, non-NULL, NULL, NULL share and distinct count per column, from one scan."""
    types = dict(df.dtypes)
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    return (
        _text_counts(df, df.columns)
        .groupBy("column")
        .agg(F.sum("n").alias("rows"), nulls.alias("null_count"), F.count("value").alias("unique_values"))
        .select(
            "column",
            F.element_at(_literal_map(types), F.col("column")).alias("data_type"),
            (F.col("rows") - F.col("null_count")).alias("non_null_count"),
            "null_count",
            (F.col("null_count") / F.col("rows") * 100).alias("null_percentage"),
            "unique_values",
        )
    )


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    counts = value_counts(df, columns)
    basics = moments(counts).select("column", "count", "mean", "std", "min", "max")
    return basics.join(quantiles(counts, QUARTILES).drop("count"), "column")


def numeric_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """The twelve statistics per numeric column."""
    counts = value_counts(df, columns)
    return (
        moments(counts)
        .drop("count")
        .join(quantiles(counts, QUARTILES).drop("count"), "column")
        .withColumn("iqr", F.col("q3") - F.col("q1"))
    )


def _fences() -> tuple[Column, Column]:
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return F.col("q1") - reach, F.col("q3") + reach


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values strictly beyond 1.5 IQR from the quartiles, counted per column."""
    counts = value_counts(df, columns)
    low, high = _fences()
    bounds = quantiles(counts, QUARTILES).select("column", low.alias("lower_bound"), high.alias("upper_bound"))
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return (
        counts.join(F.broadcast(bounds), "column")  # one row per column
        .groupBy("column", "lower_bound", "upper_bound")
        .agg(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outliers"))
    )


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Count and percentage per class."""
    classes = df.where(named(target).isNotNull()).groupBy(named(target).alias(target)).agg(F.count("*").alias("n"))
    return classes.withColumn("percentage", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def categorical_distribution(df: DataFrame, columns: list[str], at_most: int = LOW_CARDINALITY) -> DataFrame:
    """Value counts, as a share of all rows, of the text columns with few distinct values."""
    counts = _text_counts(df, columns)
    sizes = counts.groupBy("column").agg(F.count("value").alias("levels"), F.sum("n").alias("rows"))
    return (
        counts.where(F.col("value").isNotNull())
        .join(F.broadcast(sizes.where(F.col("levels") <= at_most)), "column")  # one row per column
        .select("column", "value", "n", (F.col("n") / F.col("rows") * 100).alias("percentage"))
    )


def counts_by_class(df: DataFrame, columns: list[str], target: str = TARGET) -> DataFrame:
    """Rows per column value and class."""
    long = unpivot(df, columns, keep=[target], to="string")
    return long.groupBy("column", "value", target).agg(F.count("*").alias("n"))


def class_histogram(
    df: DataFrame, columns: list[str], target: str = TARGET, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins over the common range of all classes; the last bin is closed."""
    counts = unpivot(df, columns, keep=[target]).groupBy("column", target, "value").agg(F.count("*").alias("n"))
    ends = counts.groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    flat = F.col("low") == F.col("high")
    ranges = ends.select(
        "column",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")) / bins).alias("width"),
    )
    place = F.least(F.floor((F.col("value") - F.col("low")) / F.col("width")), F.lit(bins - 1)).cast("int")
    filled = (
        counts.join(F.broadcast(ranges), "column")  # one row per column
        .groupBy("column", target, place.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    every_bin = (
        ranges.join(counts.select("column", target).distinct(), "column")
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    )
    return every_bin.join(filled, ["column", target, "bin"], "left").select(
        "column",
        target,
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def class_boxplot(df: DataFrame, columns: list[str], target: str = TARGET) -> DataFrame:
    """Quartiles, whisker ends and number of fliers per column and class."""
    by = ["column", target]
    counts = unpivot(df, columns, keep=[target]).groupBy(*by, "value").agg(F.count("*").alias("n"))
    ranked = running_totals(counts, by, "value", ["n"])
    low, high = _fences()
    boxes = interpolated(ranked, by, QUARTILES).withColumns({"_low": low, "_high": high})
    inside = (F.col("value") >= F.col("_low")) & (F.col("value") <= F.col("_high"))
    return (
        counts.join(F.broadcast(boxes), by)  # one row per column and class
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("fliers"),
        )
    )


def preview_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first `n` rows by key."""
    return df.orderBy(named(key)).limit(n)


def churn_by_segment(df: DataFrame, segments: list[str], target: str = TARGET) -> DataFrame:
    """Customers, churners, churn rate and mean charge per segment."""
    churned = F.count_if(named(target) == "Yes")
    cents = F.round(F.col("MonthlyCharges") * 100).cast("long")
    return df.groupBy(*segments).agg(
        F.count("*").alias("customers"),
        churned.alias("churned"),
        (churned / F.count("*")).alias("churn_rate"),
        (F.sum(cents) / F.count("*") / 100).alias("mean_monthly_charge"),
    )
