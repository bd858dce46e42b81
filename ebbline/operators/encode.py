"""Category levels: label codes and indicators, named or sparse, of any cardinality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import named
from ebbline.operators.ordered import running_totals
from ebbline.operators.quantiles import unpivot
from ebbline.workspace import stage

def level_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, level, code): 0-based codes by sorted level, spread out whatever the cardinality."""
    levels = (
        unpivot(df, columns, to="string")
        .distinct()
        .select("column", F.col("value").alias("level"), F.lit(1).alias("one"))
    )
    ranked = running_totals(levels, ["column"], "level", ["one"])
    return ranked.select("column", "level", (F.col("upto_one") - 1).cast("int").alias("code"))


def fit_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted levels per column, as many as there are; they name columns, so they come to the driver."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in unpivot(df, columns, to="string").distinct().collect():
        found[row["column"]].append(row["value"])
    return {c: sorted(levels) for c, levels in found.items()}


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each text column by its code among the sorted levels, whatever their number.

    Every column is joined on (column, level) of the one code table, so the joins share one scan and one exchange of
    it; where it is small Spark broadcasts it, so a frequent level stays where it is read. NULL has no code.
    """
    found = level_codes(df, columns).select(F.struct("column", "level").alias("_level"), F.col("code").alias("_code"))
    codes = stage(found, "level-codes")
    encoded = df
    for i, column in enumerate(columns):
        held = F.struct(F.lit(column).alias("column"), named(column).cast("string").alias("level"))
        encoded = encoded.join(codes.alias(f"_c{i}"), held == F.col(f"_c{i}._level"), "left")
    place = {c: F.col(f"_c{i}._code").alias(c) for i, c in enumerate(columns)}
    return encoded.select(*[place.get(c, named(c)) for c in df.columns])


def one_hot_entries(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column, level, code) of the indicators that are 1: the sparse form of `one_hot`, for any number of levels.

    The first level of a column is dropped, as there.
    """
    held = df.select(named(key).alias(key), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("level")) for c in columns
    ])).alias("held")).select(key, "held.column", "held.level")
    return held.join(level_codes(df, columns).where("code > 0"), ["column", "level"]).select(key, "column", "level", "code")


def indicator_names(levels: dict[str, list[str]]) -> list[str]:
    return [f"{column}_{level}" for column, known in levels.items() for level in known[1:]]


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each column by 0/1 indicators of all its levels but the first.

    A NULL or unseen level gets all zeros, like the dropped level.
    """
    indicators = [
        F.when(named(column) == level, 1.0).otherwise(0.0).alias(f"{column}_{level}")
        for column, known in levels.items()
        for level in known[1:]
    ]
    return df.select(*[named(c) for c in df.columns if c not in levels], *indicators)
