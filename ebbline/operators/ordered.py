"""Running totals and ranks over one global order, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CUTS = 800  # expected cuts a group; their number varies by some thirty, bisection reaches 1,023
_STEPS = [512, 256, 128, 64, 32, 16, 8, 4, 2, 1]


def _cuts_up_to(cuts: Column, value: Column) -> Column:
    """How many of the sorted `cuts` are <= `value`, by bisection."""
    last = F.reduce(
        F.array(*[F.lit(s) for s in _STEPS]),
        F.lit(-1),
        lambda found, step: F.when(F.get(cuts, found + step) <= value, found + step).otherwise(found),
    )
    # Never NULL, and marked so: else a join on it would filter by computing it once more.
    return F.coalesce(last + 1, F.lit(0))


def running_totals(df: DataFrame, by: list[str], order: str, totals: list[str]) -> DataFrame:
    """Add `upto_<t>` and `all_<t>` for each total `t`: its sum up to and including the row, and overall.

    Needs one row per (`by`, `order`) and few `by` groups (columns, models or classes): each group
    is cut into about 800 order ranges, every range is summed on its own, and the range sums, a
    bounded table, are carried over. The cuts are the values whose hash lies below a threshold that
    the count gives, so they are an even sample, the same whenever a task is run again, and no more
    of them move when there are more tasks.
    """
    # Hashes are even, so the share of values to pick is the share of hashes below a threshold.
    share = F.least(F.lit(1.0), _CUTS / F.col("_values"))
    sizes = df.groupBy(*by).agg(F.count("*").alias("_values"))
    picked = (
        df.select(*by, order)
        .join(F.broadcast(sizes), by)
        .where(F.pmod(F.xxhash64(order), F.lit(1 << 40)) < share * (1 << 40))
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(order)).alias("_picked"))
    )
    cuts = sizes.join(picked, by, "left").select(
        *by, F.coalesce("_picked", F.slice("_picked", 1, 0)).alias("_cuts")
    )
    ranged = (
        df.join(F.broadcast(cuts), by)
        .withColumn("_range", _cuts_up_to(F.col("_cuts"), F.col(order)))
        .drop("_cuts")
    )
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    range_sums = ranged.groupBy(*by, "_range").agg(*[F.sum(t).alias(t) for t in totals])
    carried = range_sums.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_before_{t}") for t in totals],
        *[F.sum(t).over(whole).alias(f"all_{t}") for t in totals],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(carried), [*by, "_range"])
        .withColumns({f"upto_{t}": F.sum(t).over(inside) + F.col(f"_before_{t}") for t in totals})
        .drop("_range", *[f"_before_{t}" for t in totals])
    )
