"""An ordered index of distinct keys: ranks of any value among them, without sorting the keys again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.ordered import running_totals
from ebbline.workspace import stage

_LEAF = 16  # keys that are searched as one array
_FAN = 512  # arrays under one entry of the level above


def _at_or_below(sorted_values: Column, value: Column, most: int) -> Column:
    """How many of the sorted values are <= `value`, by bisection over arrays of fewer than 2 * `most` entries."""
    steps = []
    while most:
        steps.append(most)
        most //= 2
    last = F.reduce(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(-1),
        lambda found, step: F.when(F.get(sorted_values, found + step) <= value, found + step).otherwise(found),
    )
    return F.coalesce(last + 1, F.lit(0))


@dataclass(frozen=True)
class Ladder:
    """Distinct keys in order: `keys` (key, slot from 1 without gaps) and the levels through which a value is placed.

    A leaf holds 16 keys, and an entry above it the first keys of 512 leaves or entries, up to a single root. Placing
    a value costs one equi-join a level (the root is one row of 512 keys at most) and moves no keys but those of the
    leaves it meets.
    """

    keys: DataFrame
    levels: list[DataFrame]  # number, held (sorted keys); the root first, the leaves last

    @classmethod
    def fit(cls, keys: DataFrame, name: str) -> Ladder:
        """`keys`: one column `key` of distinct, non-null values."""
        ranked = running_totals(
            keys.select(F.lit("all").alias("set"), "key", F.lit(1).alias("here")), ["set"], "key", ["here"]
        ).select("key", F.col("upto_here").cast("long").alias("slot"))
        ranked = stage(ranked, f"{name}-keys")
        held = F.array_sort(F.collect_list("key")).alias("held")
        leaf = F.floor((F.col("slot") - 1) / _LEAF).cast("long").alias("number")
        levels = [stage(ranked.groupBy(leaf).agg(held), f"{name}-leaves")]
        while levels[0].count() > 1:
            firsts = levels[0].select(F.floor(F.col("number") / _FAN).cast("long").alias("number"), F.get("held", F.lit(0)).alias("key"))
            levels.insert(0, stage(firsts.groupBy("number").agg(held), f"{name}-level"))
        return cls(ranked, levels)

    def place(self, rows: DataFrame, value: str, rank: str) -> DataFrame:
        """`rows` with `rank`: how many keys are <= the column `value`."""
        placed = rows.withColumn("_number", F.lit(0).cast("long"))
        for level in self.levels[:-1]:
            met = placed.join(level.withColumnRenamed("number", "_number"), "_number")
            # Below the first key of all, the way is the leftmost one.
            child = F.col("_number") * _FAN + F.greatest(_at_or_below(F.col("held"), F.col(value), _FAN), F.lit(1)) - 1
            placed = met.withColumn("_number", child.cast("long")).drop("held")
        met = placed.join(self.levels[-1].withColumnRenamed("number", "_number"), "_number", "left")
        within = _at_or_below(F.col("held"), F.col(value), _LEAF)
        return met.withColumn(rank, F.col("_number") * _LEAF + within).drop("_number", "held")

    def save(self, path: str) -> None:
        self.keys.write.mode("overwrite").parquet(f"{path}/keys")
        for i, level in enumerate(self.levels):
            level.write.mode("overwrite").parquet(f"{path}/level-{i}")
        depth = self.keys.sparkSession.range(1).select(F.lit(len(self.levels)).alias("depth"))
        depth.write.mode("overwrite").parquet(f"{path}/depth")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ladder:
        depth = spark.read.parquet(f"{path}/depth").head()["depth"]
        levels = [spark.read.parquet(f"{path}/level-{i}") for i in range(depth)]
        return cls(spark.read.parquet(f"{path}/keys"), levels)
