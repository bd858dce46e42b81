"""Imputation of a missing number from its nearest rows in two coordinates, exact and without all pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.fixed_values import IMPUTE_NEIGHBOURS
from ebbline.functions.expressions import named
from ebbline.operators.ladder import Ladder
from ebbline.workspace import stage

_LINES_AT_ONCE = 128  # lines on either side of a probe that its first look goes to


def _point(line: str, place: str) -> Column:
    return F.struct(named(line).cast("double").alias("line"), named(place).cast("double").alias("place"))


@dataclass(frozen=True)
class Donors:
    """Donor points in the order of (line, place), and the distinct lines that hold any."""

    points: DataFrame  # slot, donor (the point), mates
    order: Ladder
    lines: Ladder

    def save(self, path: str) -> None:
        self.points.write.mode("overwrite").parquet(f"{path}/points")
        self.order.save(f"{path}/order")
        self.lines.save(f"{path}/lines")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Donors:
        return cls(
            spark.read.parquet(f"{path}/points"), Ladder.load(spark, f"{path}/order"), Ladder.load(spark, f"{path}/lines")
        )


def donor_points(
    df: DataFrame, target: str, line: str, place: str, key: str, k: int = IMPUTE_NEIGHBOURS
) -> Donors:
    """Rows with a value as points, each with its `k` first rows by key, indexed once for all look-ups.

    Further rows at the same point can never be among the `k` nearest, as ties go by key.
    """
    rows = df.where(named(target).isNotNull() & named(line).isNotNull() & named(place).isNotNull()).select(
        _point(line, place).alias("point"),
        named(key).alias("key"),
        named(target).cast("double").alias("value"),
    )
    first = F.row_number().over(Window.partitionBy("point").orderBy("key"))
    points = (
        rows.withColumn("_nth", first)
        .where(F.col("_nth") <= k)
        .groupBy("point")
        .agg(F.array_sort(F.collect_list(F.struct("key", "value"))).alias("mates"))
    )
    points = stage(points, "donors")
    order = Ladder.fit(points.select(F.col("point").alias("key")), "donor-order")
    lines = Ladder.fit(points.select(F.col("point.line").alias("key")).distinct(), "donor-lines")
    slotted = points.join(order.keys, F.col("point") == F.col("key")).select("slot", F.col("point").alias("donor"), "mates")
    return Donors(stage(slotted, "donor-slots"), order, lines)


def _around(donors: Donors, probes: DataFrame, k: int) -> DataFrame:
    """Join every probe (with column `at`) to the `k` donor points before and after `at` in point order."""
    placed = donors.order.place(probes, "at", "_rank")
    wanted = placed.withColumn("slot", F.explode(F.sequence(F.col("_rank") - k + 1, F.col("_rank") + k))).drop("_rank")
    return wanted.join(donors.points, "slot").drop("slot")


def _square_distance() -> Column:
    return (F.col("point.line") - F.col("donor.line")) * (F.col("point.line") - F.col("donor.line")) + (
        F.col("point.place") - F.col("donor.place")
    ) * (F.col("point.place") - F.col("donor.place"))


def _nearest(candidates: DataFrame, k: int) -> DataFrame:
    """(point, square, key, value): the `k` nearest donor rows per probe point; ties by key."""
    near = Window.partitionBy("point").orderBy("square", "key")
    return candidates.withColumn("_nth", F.row_number().over(near)).where(F.col("_nth") <= k).drop("_nth")


def _reach(near: DataFrame, k: int) -> DataFrame:
    """(point, reach): square of the distance within which the `k` nearest lie; NULL where fewer are known."""
    return near.groupBy("point").agg(F.when(F.count("*") >= k, F.max("square")).alias("reach"))


def _mates(met: DataFrame) -> DataFrame:
    return met.withColumn("square", _square_distance()).select("point", "square", F.explode("mates").alias("mate")).select(
        "point", "square", "mate.key", "mate.value"
    )


def imputed_points(donors: Donors, probes: DataFrame, k: int = IMPUTE_NEIGHBOURS) -> DataFrame:
    """(point, imputed) for distinct probe points: mean value of the `k` nearest donor rows.

    The neighbours of a probe in the order of (line, place) bound its radius. On each line the nearest points are
    the ones next to the probe's own place, so looking at `k` points on both sides, on every line within the radius
    that holds donors, finds all of the nearest. Lines are visited outward from the probe's own, some at a time;
    what they hold shortens the radius, and a probe is done when the next line lies beyond it. So the work
    follows the lines that exist near a probe, not the numbers they stand for. Each look-up is an equi-join on a
    position, never a comparison with all donors.
    """
    probes = stage(probes.select("point"), "probes")
    beside = _nearest(_mates(_around(donors, probes.select("point", F.col("point").alias("at")), k)), k)
    bound = stage(_reach(beside, k), "reach")
    placed = donors.lines.place(probes.select("point", F.col("point.line").alias("_at")), "_at", "_middle")
    placed = stage(placed.select("point", "_middle"), "probe-lines")
    lines = donors.lines.keys.select(F.col("slot").alias("_slot"), F.col("key").alias("line"))
    count = lines.agg(F.max("_slot")).head()[0] or 0
    found, done, width = None, 0, _LINES_AT_ONCE
    while found is None or done < count:
        steps = F.concat(
            F.sequence(F.col("_middle") - (width - 1), F.col("_middle") - done),
            F.sequence(F.col("_middle") + (done + 1), F.col("_middle") + width),
        )
        asked = placed.join(bound, "point", "left").withColumn("_slot", F.explode(steps)).join(lines, "_slot")
        gap = (F.col("line") - F.col("point.line")) * (F.col("line") - F.col("point.line"))
        asked = asked.where(F.col("reach").isNull() | (gap <= F.col("reach")))
        if found is not None:
            asked = stage(asked, "probe-outward")
            if asked.isEmpty():
                break
        at = F.struct("line", F.col("point.place").alias("place")).alias("at")
        met = _mates(_around(donors, asked.select("point", at), k).where(F.col("donor.line") == F.col("at.line")))
        found = stage(_nearest(met if found is None else found.unionByName(met), k), "near")
        done, width = width, 4 * width
        if done < count:
            bound = stage(_reach(found, k).unionByName(bound).groupBy("point").agg(F.min("reach").alias("reach")), "reach")
    means = found.groupBy("point").agg((F.sum("value") / F.count("*")).alias("imputed"))
    return probes.join(means, "point", "left")


def impute(
    df: DataFrame, donors: Donors, target: str, line: str, place: str, k: int = IMPUTE_NEIGHBOURS
) -> DataFrame:
    """Fill `target` where missing; rows that have a value pass through without a shuffle.

    Rows without coordinates stay missing. The neighbours are found at once, so `df` should be a staged table.
    """
    missing = named(target).isNull()
    gaps = df.where(missing).withColumn("point", _point(line, place))
    probes = gaps.where(named(line).isNotNull() & named(place).isNotNull()).select("point").distinct()
    filled = (
        gaps.join(imputed_points(donors, probes, k), "point", "left")
        .withColumn(target, F.col("imputed"))
        .select(*[named(c) for c in df.columns])
    )
    return df.where(~missing).unionByName(filled)
