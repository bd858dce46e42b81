"""Feature scores against a 1/0 class and the vote over several selections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.fixed_values import SELECT_TOP, VOTES_NEEDED
from ebbline.functions.expressions import named
from ebbline.operators.ordered import running_totals
from ebbline.operators.quantiles import unpivot

INFORMATION_BINS = 10


def counts_by_label(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, value, n0, n1), combined map-side; the scores below need nothing else."""
    wide = df.where(named(label).isNotNull()).withColumn("_label", named(label).cast("long"))
    return (
        unpivot(wide, features, keep=["_label"])
        .groupBy(F.col("column").alias("feature"), "value")
        .agg(F.sum(1 - F.col("_label")).alias("n0"), F.sum("_label").alias("n1"))
    )


def anova_f(counts: DataFrame) -> DataFrame:
    """ANOVA F of each feature between the two classes; NULL for a constant feature."""
    value, n0, n1 = F.col("value"), F.col("n0"), F.col("n1")
    centre = counts.groupBy("feature").agg(
        F.sum("n0").alias("rows0"),
        F.sum("n1").alias("rows1"),
        (F.sum(value * n0) / F.sum("n0")).alias("mean0"),
        (F.sum(value * n1) / F.sum("n1")).alias("mean1"),
        (F.sum(value * (n0 + n1)) / F.sum(n0 + n1)).alias("mean"),
    )

    def square(x: Column) -> Column:
        return x * x

    within = F.sum(n0 * square(value - F.col("mean0")) + n1 * square(value - F.col("mean1")))
    between = F.col("rows0") * square(F.col("mean0") - F.col("mean")) + F.col("rows1") * square(
        F.col("mean1") - F.col("mean")
    )
    freedom = F.col("rows0") + F.col("rows1") - 2
    return (
        counts.join(F.broadcast(centre), "feature")  # one row per feature
        .groupBy("feature", between.alias("between"), freedom.alias("freedom"))
        .agg(within.alias("within"))
        .select("feature", F.when(F.col("within") > 0, F.col("between") / (F.col("within") / F.col("freedom"))).alias("score"))
    )


def mutual_information(counts: DataFrame, bins: int = INFORMATION_BINS) -> DataFrame:
    """Mutual information of each feature with the class.

    A feature with few values uses them as they are; any other is cut into bins of equal frequency,
    equal values staying together.
    """
    ordered = running_totals(
        counts.withColumns({"n": F.col("n0") + F.col("n1"), "one": F.lit(1)}), ["feature"], "value", ["n", "one"]
    )
    few = F.col("all_one") <= bins
    place = F.when(few, F.col("upto_one") - 1).otherwise(F.expr(f"((upto_n - n) * {bins}) div all_n"))
    cells = (
        ordered.groupBy("feature", place.alias("bin"))
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    per_feature = Window.partitionBy("feature")  # at most `bins` rows
    totals = cells.withColumns({
        "rows0": F.sum("n0").over(per_feature).cast("double"),
        "rows1": F.sum("n1").over(per_feature).cast("double"),
    })
    rows, cell = F.col("rows0") + F.col("rows1"), F.col("n0") + F.col("n1")

    def term(n: str, of_class: str) -> Column:
        return F.when(F.col(n) > 0, F.col(n) / rows * F.ln(F.col(n) * rows / (cell * F.col(of_class)))).otherwise(0.0)

    return totals.groupBy("feature").agg(F.sum(term("n0", "rows0") + term("n1", "rows1")).alias("score"))


def top_features(scores: DataFrame, n: int = SELECT_TOP) -> DataFrame:
    """The `n` features with the highest score; ties by name. One row per feature goes in."""
    best = Window.partitionBy().orderBy(F.col("score").desc_nulls_last(), "feature")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def feature_votes(selections: dict[str, DataFrame], needed: int = VOTES_NEEDED) -> DataFrame:
    """Votes per feature over several selections and whether they suffice."""
    members = [
        chosen.select(F.lit(method).alias("method"), "feature") for method, chosen in selections.items()
    ]
    return (
        reduce(DataFrame.unionByName, members)
        .groupBy("feature")
        .agg(F.count_distinct("method").alias("votes"))
        .withColumn("selected", F.col("votes") >= needed)
    )


def vote_report(votes: DataFrame, features: int, n: int = 15) -> DataFrame:
    """The `n` features with most votes (ties by name), with the count of all and kept features and the reduction.

    `votes` has one row per feature with a vote, a table as long as the feature table is wide.
    """
    everything = Window.partitionBy()
    place = Window.partitionBy().orderBy(F.desc("votes"), "feature")
    kept = F.sum(F.col("selected").cast("long")).over(everything)
    return (
        votes.withColumn("place", F.row_number().over(place))
        .withColumn("features", F.lit(features).cast("long"))
        .withColumn("kept", kept)
        .withColumn("reduction_percent", 100.0 * (F.col("features") - F.col("kept")) / F.col("features"))
        .where(F.col("place") <= n)
        .select("place", "feature", "votes", "selected", "features", "kept", "reduction_percent")
    )
