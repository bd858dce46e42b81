"""Metrics and curves of scored rows: (model, label 1/0, probability, prediction 1/0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.expressions import auc_tier, deployable, precision_tier, recall_tier
from ebbline.operators.ordered import running_totals

VOTE = "Voting Ensemble"


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def threshold_counts(scored: DataFrame) -> DataFrame:
    """Per model and distinct probability: rows at it (n0, n1), those of them predicted positive
    (called0, called1), and hits and false alarms at or above it. All other tables here follow."""
    label, called = F.col("label"), F.col("prediction")
    counts = scored.groupBy("model", "probability").agg(
        F.sum(1 - label).alias("n0"), F.sum(label).alias("n1"),
        F.sum((1 - label) * called).alias("called0"), F.sum(label * called).alias("called1"),
    )
    ranked = running_totals(counts, ["model"], "probability", ["n0", "n1"])
    return ranked.select(
        "model", "probability", "n0", "n1", "called0", "called1",
        (F.col("all_n1") - F.col("upto_n1") + F.col("n1")).alias("tp"),
        (F.col("all_n0") - F.col("upto_n0") + F.col("n0")).alias("fp"),
        F.col("all_n1").alias("positives"),
        F.col("all_n0").alias("negatives"),
    )


def _ranking(thresholds: DataFrame) -> DataFrame:
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    below = F.col("negatives") - F.col("fp")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return thresholds.groupBy("model").agg(
        F.sum(n1 * (below + n0 / 2)).alias("_pairs"),
        F.sum(n1 * precision).alias("_steps"),
        F.max("positives").alias("_p"),
        F.max("negatives").alias("_n"),
        F.sum("called1").alias("tp"),
        F.sum("called0").alias("fp"),
    ).withColumns({
        "roc_auc": F.when(
            (F.col("_p") > 0) & (F.col("_n") > 0),
            F.col("_pairs") / (F.col("_p").cast("double") * F.col("_n").cast("double")),
        ),
        "avg_precision": ratio(F.col("_steps"), F.col("_p")),
    })


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) per model."""
    return _ranking(threshold_counts(scored)).select("model", "roc_auc", "avg_precision")


def confusion(scored: DataFrame) -> DataFrame:
    """tp, fp, fn and tn per model."""
    label, hit = F.col("label") == 1, F.col("prediction") == 1
    return scored.groupBy("model").agg(
        F.count_if(label & hit).alias("tp"),
        F.count_if(~label & hit).alias("fp"),
        F.count_if(label & ~hit).alias("fn"),
        F.count_if(~label & ~hit).alias("tn"),
    )


def _scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column]:
    return ratio(tp, tp + fp), ratio(tp, tp + fn)


def classification_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, ROC-AUC and average precision per model, from one pass."""
    tp, fp, positives, negatives = (F.col(c) for c in ("tp", "fp", "_p", "_n"))
    precision, recall = _scores(tp, fp, positives - tp)
    return _ranking(threshold_counts(scored)).select(
        "model",
        ((tp + negatives - fp) / (positives + negatives)).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * tp, tp + fp + positives).alias("f1"),
        "roc_auc",
        "avg_precision",
    )


def per_class_metrics(scored: DataFrame) -> DataFrame:
    """Precision and recall of both classes per model."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    churn, stay = _scores(tp, fp, fn), _scores(tn, fn, fp)
    rows = F.explode(
        F.array(
            F.struct(F.lit("No Churn").alias("class"), stay[0].alias("precision"), stay[1].alias("recall")),
            F.struct(F.lit("Churn").alias("class"), churn[0].alias("precision"), churn[1].alias("recall")),
        )
    )
    return confusion(scored).select("model", rows.alias("r")).select("model", "r.*")


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the highest ROC-AUC; ties by name. One row per model goes in."""
    best = Window.partitionBy().orderBy(F.col("roc_auc").desc_nulls_last(), "model")
    return metrics.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") == 1).drop("_nth")


def roc_curve(scored: DataFrame) -> DataFrame:
    """One point per distinct probability, and the origin with a NULL threshold."""
    counts = threshold_counts(scored)
    points = counts.select(
        "model",
        F.col("probability").alias("threshold"),
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    origin = counts.select("model").distinct().select(
        "model", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(scored: DataFrame) -> DataFrame:
    """One point per distinct probability, and (recall 0, precision 1) with a NULL threshold."""
    counts = threshold_counts(scored)
    points = counts.select(
        "model",
        F.col("probability").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        ratio(F.col("tp"), F.col("positives")).alias("recall"),
    )
    end = counts.select("model").distinct().select(
        "model", F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Rows per model, actual class and predicted class; all four cells are present."""
    cells = F.explode(
        F.array(*[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
            for a, p, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
        ])
    )
    return confusion(scored).select("model", cells.alias("cell")).select("model", "cell.*")


def model_tiers(metrics: DataFrame) -> DataFrame:
    """Verbal tiers of the metrics and whether the model may be deployed."""
    return metrics.select(
        "model",
        precision_tier(F.col("precision")).alias("precision_tier"),
        recall_tier(F.col("recall")).alias("recall_tier"),
        auc_tier(F.col("roc_auc")).alias("auc_tier"),
        deployable(F.col("roc_auc"), F.col("precision"), F.col("recall")).alias("deploy"),
    )


def soft_vote(scored: DataFrame, models: list[str], key: str, name: str = VOTE) -> DataFrame:
    """Mean probability of the given models per row; positive above one half."""
    mean = F.sum("probability") / F.count("probability")
    return (
        scored.where(F.col("model").isin(models))
        .groupBy(key, "label")
        .agg(mean.alias("probability"))
        .select(
            F.lit(name).alias("model"), key, "label", "probability",
            (F.col("probability") > 0.5).cast("int").alias("prediction"),
        )
    )
