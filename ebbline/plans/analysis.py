"""The complete analysis of a churn table, every result written as a table."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.fixed_values import CLASS_PLOT_COLUMNS, KEY, NUMERIC_PLOT_COLUMNS, TARGET
from ebbline.functions.expressions import to_number
from ebbline.operators import correlate, evaluate, profile
from ebbline.plans import registry, training
from ebbline.sources.tables import read_csv
from ebbline.workspace import stage

REPORTS_AT_ONCE = 6  # most are small jobs that wait for each other


@dataclass(frozen=True)
class Analysis:
    """Where the reports were written, and the chosen model."""

    root: str
    reports: list[str]
    bundle: registry.ModelBundle

    def report(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}")


def profile_reports(churn: DataFrame) -> dict[str, DataFrame]:
    """Profiles, statistics, distributions and plot data."""
    parsed = churn.withColumn("TotalCharges", to_number(F.col("TotalCharges")))
    numeric = profile.columns_of(churn, numeric=True)
    text = [c for c in profile.columns_of(churn, numeric=False) if c != TARGET]
    numbers = correlate.encoded_for_correlation(churn)
    return {
        "shape": profile.dataset_shape(churn),
        "preview": profile.preview_rows(churn, KEY),
        "columns": profile.column_profile(churn),
        "description": profile.describe_numeric(churn, numeric),
        "target": profile.target_distribution(churn),
        "statistics": profile.numeric_statistics(churn, numeric),
        "outliers": profile.iqr_outliers(churn, numeric),
        "categories": profile.categorical_distribution(churn, text),
        "counts_by_class": profile.counts_by_class(churn, CLASS_PLOT_COLUMNS),
        "histogram": profile.class_histogram(parsed, NUMERIC_PLOT_COLUMNS),
        "boxplot": profile.class_boxplot(parsed, NUMERIC_PLOT_COLUMNS),
        "correlations": correlate.correlation_matrix(numbers),
        "target_correlations": correlate.strongest(correlate.target_correlation(numbers), 15),
    }


def evaluation_reports(results: training.Comparison) -> dict[str, DataFrame]:
    """Metrics, tiers and curves of all models, and the confusion matrix of the best."""
    best = results.scores.where(F.col("model") == results.best)
    return {
        "cross_validation": results.cv,
        "metrics": results.metrics,
        "class_metrics": evaluate.per_class_metrics(results.scores),
        "tiers": evaluate.model_tiers(results.metrics),
        "roc": evaluate.roc_curve(results.scores),
        "pr": evaluate.pr_curve(results.scores),
        "confusion": evaluate.confusion_matrix(best),
    }


def executive_summary(churn: DataFrame, results: training.Comparison, features: int) -> DataFrame:
    """Customers, churn rate, features used, and the best model with its metrics, in one row."""
    best = results.metrics.where(F.col("model") == results.best).select(
        F.lit(1).alias("_one"), F.col("model").alias("best_model"), "roc_auc", "precision", "recall", "f1"
    )
    facts = churn.agg(
        F.lit(1).alias("_one"),
        F.count("*").alias("customers"),
        (F.count_if(F.col(TARGET) == "Yes") / F.count("*")).alias("churn_rate"),
    )
    return facts.withColumn("features_used", F.lit(features)).join(best, "_one").drop("_one")


def run_analysis(
    churn: DataFrame, root: str, at: Column | None = None, models: list[str] | None = None, grid: str = "short",
    trained: tuple[training.TrainingSet, training.Comparison] | None = None,
) -> Analysis:
    """Validate, profile, prepare, select, train, evaluate, register and save, all under `root`.

    The saved bundle holds the best model. `trained`, a training set and its comparison, is used instead of training.
    """
    at = F.current_timestamp() if at is None else at
    spark = churn.sparkSession
    churn = stage(churn, "churn")
    profile.require_valid(churn)
    if trained:
        data, results = trained
    else:
        data = training.prepare_training(churn)
        results = training.train_models(data, models, grid)
    reports = profile_reports(churn) | evaluation_reports(results)
    reports["summary"] = executive_summary(churn, results, len(data.features))
    with ThreadPool(REPORTS_AT_ONCE) as pool:
        pool.map(lambda name: reports[name].write.mode("overwrite").parquet(f"{root}/{name}"), list(reports), chunksize=1)
    registry.register(results.metrics, at, f"{root}/model_performance")
    best = results.best
    bundle = registry.ModelBundle(best, results.models[best], data.features, data.pipeline, data.scale)
    bundle.save(spark, f"{root}/bundle")
    return Analysis(root, [*reports, "model_performance"], bundle)


def run_csv_analysis(spark: SparkSession, path: str, root: str, **options) -> Analysis:
    return run_analysis(read_csv(spark, path), root, **options)
