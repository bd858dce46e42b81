"""Saved model bundles and the table of their performance."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.scale import RobustScale
from ebbline.plans.features import FeaturePipeline
from ebbline.plans.saved import load_model, save_model
from ebbline.schemas import MODEL_PERFORMANCE


@dataclass(frozen=True)
class ModelBundle:
    """Everything scoring needs: preparation, scaling, feature list, model and its name."""

    name: str
    model: Any
    features: list[str]
    pipeline: FeaturePipeline
    scale: RobustScale

    def save(self, spark: SparkSession, path: str) -> None:
        save_model(spark, self.model, f"{path}/model")
        rows = [(i, f, self.scale.centre[f], self.scale.spread[f]) for i, f in enumerate(self.features)]
        spark.createDataFrame(rows, "place int, feature string, centre double, spread double").write.mode(
            "overwrite"
        ).parquet(f"{path}/scale")
        self.pipeline.save(spark, f"{path}/preparation")
        spark.createDataFrame([(self.name, len(self.features))], "name string, feature_count int").write.mode(
            "overwrite"
        ).parquet(f"{path}/info")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelBundle:
        rows = sorted(spark.read.parquet(f"{path}/scale").collect(), key=lambda r: r["place"])  # one per feature
        scale = RobustScale({r["feature"]: r["centre"] for r in rows}, {r["feature"]: r["spread"] for r in rows})
        return cls(
            spark.read.parquet(f"{path}/info").head()["name"],
            load_model(spark, f"{path}/model"),
            [r["feature"] for r in rows],
            FeaturePipeline.load(spark, f"{path}/preparation"),
            scale,
        )


def performance_rows(metrics: DataFrame, at: Column) -> DataFrame:
    """Metrics as rows of the model_performance table."""
    values = {
        "model_name": F.col("model"), "accuracy": F.col("accuracy"), "precision_score": F.col("precision"),
        "recall_score": F.col("recall"), "f1_score": F.col("f1"), "roc_auc": F.col("roc_auc"),
        "training_date": at, "created_at": at,
    }
    return metrics.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in MODEL_PERFORMANCE.fields])


def register(metrics: DataFrame, at: Column, path: str) -> None:
    performance_rows(metrics, at).write.mode("append").parquet(path)


def model_info(performance: DataFrame, features: int) -> DataFrame:
    """The best model of the latest training run: name, metrics, date and feature count."""
    return (
        performance.orderBy(F.col("training_date").desc(), F.col("roc_auc").desc_nulls_last(), "model_name")
        .limit(1)
        .select(
            F.col("model_name").alias("best_model_name"), "accuracy", "precision_score", "recall_score",
            "f1_score", "roc_auc", "training_date", F.lit(features).alias("feature_count"),
        )
    )
