"""The corpus pipeline: stages that each write the documents they keep for the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbline.llm.stages import PIPELINE
from ebbline.llm.tables import read_table
from ebbline.workspace import stage

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = PIPELINE
# Trained models and tokenization are beyond SQL; tests/llm compares the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
