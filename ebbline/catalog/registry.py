"""The registered queries and, where SQL can say the same, their oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.sources.base_view import load_churn_table
from ebbline.workspace import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return add


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_churn_table(spark, sf_dir)


def staged_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that pass over the churn table several times."""
    return stage(load_churn_table(spark, sf_dir), "churn")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Accumulated floats are compared after rounding, as their last digits depend on the order of the sum.


def r6(value: Column) -> Column:
    return F.round(value, 6) + F.lit(0.0)


def r6_sql(value: str) -> str:
    return f"(round({value}, 6) + 0.0)"


def sig(value: Column) -> Column:
    """Ten significant digits, for statistics of any magnitude."""
    scale = F.pow(F.lit(10.0), F.lit(9.0) - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, 0.0).otherwise(F.round(value * scale, 0) / scale)


def sig_sql(value: str) -> str:
    scale = f"pow(10.0::DOUBLE, 9.0 - floor(log10(abs({value}))))"
    return f"CASE WHEN {value} = 0 THEN 0.0 ELSE round({value} * {scale}, 0) / {scale} END"


def rounded(df: DataFrame, columns: list[str], how: Callable[[Column], Column] = r6) -> DataFrame:
    return df.withColumns({c: how(F.col(c)) for c in columns})
