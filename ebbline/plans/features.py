"""The fitted feature preparation used alike for training, batch scoring and requests."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.fixed_values import (
    BINARY_COLUMNS, KEY, LIFECYCLE_LABELS, ONE_HOT_COLUMNS, TARGET, TENURE_GROUP_LABELS,
)
from ebbline.functions.expressions import binary_code, engineered_columns, named, to_number
from ebbline.operators.encode import fit_levels, indicator_names, one_hot
from ebbline.operators.neighbours import Donors, donor_points, impute
from ebbline.operators.profile import columns_of
from ebbline.schemas import ATTRIBUTE_NAMES


def numeric_charges(df: DataFrame) -> DataFrame:
    """`TotalCharges` as a number; zero for customers in their first month."""
    return df.withColumn(
        "TotalCharges",
        F.when(F.col("tenure") == 0, 0.0).otherwise(to_number(F.col("TotalCharges").cast("string"))),
    )


def charges_or_zero(df: DataFrame) -> DataFrame:
    """The simple request rule: a missing or unreadable `TotalCharges` counts as 0."""
    return df.withColumn("TotalCharges", F.coalesce(to_number(F.col("TotalCharges").cast("string")), F.lit(0.0)))


def align_features(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """Exactly the fitted features in fitted order; an absent one becomes 0."""
    return df.select(
        *[named(c) for c in keep],
        *[named(c).alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in features],
    )


def project_features(df: DataFrame, key: str = KEY, target: str = TARGET) -> DataFrame:
    return df.drop(key, target)


def columns_kept(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


@dataclass(frozen=True)
class FeaturePipeline:
    """Levels and donors learnt from training rows; `transform` has a fixed output schema.

    `missing="neighbours"` fills `TotalCharges` as in training; `"zero"` needs no look-up, so it
    also works inside a streaming query.
    """

    levels: dict[str, list[str]]
    donors: Donors

    @classmethod
    def fit(cls, df: DataFrame) -> FeaturePipeline:
        """`df` is read several times and should be a staged table."""
        text = [c for c in ONE_HOT_COLUMNS if c in df.columns]
        found = fit_levels(df, text)
        fixed = {"tenure_group": TENURE_GROUP_LABELS, "customer_lifecycle": LIFECYCLE_LABELS}
        levels = {c: found.get(c) or fixed[c] for c in ONE_HOT_COLUMNS if c in found or c in fixed}
        donors = donor_points(numeric_charges(df), "TotalCharges", "tenure", "MonthlyCharges", KEY)
        return cls(levels, donors)

    @property
    def features(self) -> list[str]:
        plain = [c for c in ATTRIBUTE_NAMES if c not in self.levels]
        made = [
            "avg_monthly_charges", "charges_per_service", "total_services", "service_adoption_rate",
            "high_risk_contract", "high_risk_payment",
        ]
        return plain + made + indicator_names(self.levels)

    def transform(self, df: DataFrame, missing: str = "neighbours", keep: list[str] = ()) -> DataFrame:
        """Key, target (as 1/0, when present), `keep` and the features as doubles."""
        if missing == "zero":
            filled = charges_or_zero(df)
        else:
            filled = impute(numeric_charges(df), self.donors, "TotalCharges", "tenure", "MonthlyCharges")
        made = filled.withColumns(engineered_columns())
        coded = made.withColumns({c: binary_code(F.col(c)) for c in BINARY_COLUMNS})
        kept = columns_kept(df, [KEY, TARGET, *keep])
        if TARGET in kept:
            coded = coded.withColumn(TARGET, binary_code(F.col(TARGET)))
        wide = one_hot(coded, self.levels)
        return wide.select(*kept, *[named(f).cast("double").alias(f) for f in self.features])

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(self.levels)
        spark.createDataFrame([(text,)], "levels string").write.mode("overwrite").parquet(f"{path}/levels")
        self.donors.save(f"{path}/donors")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeaturePipeline:
        levels = json.loads(spark.read.parquet(f"{path}/levels").head()["levels"])
        return cls(levels, Donors.load(spark, f"{path}/donors"))


def numeric_features(df: DataFrame) -> list[str]:
    return [c for c in columns_of(df, numeric=True) if c not in (KEY, TARGET)]


def with_new_records(reference: DataFrame, records: DataFrame) -> DataFrame:
    """Known rows and new records in one table; a record's missing fields are NULL."""
    return reference.unionByName(records, allowMissingColumns=True)
