"""Fitted per-column constants: medians for filling, median and IQR for scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import named
from ebbline.operators.quantiles import QUARTILES, quantiles, value_counts


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians; one number per column comes to the driver."""
    rows = quantiles(value_counts(df, columns), {"median": 0.5}).collect()
    return {r["column"]: r["median"] for r in rows}


def median_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values of numeric columns replaced by the column's median."""
    medians = fit_medians(df, columns)
    return df.withColumns(
        {c: F.coalesce(named(c).cast("double"), F.lit(medians.get(c))) for c in columns}
    )


@dataclass(frozen=True)
class RobustScale:
    """(x - median) / IQR per column; a zero IQR divides by 1."""

    centre: dict[str, float]
    spread: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> RobustScale:
        rows = quantiles(value_counts(df, columns), QUARTILES).collect()  # one row per column
        found = {r["column"]: r for r in rows}
        centre = {c: found[c]["median"] if c in found else 0.0 for c in columns}
        spread = {c: (found[c]["q3"] - found[c]["q1"]) or 1.0 if c in found else 1.0 for c in columns}
        return cls(centre, spread)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (named(c).cast("double") - self.centre[c]) / self.spread[c] for c in self.centre}
        )
