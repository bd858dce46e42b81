"""Column expressions of the feature and scoring rules."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbline.fixed_values import (
    AUC_TIERS, BINARY_CODES, DEPLOY_ABOVE, HIGH_RISK_CONTRACT, HIGH_RISK_PAYMENT, LIFECYCLE_EDGES,
    LIFECYCLE_LABELS, PRECISION_TIERS, RECALL_TIERS, RISK_HIGH_ABOVE, RISK_MEDIUM_ABOVE,
    SERVICE_COLUMNS, TENURE_GROUP_EDGES, TENURE_GROUP_LABELS,
)

# Fixed value: texts read as numbers. `try_cast` alone would also take Java suffixes such as '1d'.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def named(column: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col("`" + column.replace("`", "``") + "`")


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    trimmed = F.btrim(text, F.lit(" \t\r\n"))
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def right_closed_bins(value: Column, edges: list, labels: list[str]) -> Column:
    """Label of the interval `(low, high]` that holds `value`; NULL outside all of them."""
    result = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges, edges[1:], labels))):
        result = F.when((value > low) & (value <= high), label).otherwise(result)
    return result


def tenure_group(tenure: Column) -> Column:
    return right_closed_bins(tenure, TENURE_GROUP_EDGES, TENURE_GROUP_LABELS)


def customer_lifecycle(tenure: Column) -> Column:
    return right_closed_bins(tenure, LIFECYCLE_EDGES, LIFECYCLE_LABELS)


def binary_code(value: Column) -> Column:
    """Two-valued text to 1/0; any other text is NULL."""
    ones = [k for k, v in BINARY_CODES.items() if v == 1]
    zeros = [k for k, v in BINARY_CODES.items() if v == 0]
    return F.when(value.isin(ones), 1).when(value.isin(zeros), 0)


def equals_flag(value: Column, expected: str) -> Column:
    return F.coalesce((value == expected).cast("int"), F.lit(0))


def total_services() -> Column:
    return reduce(add, [equals_flag(F.col(c), "Yes") for c in SERVICE_COLUMNS])


def engineered_columns() -> dict[str, Column]:
    """Derived columns; `TotalCharges` must already be a number."""
    services = total_services()
    tenure = F.col("tenure")
    return {
        "avg_monthly_charges": F.col("TotalCharges") / (tenure + 1),
        "charges_per_service": F.col("MonthlyCharges") / (services + 1),
        "total_services": services,
        "service_adoption_rate": services / F.lit(float(len(SERVICE_COLUMNS))),
        "high_risk_contract": equals_flag(F.col("Contract"), HIGH_RISK_CONTRACT),
        "high_risk_payment": equals_flag(F.col("PaymentMethod"), HIGH_RISK_PAYMENT),
        "tenure_group": tenure_group(tenure),
        "customer_lifecycle": customer_lifecycle(tenure),
    }


def risk_level(probability: Column) -> Column:
    return (
        F.when(probability > RISK_HIGH_ABOVE, "High")
        .when(probability > RISK_MEDIUM_ABOVE, "Medium")
        .when(probability.isNotNull(), "Low")
    )


def _tier(value: Column, bounds: tuple[float, float], names: tuple[str, str, str]) -> Column:
    return F.when(value > bounds[0], names[0]).when(value > bounds[1], names[1]).otherwise(names[2])


def precision_tier(value: Column) -> Column:
    return _tier(value, PRECISION_TIERS, ("High", "Moderate", "Lower"))


def recall_tier(value: Column) -> Column:
    return _tier(value, RECALL_TIERS, ("High", "Moderate", "Lower"))


def auc_tier(value: Column) -> Column:
    return _tier(value, AUC_TIERS, ("Excellent", "Good", "Needs enhancement"))


def deployable(auc: Column, precision: Column, recall: Column) -> Column:
    return (
        (auc > DEPLOY_ABOVE["roc_auc"])
        & (precision > DEPLOY_ABOVE["precision"])
        & (recall > DEPLOY_ABOVE["recall"])
    )
