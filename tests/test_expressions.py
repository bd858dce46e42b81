import pytest
from pyspark.sql import functions as F

from ebbline.functions import expressions as e


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_to_number(spark):
    texts = [" ", "+1.5", "1d", "abc", "1e3", ".5", "7.", None, " 12 ", "-3"]
    assert column(spark, texts, "string", e.to_number) == [None, 1.5, None, None, 1000.0, 0.5, 7.0, None, 12.0, -3.0]


def test_tenure_group_edges(spark):
    got = column(spark, [0, 1, 12, 13, 72, 73, None], "int", e.tenure_group)
    assert got == [None, "0-1yr", "0-1yr", "1-2yr", "4+yr", None, None]


def test_lifecycle_edges(spark):
    assert column(spark, [0, 6, 7, 72, 73], "int", e.customer_lifecycle) == [None, "New", "Growing", "Loyal", None]


def test_risk_edges(spark):
    got = column(spark, [0.0, 0.3, 0.30001, 0.7, 0.70001, 1.0, None], "double", e.risk_level)
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", None]


def test_binary_code(spark):
    assert column(spark, ["Yes", "No", "Male", "Female", "Maybe", None], "string", e.binary_code) == [1, 0, 1, 0, None, None]


def test_flag_of_null_is_zero(spark):
    assert column(spark, ["a", "b", None], "string", lambda c: e.equals_flag(c, "a")) == [1, 0, 0]


@pytest.mark.parametrize("value,tier", [(0.81, "High"), (0.8, "Moderate"), (0.61, "Moderate"), (0.6, "Lower")])
def test_precision_tier(spark, value, tier):
    assert column(spark, [value], "double", e.precision_tier) == [tier]


def test_deployable(spark):
    df = spark.createDataFrame([(0.81, 0.71, 0.61), (0.8, 0.9, 0.9)], "a double, p double, r double")
    assert [r[0] for r in df.select(e.deployable(F.col("a"), F.col("p"), F.col("r"))).collect()] == [True, False]
