"""The churn table derived from the star schema: one row per customer as of a snapshot date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.fixed_values import KEY, SERVICE_COLUMNS, TARGET
from ebbline.schemas import CHURN_TABLE

SNAPSHOT = "2000-08-01 00:00:00"
WINDOW_START = "1999-08-01 00:00:00"
# Part types that stand in for the six services, in the order of SERVICE_COLUMNS.
SERVICE_PART_TYPES = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL", "LARGE"]
PAYMENT_BY_SEGMENT = {
    "AUTOMOBILE": "Electronic check", "BUILDING": "Mailed check", "FURNITURE": "Bank transfer",
}


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def _months(column: str) -> Column:
    return F.year(column) * 12 + F.month(column)


_URGENT, _LOW, _USUAL = 1, 5, 3


def _order_mark() -> Column:
    """Time, number and urgency of an order in one number, whose maximum is the last order and says its urgency.

    A maximum over a struct or with a text beside it would turn the hash aggregation into a sort of all orders.
    """
    urgency = (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), _URGENT)
        .when(F.col("o_orderpriority") == "5-LOW", _LOW)
        .otherwise(_USUAL)
    )
    time = F.unix_micros(F.col("o_orderdate").cast("timestamp")).cast("decimal(16,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")
    return time + (F.col("o_orderkey").cast("decimal(20,0)") * 10 + urgency)


def order_history(orders: DataFrame) -> DataFrame:
    """Per customer: order totals before the snapshot, in the window, and whether any came later.

    One aggregation with map-side partials, so a customer with most of the orders is no hot task.
    """
    before = F.col("o_orderdate") < _instant(SNAPSHOT)
    recent = before & (F.col("o_orderdate") >= _instant(WINDOW_START))
    money = F.col("o_totalprice").cast("decimal(18,2)")
    past_date = F.when(before, F.col("o_orderdate"))
    return orders.groupBy("o_custkey").agg(
        F.min(past_date).alias("first_order"),
        F.max(past_date).alias("last_order"),
        F.sum(F.when(before, money)).alias("total"),
        F.sum(F.when(recent, money)).alias("recent_total"),
        F.count_if(recent).alias("recent_orders"),
        F.max(F.when(before, _order_mark())).alias("last_mark"),
        F.max((~before).cast("int")).alias("ordered_later"),
    ).where(F.col("first_order").isNotNull())


def recent_purchases(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Per customer: part types bought and returns made in the window.

    Both joins are followed by an exchange on another key, so adaptive execution may split a hot
    order or part; the final aggregation combines map-side.
    """
    recent = orders.where(
        (F.col("o_orderdate") >= _instant(WINDOW_START)) & (F.col("o_orderdate") < _instant(SNAPSHOT))
    ).select("o_orderkey", "o_custkey")
    lines = lineitem.select("l_orderkey", "l_partkey", "l_returnflag").join(
        recent, F.col("l_orderkey") == F.col("o_orderkey")
    )
    typed = lines.join(
        part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left"
    )
    bought = [
        F.max((F.col("p_type") == kind).cast("int")).alias(f"bought_{kind}") for kind in SERVICE_PART_TYPES
    ]
    return typed.groupBy(F.col("o_custkey").alias("buyer")).agg(
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"), *bought
    )


def churn_table(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, part: DataFrame,
    nation: DataFrame, events: DataFrame,
) -> DataFrame:
    """Customers with an order before the snapshot, with the churn attributes and target."""
    users = events.select(F.col("user_id").alias("active_user")).distinct()
    joined = (
        customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(order_history(orders), F.col("c_custkey") == F.col("o_custkey"))
        .join(recent_purchases(orders, lineitem, part), F.col("c_custkey") == F.col("buyer"), "left")
        .join(users, F.col("c_custkey") == F.col("active_user"), "left")
        .join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumn("months", _months("last_order") - _months("first_order"))
        .withColumn("cents", (F.col("total") * 100).cast("long"))
    )
    key = F.col("c_custkey")
    no_phone = F.coalesce(F.col("n_regionkey") == 0, F.lit(False))
    idle = F.col("recent_orders") == 0
    urgency = F.expr("cast(last_mark % 10 as int)")
    columns = {
        KEY: key.cast("string"),
        "gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
        "SeniorCitizen": (F.col("c_acctbal") < 0).cast("int"),
        "Partner": _yes_no(key % 3 == 0),
        "Dependents": _yes_no(F.coalesce(F.col("returned"), F.lit(0)) == 1),
        "tenure": F.col("months"),
        "PhoneService": _yes_no(~no_phone),
        "MultipleLines": F.when(no_phone, "No phone service").otherwise(_yes_no(F.col("recent_orders") > 1)),
        "InternetService": F.when(idle, "No")
        .when(F.col("recent_total") > F.col("recent_orders") * 250000, "Fiber optic")
        .otherwise("DSL"),
        "Contract": F.when(urgency == _URGENT, "Month-to-month").when(urgency == _LOW, "Two year").otherwise("One year"),
        "PaperlessBilling": _yes_no(F.col("active_user").isNotNull()),
        "PaymentMethod": F.coalesce(
            *[F.when(F.col("c_mktsegment") == s, m) for s, m in PAYMENT_BY_SEGMENT.items()],
            F.lit("Credit card"),
        ),
        "MonthlyCharges": F.expr("cents div (months + 1)") / F.lit(100.0),
        "TotalCharges": F.when((F.col("months") == 0) | (key % 50 == 7), " ").otherwise(
            F.col("total").cast("string")
        ),
        TARGET: _yes_no(F.col("ordered_later") == 0),
    }
    for service, kind in zip(SERVICE_COLUMNS, SERVICE_PART_TYPES):
        bought = F.coalesce(F.col(f"bought_{kind}"), F.lit(0)) == 1
        columns[service] = F.when(idle, "No internet service").otherwise(_yes_no(bought))
    return joined.select(*[columns[f.name].alias(f.name) for f in CHURN_TABLE.fields])


def load_churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "orders", "lineitem", "part", "nation", "events"]
    return churn_table(*[spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names])
