"""Sources, sinks and keyed upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbline.catalog.oracle_base import over_base
from ebbline.catalog.registry import churn, register, staged_churn, table
from ebbline.fixed_values import KEY, TARGET
from ebbline.functions.expressions import named, risk_level
from ebbline.operators import keyed
from ebbline.schemas import ATTRIBUTE_NAMES
from ebbline.sources import requests, tables
from ebbline.workspace import new_path, stage

AT = "2000-08-01 00:00:00"
LATER = "2000-09-01 00:00:00"


def instant(text: str = AT):
    return F.lit(text).cast("timestamp")


def moment(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def plain(df):
    """Decimals as doubles and times as text, for comparison."""
    shown = {"decimal": lambda c: named(c).cast("double").alias(c), "timestamp": moment}
    return df.select(*[
        shown.get(t.split("(")[0], named)(c) for c, t in df.dtypes
    ])


def customers(spark, sf_dir):
    return tables.customers_from(churn(spark, sf_dir), instant())


def predictions(spark, sf_dir):
    """Two predictions for every customer of the star schema, also those the churn table lacks."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("customerid"))
    runs = F.explode(F.array(F.lit("first"), F.lit("second")))
    rows = keys.withColumn("model_used", runs)
    points = F.expr("cast(conv(substr(md5(concat(customerid, ':', model_used)), 1, 8), 16, 10) as bigint) % 10000")
    p = (points / F.lit(10000.0)).alias("churn_probability")
    scored = rows.select("customerid", "model_used", p)
    return scored.select(
        "customerid",
        (F.col("churn_probability") > 0.5).cast("int").alias("churn_prediction"),
        F.col("churn_probability").cast("decimal(5,4)").alias("churn_probability"),
        risk_level(F.col("churn_probability")).alias("risk_level"),
        "model_used",
        F.when(F.col("model_used") == "first", instant()).otherwise(instant(LATER)).alias("prediction_date"),
    )


_PREDICTIONS = f"""scored AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerid, model_used,
    ('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || ':' || model_used), 1, 8))::BIGINT % 10000 / 10000.0::DOUBLE AS p
  FROM customer, (VALUES ('first'), ('second')) AS runs(model_used)
), predictions AS (
  SELECT customerid, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS churn_prediction, p AS churn_probability,
    CASE WHEN p > 0.7 THEN 'High' WHEN p > 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level, model_used,
    CASE WHEN model_used = 'first' THEN '{AT}' ELSE '{LATER}' END AS prediction_date FROM scored)"""
_ATTRIBUTES = ", ".join(f'"{c}"' for c in ATTRIBUTE_NAMES)


def _customer_sql(**changed: str) -> str:
    """Select list of the customers table over `base`, with some columns replaced."""
    values = {KEY: f'"{KEY}"', **{c: f'"{c}"' for c in ATTRIBUTE_NAMES}, TARGET: f'"{TARGET}"', "active": "true",
              "churn_risk_score": "NULL::DOUBLE", "risk_level": "NULL::VARCHAR", "last_scored": "NULL::VARCHAR",
              "created_at": f"'{AT}'", "updated_at": f"'{AT}'"}
    return ", ".join(f'{v} AS "{c}"' for c, v in (values | changed).items())


@register("scan_csv", over_base('SELECT * REPLACE (trim("TotalCharges") AS "TotalCharges") FROM base'))
def scan_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    tables.write_csv(churn(spark, sf_dir), path)
    return tables.read_csv(spark, path).withColumn("TotalCharges", F.trim("TotalCharges"))


@register("scan_active_customers", over_base(f'SELECT "customerID", {_ATTRIBUTES} FROM base'))
def scan_active_customers(spark, sf_dir):
    path = new_path(spark, "customers")
    customers(spark, sf_dir).write.parquet(path)
    return plain(tables.active_customers(spark.read.parquet(path)))


@register("parse_requests", over_base(f'SELECT "customerID", {_ATTRIBUTES}, NULL::VARCHAR AS problem FROM base'))
def parse_requests(spark, sf_dir):
    return requests.parse_requests(requests.to_requests(churn(spark, sf_dir)))


_LISTED = ", ".join(
    f"('{name}', {i}, '{f.name}', '{f.dataType.simpleString()}')"
    for name, schema in tables.TABLES.items() for i, f in enumerate(schema.fields)
)


@register("table_schemas", over_base(f"""
SELECT "table", CAST(position AS INTEGER) AS position, "column", type, CAST(CASE "table"
    WHEN 'customers' THEN (SELECT count(*) FROM base) WHEN 'churn_predictions' THEN (SELECT count(*) FROM predictions)
    ELSE 0 END AS BIGINT) AS rows
FROM (VALUES {_LISTED}) AS listed("table", position, "column", type)""", _PREDICTIONS))
def table_schemas(spark, sf_dir):
    """Create the three tables, load two of them, and list their columns and row counts."""
    root = new_path(spark, "tables")
    names = tables.create_tables(spark, root, "t_" + root.rsplit("-", 1)[1] + "_")
    customers(spark, sf_dir).write.insertInto(names["customers"])
    predictions(spark, sf_dir).write.insertInto(names["churn_predictions"])
    rows = []
    for name, full in names.items():
        rows += [(name, i, c, t) for i, (c, t) in enumerate(spark.table(full).dtypes)]
    listed = spark.createDataFrame(rows, "table string, position int, column string, type string")
    counted = None
    for name, full in names.items():
        one = spark.table(full).agg(F.count("*").alias("rows")).withColumn("table", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    return listed.join(counted, "table")


@register("existing_customers", over_base("""
SELECT DISTINCT customerid AS "customerID" FROM predictions
WHERE customerid IN (SELECT "customerID" FROM base)""", _PREDICTIONS))
def existing_customers(spark, sf_dir):
    keys = predictions(spark, sf_dir).withColumnRenamed("customerid", KEY)
    return keyed.existing_keys(keys, customers(spark, sf_dir))


@register("missing_customers", over_base("""
SELECT DISTINCT customerid AS "customerID" FROM predictions
WHERE customerid NOT IN (SELECT "customerID" FROM base)""", _PREDICTIONS))
def missing_customers(spark, sf_dir):
    keys = predictions(spark, sf_dir).withColumnRenamed("customerid", KEY)
    return keyed.missing_keys(keys, customers(spark, sf_dir))


@register("orphan_predictions", over_base("""
SELECT * FROM predictions WHERE customerid NOT IN (SELECT "customerID" FROM base)""", _PREDICTIONS))
def orphan_predictions(spark, sf_dir):
    return plain(keyed.orphans(predictions(spark, sf_dir), customers(spark, sf_dir), "customerid"))


@register("append_predictions", over_base("""
SELECT 'prediction' AS kind, customerid, model_used, churn_probability FROM predictions
UNION ALL SELECT 'customer', "customerID", NULL, NULL FROM base
UNION ALL SELECT DISTINCT 'customer', customerid, NULL, NULL FROM predictions
WHERE customerid NOT IN (SELECT "customerID" FROM base)""", _PREDICTIONS))
def append_predictions(spark, sf_dir):
    """The prediction table after an append of two runs, and all customers with the stubs it needs."""
    known = stage(customers(spark, sf_dir), "customers")
    path = new_path(spark, "predictions")
    for run in ("first", "second"):
        results = predictions(spark, sf_dir).where(F.col("model_used") == run)
        rows, stubs = keyed.predictions_to_append(results.withColumnRenamed("customerid", KEY), known, instant())
        rows.write.mode("append").parquet(path)
        known = known.unionByName(stubs)
    saved = spark.read.parquet(path)
    text = F.lit(None).cast("string")
    return saved.select(
        F.lit("prediction").alias("kind"), "customerid", "model_used", F.col("churn_probability").cast("double").alias("churn_probability")
    ).unionByName(known.select(
        F.lit("customer").alias("kind"), F.col(KEY).alias("customerid"), text.alias("model_used"),
        F.lit(None).cast("double").alias("churn_probability"),
    ))


@register("reload_customers", over_base(
    'SELECT count(*) AS customers, min("customerID") AS first_customer, 0::BIGINT AS predictions_left FROM base'))
def reload_customers(spark, sf_dir):
    root = new_path(spark, "reload")
    predictions(spark, sf_dir).write.parquet(f"{root}/churn_predictions")
    loaded, left = tables.reload_customers(customers(spark, sf_dir), root)
    counts = loaded.agg(F.count("*").alias("customers"), F.min(KEY).alias("first_customer"))
    return counts.withColumn("predictions_left", left.agg(F.count("*")).scalar())


def _billing_batch(spark, sf_dir):
    """A partial record for every customer of the star schema."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias(KEY),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Mailed check").otherwise("Bank transfer").alias("PaymentMethod"),
        F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No").alias("PaperlessBilling"),
    )


_BILLING = """batch AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Mailed check' ELSE 'Bank transfer' END AS payment,
    CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS paperless FROM customer)"""


@register("upsert_customers", over_base("SELECT " + _customer_sql(
    customerID='coalesce("customerID", id)', PaymentMethod="payment", PaperlessBilling="paperless",
    created_at=f"CASE WHEN \"customerID\" IS NULL THEN '{LATER}' ELSE '{AT}' END", updated_at=f"'{LATER}'")
    + ' FROM base FULL JOIN batch ON id = "customerID"', _BILLING))
def upsert_customers(spark, sf_dir):
    at = instant(LATER)
    return plain(keyed.upsert(
        customers(spark, sf_dir), _billing_batch(spark, sf_dir),
        defaults={"active": F.lit(True), "created_at": at, "updated_at": at}, touched={"updated_at": at},
    ))


@register("upsert_batch_last_wins", over_base("""
SELECT coalesce("customerID", id) AS "customerID", CASE WHEN id IS NULL THEN "Contract" ELSE contract_ END AS "Contract",
  CASE WHEN id IS NULL THEN "MonthlyCharges" ELSE charge END AS "MonthlyCharges", tenure, true AS active
FROM base FULL JOIN latest ON id = "customerID\"""", """latest AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderpriority AS contract_, CAST(o_totalprice AS DECIMAL(10,2))::DOUBLE AS charge
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) AS o
  WHERE rn = 1)"""))
def upsert_batch_last_wins(spark, sf_dir):
    """Every order is a change record of its customer; the last one of each customer counts."""
    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias(KEY), F.col("o_orderpriority").alias("Contract"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("MonthlyCharges"), "o_orderdate", "o_orderkey",
    )
    last = keyed.last_per_key(changes, KEY, [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate", "o_orderkey")
    merged = keyed.upsert(customers(spark, sf_dir), last, defaults={"active": F.lit(True)})
    return plain(merged.select(KEY, "Contract", "MonthlyCharges", "tenure", "active"))


@register("insert_missing_customers", over_base("SELECT " + _customer_sql() + " FROM base UNION ALL BY NAME SELECT " + """
  id AS "customerID", payment AS "PaymentMethod", paperless AS "PaperlessBilling", true AS active,
  '""" + LATER + """' AS created_at FROM batch WHERE id NOT IN (SELECT "customerID" FROM base)""", _BILLING))
def insert_missing_customers(spark, sf_dir):
    return plain(keyed.insert_missing(
        customers(spark, sf_dir), _billing_batch(spark, sf_dir),
        defaults={"active": F.lit(True), "created_at": instant(LATER)},
    ))


@register("upsert_action_report", over_base("""
SELECT id AS customer_id, id IS NOT NULL AS success,
  CASE WHEN id IS NULL THEN 'none' WHEN "customerID" IS NULL THEN 'inserted' ELSE 'updated' END AS action,
  CASE WHEN id IS NULL THEN 'no key'
       WHEN "customerID" IS NULL THEN 'key ' || id || ': inserted'
       ELSE 'key ' || id || ': updated' END AS message
FROM (SELECT CASE WHEN c_acctbal >= -900 THEN CAST(c_custkey AS VARCHAR) END AS id FROM customer) AS batch
LEFT JOIN base ON "customerID" = id"""))
def upsert_action_report(spark, sf_dir):
    """Records of customers deep in debt arrive without their key and are rejected."""
    batch = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= -900, F.col("c_custkey").cast("string")).alias(KEY)
    )
    return keyed.upsert_report(customers(spark, sf_dir), batch)


@register("risk_writeback", over_base("SELECT " + _customer_sql(
    churn_risk_score="churn_probability", risk_level="risk_level",
    last_scored=f"CASE WHEN customerid IS NULL THEN NULL ELSE '{LATER}' END",
    updated_at=f"CASE WHEN customerid IS NULL THEN '{AT}' ELSE '{LATER}' END")
    .replace('"customerID" AS', 'base."customerID" AS')
    + " FROM base LEFT JOIN (SELECT customerid AS pid, * FROM predictions WHERE model_used = 'second') AS p"
      ' ON pid = base."customerID"', _PREDICTIONS).replace("CASE WHEN customerid IS NULL", "CASE WHEN pid IS NULL"))
def risk_writeback(spark, sf_dir):
    return plain(keyed.risk_writeback(customers(spark, sf_dir), predictions(spark, sf_dir), instant(LATER)))
