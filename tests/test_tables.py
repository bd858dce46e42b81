import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbline.fixed_values import KEY
from ebbline.operators import keyed
from ebbline.sources import requests, tables
from ebbline.sources.base_view import load_churn_table
from ebbline.workspace import new_path

AT = dt.datetime(2000, 8, 1)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("1", "a", 10, True), ("2", "b", 20, False)], f"{KEY} string, plan string, tenure int, active boolean")


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_partial_upsert_keeps_other_columns(spark, table):
    batch = spark.createDataFrame([("1", "z"), ("3", "n"), (None, "x")], f"{KEY} string, plan string")
    out = keyed.upsert(table, batch, defaults={"active": F.lit(True)})
    assert rows(out) == {("1", "z", 10, True), ("2", "b", 20, False), ("3", "n", None, True)}


def test_supplied_null_overwrites(spark, table):
    batch = spark.createDataFrame([("1", None)], f"{KEY} string, plan string")
    assert ("1", None, 10, True) in rows(keyed.upsert(table, batch))


def test_upsert_twice_is_once(spark, table):
    batch = spark.createDataFrame([("1", "z"), ("3", "n")], f"{KEY} string, plan string")
    once = keyed.upsert(table, batch)
    assert rows(keyed.upsert(once, batch)) == rows(once)


def test_last_record_of_a_key_wins(spark, table):
    batch = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)] * 50, f"{KEY} string, plan string, at int")
    last = keyed.last_per_key(batch, KEY, [F.col("at")]).drop("at")
    assert last.count() == 1 and ("1", "new", 10, True) in rows(keyed.upsert(table, last))


def test_last_per_key_limits_before_the_shuffle(spark):
    batch = spark.range(100).select((F.col("id") % 3).alias(KEY), F.col("id").alias("at"))
    plan = keyed.last_per_key(batch, KEY, [F.col("at")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_insert_missing_leaves_known_rows(spark, table):
    batch = spark.createDataFrame([("1", "z"), ("3", "n")], f"{KEY} string, plan string")
    out = keyed.insert_missing(table, batch, defaults={"active": F.lit(True)})
    assert rows(out) == {("1", "a", 10, True), ("2", "b", 20, False), ("3", "n", None, True)}


def test_report(spark, table):
    batch = spark.createDataFrame([("1",), ("3",), (None,)], f"{KEY} string")
    found = {r["customer_id"]: (r["success"], r["action"]) for r in keyed.upsert_report(table, batch).collect()}
    assert found == {"1": (True, "updated"), "3": (True, "inserted"), None: (False, "none")}


def test_unknown_customers_get_stubs(spark, sf_dir):
    known = tables.customers_from(load_churn_table(spark, sf_dir).limit(3), F.lit(AT))
    results = spark.createDataFrame([("new", 1), ("new", 0)], f"{KEY} string, churn_prediction int")
    saved, stubs = keyed.predictions_to_append(results, known, F.lit(AT))
    assert saved.columns == ["customerid", "churn_prediction"]
    stub = stubs.collect()
    assert [(r[KEY], r["active"], r["created_at"], r["gender"]) for r in stub] == [("new", True, AT, None)]


def test_risk_writeback_uses_the_latest(spark, sf_dir):
    known = tables.customers_from(load_churn_table(spark, sf_dir), F.lit(AT))
    one = known.orderBy(KEY).head()[KEY]
    later = dt.datetime(2000, 9, 1)
    predictions = spark.createDataFrame(
        [(one, 0.2, "Low", AT), (one, 0.9, "High", later)],
        "customerid string, churn_probability double, risk_level string, prediction_date timestamp")
    out = keyed.risk_writeback(known, predictions, F.lit(later))
    assert out.count() == known.count()
    hit = out.where(F.col(KEY) == one).head()
    assert (float(hit["churn_risk_score"]), hit["risk_level"], hit["last_scored"]) == (0.9, "High", later)
    assert out.where("risk_level IS NOT NULL").count() == 1


def test_reload_empties_predictions(spark, sf_dir):
    root = new_path(spark, "reload")
    known = tables.customers_from(load_churn_table(spark, sf_dir), F.lit(AT))
    loaded, predictions = tables.reload_customers(known, root)
    assert loaded.count() == known.count() and predictions.count() == 0


def test_csv_round_trip(spark, sf_dir):
    df = load_churn_table(spark, sf_dir)
    path = new_path(spark, "csv")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path)
    assert back.schema == df.schema or back.dtypes == df.dtypes
    assert rows(back) == rows(df)


def test_active_filter_reaches_the_scan(spark, sf_dir):
    path = new_path(spark, "customers")
    tables.customers_from(load_churn_table(spark, sf_dir), F.lit(AT)).write.parquet(path)
    plan = tables.active_customers(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(active,true)" in plan and "updated_at" not in plan


def test_malformed_requests(spark):
    values = spark.createDataFrame([("{not json",), ('{"customerID": "9", "tenure": "soon"}',), ('{"tenure": 3}',)], "value string")
    found = [r["problem"] for r in requests.parse_requests(values).collect()]
    assert found[0] == "malformed JSON" and found[1] == "malformed JSON"
    assert found[2] == "missing field gender"
