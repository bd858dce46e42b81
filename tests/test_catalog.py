import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, compare
from ebbline.catalog import prepare_queries
from ebbline.plans import features as prep

# Cheap queries of every kind; `python check_oracle.py` compares all of them.
SAMPLE = [
    "churn_by_segment", "column_profile", "numeric_statistics", "churn_boxplot", "knn_impute", "one_hot",
    "stratified_split", "upsert_customers", "risk_writeback", "classification_metrics", "roc_curve", "knn_join",
]


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, db, sf_dir, name):
    verdict = compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
    assert verdict.endswith("ok"), verdict


def test_vote_report_prepares_the_rows_once(spark, sf_dir, monkeypatch):
    fitted = []
    fit = prep.FeaturePipeline.fit
    monkeypatch.setattr(prep.FeaturePipeline, "fit", lambda df: fitted.append(df) or fit(df))
    assert prepare_queries.feature_vote_report(spark, sf_dir).count() == 15
    assert len(fitted) == 1
