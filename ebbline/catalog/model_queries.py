"""Training, scoring and streaming queries. The prepared rows of one input are shared by all of them."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.catalog.oracle_base import over_base
from ebbline.catalog.registry import churn, register, staged_churn
from ebbline.catalog.table_queries import customers, instant, plain
from ebbline.fixed_values import KEY
from ebbline.operators.evaluate import classification_metrics
from ebbline.plans import analysis, deploy, registry, scoring, training
from ebbline.plans.models import BY_NAME, scored
from ebbline.sources.requests import parse_requests, to_requests
from ebbline.streaming.score import request_stream, stream_scores, stream_scores_and_alerts
from ebbline.streaming.upsert import merged, stream_changes
from ebbline.workspace import new_path, stage


@lru_cache(maxsize=4)
def _customers(app: str, sf_dir: str) -> DataFrame:
    return staged_churn(SparkSession.active(), sf_dir)


@lru_cache(maxsize=4)
def _prepared(app: str, sf_dir: str) -> training.TrainingSet:
    return training.prepare_training(_customers(app, sf_dir))


@lru_cache(maxsize=4)
def _compared(app: str, sf_dir: str) -> training.Comparison:
    return training.train_models(_prepared(app, sf_dir))


def customer_rows(spark, sf_dir) -> DataFrame:
    """The churn table that the models are trained on, derived once."""
    return _customers(spark.sparkContext.applicationId, sf_dir)


def prepared(spark, sf_dir) -> training.TrainingSet:
    return _prepared(spark.sparkContext.applicationId, sf_dir)


def compared(spark, sf_dir) -> training.Comparison:
    return _compared(spark.sparkContext.applicationId, sf_dir)


@lru_cache(maxsize=4)
def _bundle(app: str, sf_dir: str) -> registry.ModelBundle:
    data, results, spark = _prepared(app, sf_dir), _compared(app, sf_dir), SparkSession.active()
    best = results.best
    made = registry.ModelBundle(best, results.models[best], data.features, data.pipeline, data.scale)
    path = new_path(spark, "bundle")
    made.save(spark, path)
    return registry.ModelBundle.load(spark, path)


def bundle(spark, sf_dir) -> registry.ModelBundle:
    """The best model, saved and loaded again."""
    return _bundle(spark.sparkContext.applicationId, sf_dir)


@lru_cache(maxsize=4)
def _full_cv(data: training.TrainingSet) -> DataFrame:
    """The cross-validation of all full grids, made once for a training set."""
    return training.train_models(data, grid="full").cv


def _trained(spark, sf_dir, name: str) -> DataFrame:
    """Cross-validate the full grid of a model, refit its best point and test it; metrics and cross-validated ROC-AUC."""
    data, spec = prepared(spark, sf_dir), BY_NAME[name]
    rows, best = training.cross_validate(spec, data.train, "full")
    if best is None:
        raise RuntimeError(f"no grid point of {name} could be trained: {rows}")
    model = training.fit_on_all(spec, best, data.train)
    result = classification_metrics(stage(scored(model, data.test, name), "scores"))
    cv = max(r[3] for r in rows if r[3] is not None)
    return result.withColumns({"cv_roc_auc": F.lit(cv), "parameters": F.lit(str(best))})


for _key, _name in (
    ("model_logistic", "Logistic Regression"),
    ("model_tree", "Decision Tree"),
    ("model_forest", "Random Forest"),
    ("model_knn_churn", "K-Nearest Neighbors"),
    ("model_gbt", "Gradient Boosting"),
    ("model_extra_trees", "Extra Trees"),
):
    register(_key)(lambda spark, sf_dir, name=_name: _trained(spark, sf_dir, name))


def _searched(spark, sf_dir, names: list[str]) -> DataFrame:
    """Every point of the full grids of some models, cross-validated."""
    found = training.cross_validate_all([BY_NAME[n] for n in names], prepared(spark, sf_dir).train, "full")
    return spark.createDataFrame([row for rows, _ in found.values() for row in rows], training.CV_SCHEMA)


@register("cv_grid_shared_fits")
def cv_grid_shared_fits(spark, sf_dir):
    """The full grids whose points come from few fits: 108 points of logistic regression, neighbours and trees."""
    return _searched(spark, sf_dir, ["Logistic Regression", "K-Nearest Neighbors", "Decision Tree"])


@register("retrain_deploy")
def retrain_deploy(spark, sf_dir):
    """Deploy a tree, retrain with the best of all models as challenger, then offer the same one again: one row a step."""
    rows, root = customer_rows(spark, sf_dir), new_path(spark, "deployments")
    data, best = prepared(spark, sf_dir), bundle(spark, sf_dir)
    tree = compared(spark, sf_dir).models["Decision Tree"]
    first = registry.ModelBundle("Decision Tree", tree, data.features, data.pipeline, data.scale)
    steps = []
    for i, offered in enumerate((first, best, best)):
        found = deploy.retrain(rows, root, lambda _, offered=offered: (data, offered))
        steps.append(found.withColumn("step", F.lit(i + 1)))
    return reduce(DataFrame.unionByName, steps)


@register("model_gbt_variants")
def model_gbt_variants(spark, sf_dir):
    """The two further boosted presets; the second is only trained if the first one was."""
    first = _trained(spark, sf_dir, "XGBoost")
    data, spec = prepared(spark, sf_dir), BY_NAME["LightGBM"]
    point = spec.grid("short")[0]
    model = training.fit_on_all(spec, point, data.train)
    second = classification_metrics(stage(scored(model, data.test, spec.name), "scores"))
    missing = {"cv_roc_auc": F.lit(None).cast("double"), "parameters": F.lit(str(point))}
    return first.unionByName(second.withColumns(missing))


@register("cv_results")
def cv_results(spark, sf_dir):
    """Every point of every full grid, cross-validated."""
    return _full_cv(prepared(spark, sf_dir))


@register("model_comparison")
def model_comparison(spark, sf_dir):
    """Test metrics of all models, each with its short grid, and of the soft vote of the first three."""
    return compared(spark, sf_dir).metrics


@register("cv_results_full_grids")
def cv_results_full_grids(spark, sf_dir):
    """Every point of every full grid, cross-validated; `cv_results` has the same rows."""
    return _full_cv(prepared(spark, sf_dir))


@register("model_registry")
def model_registry(spark, sf_dir):
    """Save the best model's bundle, register all metrics, and read the table back."""
    bundle(spark, sf_dir)
    path = new_path(spark, "model_performance")
    registry.register(compared(spark, sf_dir).metrics, instant(), path)
    return plain(spark.read.parquet(path))


@register("executive_summary")
def executive_summary(spark, sf_dir):
    results, data = compared(spark, sf_dir), prepared(spark, sf_dir)
    return analysis.executive_summary(customer_rows(spark, sf_dir), results, len(data.features))


@register("run_analysis")
def run_analysis(spark, sf_dir):
    """The complete analysis with all models; every report with its number of rows."""
    trained = prepared(spark, sf_dir), compared(spark, sf_dir)
    done = analysis.run_analysis(churn(spark, sf_dir), new_path(spark, "analysis"), instant(), trained=trained)
    counts = [
        done.report(spark, name).agg(F.lit(name).alias("report"), F.count("*").alias("rows")) for name in done.reports
    ]
    return reduce(DataFrame.unionByName, counts)


@register("batch_scoring")
def batch_scoring(spark, sf_dir):
    """Score all active customers, append the predictions and write the risk back."""
    known = stage(customers(spark, sf_dir), "customers")
    path = new_path(spark, "predictions")
    _, updated = scoring.batch_scoring(known, bundle(spark, sf_dir), instant(), path)
    return plain(updated.select(KEY, "churn_risk_score", "risk_level", "last_scored"))


@register("score_requests")
def score_requests(spark, sf_dir):
    return scoring.score_requests(to_requests(churn(spark, sf_dir)), bundle(spark, sf_dir))


@register("score_requests_json")
def score_requests_json(spark, sf_dir):
    """Results as JSON text, under the simple rule for missing charges."""
    results = scoring.score_requests(to_requests(churn(spark, sf_dir)), bundle(spark, sf_dir), missing="zero")
    return scoring.as_json(results)


def _request_files(spark, sf_dir) -> str:
    path = new_path(spark, "requests")
    to_requests(churn(spark, sf_dir)).write.text(path)
    return path


@register("stream_scoring")
def stream_scoring(spark, sf_dir):
    out = new_path(spark, "stream-scores")
    query = stream_scores(
        request_stream(spark, _request_files(spark, sf_dir)), bundle(spark, sf_dir), out, new_path(spark, "progress")
    )
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@register("stream_alerts")
def stream_alerts(spark, sf_dir):
    """Scores and alerts of a stream; every scored request with whether it raised an alert."""
    out, raised = new_path(spark, "stream-scores"), new_path(spark, "stream-alerts")
    query = stream_scores_and_alerts(
        request_stream(spark, _request_files(spark, sf_dir)), bundle(spark, sf_dir), out, raised, new_path(spark, "progress")
    )
    query.awaitTermination()
    alerted = spark.read.parquet(raised).select("customer_id", F.lit(True).alias("alert"))
    return spark.read.parquet(out).drop("batch_id").join(alerted, "customer_id", "left").fillna(False, ["alert"])


@register("stream_upsert", over_base(
    'SELECT "customerID", "Contract", "PaymentMethod", "MonthlyCharges", true AS active FROM base'))
def stream_upsert(spark, sf_dir):
    """Every request is upserted as it arrives, in three versions of which the last counts; the table with the
    changes merged in."""
    known = stage(customers(spark, sf_dir).drop("Contract").withColumn("Contract", F.lit("unknown")), "customers")
    values = request_stream(spark, _request_files(spark, sf_dir))
    requests = parse_requests(values).where("problem IS NULL").select(KEY, "Contract", "PaymentMethod")
    records = requests.withColumn("sequence", F.explode(F.array(*[F.lit(i) for i in (2, 3, 1)]))).withColumn(
        "Contract", F.when(F.col("sequence") == 3, F.col("Contract")).otherwise(F.lit("outdated"))
    )
    log = new_path(spark, "changes")
    stream_changes(records, "sequence", log, new_path(spark, "progress")).awaitTermination()
    table = merged(known, spark.read.parquet(log), "sequence", defaults={"active": F.lit(True)})
    return plain(table.select(KEY, "Contract", "PaymentMethod", "MonthlyCharges", "active"))
