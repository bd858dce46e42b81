"""Metrics, curves, monitoring and the rules on scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.catalog.oracle_base import over_base
from ebbline.catalog.registry import churn, r6_sql, register, rounded, staged_churn, table
from ebbline.catalog.table_queries import instant, plain
from ebbline.fixed_values import HIGH_RISK_CONTRACT, HIGH_RISK_PAYMENT, KEY, RISK_ACTIONS, TARGET
from ebbline.functions import expressions as e
from ebbline.operators import evaluate, knn, monitor, split
from ebbline.plans import registry, scoring
from ebbline.schemas import REQUEST
from ebbline.workspace import stage

MODELS = ["alpha", "beta", "gamma"]


def scores(spark, sf_dir):
    """Three scorecards over the churn table: points for contract and payment, plus a hash of the key."""
    base = churn(spark, sf_dir).select(KEY, TARGET, "Contract", "PaymentMethod")
    models = base.withColumn("model", F.explode(F.array(*[F.lit(m) for m in MODELS])))
    points = (
        F.expr("cast(conv(substr(md5(concat(customerID, ':', model)), 1, 8), 16, 10) as bigint) % 6000")
        + F.when(F.col("Contract") == HIGH_RISK_CONTRACT, 2000).otherwise(0)
        + F.when(F.col("PaymentMethod") == HIGH_RISK_PAYMENT, 1500).otherwise(0)
    )
    return models.withColumn("probability", points / F.lit(10000.0)).select(
        "model", F.col(KEY).alias("key"), (F.col(TARGET) == "Yes").cast("int").alias("label"), "probability",
        (F.col("probability") > 0.5).cast("int").alias("prediction"),
    )


_SCORES = """scores AS (
  SELECT model, id AS key, label, p AS probability, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction FROM (
    SELECT model, "customerID" AS id, CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END AS label,
      (('0x' || substr(md5("customerID" || ':' || model), 1, 8))::BIGINT % 6000
        + CASE WHEN "Contract" = 'Month-to-month' THEN 2000 ELSE 0 END
        + CASE WHEN "PaymentMethod" = 'Electronic check' THEN 1500 ELSE 0 END) / 10000.0::DOUBLE AS p
    FROM base, (VALUES ('alpha'), ('beta'), ('gamma')) AS m(model)) AS raw)"""
_POINTS = """points AS (
  SELECT model, probability, n0, n1, sum(n1) OVER down AS tp, sum(n0) OVER down AS fp,
    sum(n1) OVER (PARTITION BY model) AS positives, sum(n0) OVER (PARTITION BY model) AS negatives
  FROM (SELECT model, probability, sum(1 - label) AS n0, sum(label) AS n1 FROM scores GROUP BY 1, 2) AS g
  WINDOW down AS (PARTITION BY model ORDER BY probability DESC))"""
_CELLS = """counted AS (
  SELECT model, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn
  FROM scores GROUP BY 1)"""


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN 0.0::DOUBLE ELSE ({top})::DOUBLE / ({bottom})::DOUBLE END"


_METRICS = f"""metrics AS (
  SELECT counted.model, (tp + tn) / (tp + fp + fn + tn) AS accuracy, {_ratio('tp', '(tp + fp)')} AS precision,
    {_ratio('tp', '(tp + fn)')} AS recall, {_ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1, roc_auc, avg_precision
  FROM counted JOIN (
    SELECT model, sum(n1::DOUBLE * ((negatives - fp) + n0 / 2.0)) / (max(positives)::DOUBLE * max(negatives)::DOUBLE) AS roc_auc,
      sum(n1::DOUBLE * tp / (tp + fp)) / max(positives) AS avg_precision FROM points GROUP BY 1) AS r
  ON r.model = counted.model)"""
_TO_METRICS = (_SCORES, _POINTS, _CELLS, _METRICS)
_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc", "avg_precision"]


def metrics(spark, sf_dir) -> DataFrame:
    return evaluate.classification_metrics(scores(spark, sf_dir))


@register("classification_metrics", over_base(
    f"SELECT model, accuracy, precision, recall, f1, {r6_sql('roc_auc')} AS roc_auc, {r6_sql('avg_precision')} AS avg_precision FROM metrics",
    *_TO_METRICS))
def classification_metrics(spark, sf_dir):
    return rounded(metrics(spark, sf_dir), ["roc_auc", "avg_precision"])


@register("per_class_metrics", over_base(f"""
SELECT model, 'Churn' AS "class", {_ratio('tp', '(tp + fp)')} AS precision, {_ratio('tp', '(tp + fn)')} AS recall FROM counted
UNION ALL SELECT model, 'No Churn', {_ratio('tn', '(tn + fn)')}, {_ratio('tn', '(tn + fp)')} FROM counted""", _SCORES, _CELLS))
def per_class_metrics(spark, sf_dir):
    return evaluate.per_class_metrics(scores(spark, sf_dir))


@register("best_model", over_base(f"""
SELECT model, {r6_sql('roc_auc')} AS roc_auc FROM metrics ORDER BY roc_auc DESC, model LIMIT 1""", *_TO_METRICS))
def best_model(spark, sf_dir):
    return rounded(evaluate.best_model(metrics(spark, sf_dir)).select("model", "roc_auc"), ["roc_auc"])


@register("roc_curve", over_base(f"""
SELECT model, probability AS threshold, {_ratio('fp', 'negatives')} AS fpr, {_ratio('tp', 'positives')} AS tpr FROM points
UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM scores""", _SCORES, _POINTS))
def roc_curve(spark, sf_dir):
    return evaluate.roc_curve(scores(spark, sf_dir))


@register("pr_curve", over_base(f"""
SELECT model, probability AS threshold, tp::DOUBLE / (tp + fp)::DOUBLE AS precision, {_ratio('tp', 'positives')} AS recall FROM points
UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM scores""", _SCORES, _POINTS))
def pr_curve(spark, sf_dir):
    return evaluate.pr_curve(scores(spark, sf_dir))


@register("confusion_matrix", over_base(" UNION ALL ".join(
    f"SELECT model, {a} AS actual, {p} AS predicted, {c} AS n FROM counted"
    for a, p, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]), _SCORES, _CELLS))
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scores(spark, sf_dir))


@register("model_tiers", over_base("""
SELECT model, CASE WHEN precision > 0.8 THEN 'High' WHEN precision > 0.6 THEN 'Moderate' ELSE 'Lower' END AS precision_tier,
  CASE WHEN recall > 0.7 THEN 'High' WHEN recall > 0.5 THEN 'Moderate' ELSE 'Lower' END AS recall_tier,
  CASE WHEN roc_auc > 0.85 THEN 'Excellent' WHEN roc_auc > 0.7 THEN 'Good' ELSE 'Needs enhancement' END AS auc_tier,
  roc_auc > 0.8 AND precision > 0.7 AND recall > 0.6 AS deploy FROM metrics""", *_TO_METRICS))
def model_tiers(spark, sf_dir):
    return evaluate.model_tiers(metrics(spark, sf_dir))


@register("soft_vote", over_base("""
SELECT 'Voting Ensemble' AS model, key, label, round(sum(probability) / 3, 6) AS probability,
  CASE WHEN sum(probability) / 3 > 0.5 THEN 1 ELSE 0 END AS prediction FROM scores GROUP BY key, label""", _SCORES))
def soft_vote(spark, sf_dir):
    voted = evaluate.soft_vote(scores(spark, sf_dir), MODELS, "key")
    return voted.withColumn("probability", F.round("probability", 6))


@register("metric_table", over_base("\nUNION ALL ".join(
    f"SELECT model, '{n}' AS metric, round({n}, 4) AS value FROM metrics" for n in _NAMES), *_TO_METRICS))
def metric_table(spark, sf_dir):
    """The comparison of all models in long form, rounded for display."""
    found = metrics(spark, sf_dir).unpivot("model", _NAMES, "metric", "value")
    return found.withColumn("value", F.round("value", 4))


@register("risk_level", over_base("""
SELECT model, key, CASE WHEN probability > 0.7 THEN 'High' WHEN probability > 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM scores""", _SCORES))
def risk_level(spark, sf_dir):
    return scores(spark, sf_dir).select("model", "key", e.risk_level(F.col("probability")).alias("risk_level"))


_ACTIONS = ", ".join(
    f"('{level}', {i}, '{text}')" for level, texts in RISK_ACTIONS.items() for i, text in enumerate(texts))


@register("risk_actions", over_base(f"""
SELECT model, key, risk_level, step, action FROM (
  SELECT model, key, CASE WHEN probability > 0.7 THEN 'High' WHEN probability > 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level
  FROM scores) AS s
JOIN (VALUES {_ACTIONS}) AS a(level, step, action) ON level = risk_level""", _SCORES))
def risk_actions(spark, sf_dir):
    return scoring.risk_actions(scores(spark, sf_dir).select("model", "key", e.risk_level(F.col("probability")).alias("risk_level")))


# --- monitoring ---


@register("performance_monitor", over_base("""
SELECT model, day, count(*) AS scored, count(*) FILTER (label = prediction) / count(*) AS accuracy,
  count(*) FILTER (label = prediction) / count(*) < 0.82 * 0.95 AS degraded
FROM (SELECT *, CAST(o.day AS VARCHAR) AS day FROM scores JOIN (
        SELECT CAST(o_custkey AS VARCHAR) AS id, CAST(max(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1) AS o
      ON id = key) AS s GROUP BY model, day""", _SCORES).replace("SELECT *, CAST(o.day AS VARCHAR) AS day", "SELECT model, label, prediction, CAST(o.day AS VARCHAR) AS day"))
def performance_monitor(spark, sf_dir):
    """Accuracy of every scorecard by the day of the customers' last order."""
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("key")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("day")
    )
    return monitor.performance_monitor(scores(spark, sf_dir).join(days, "key"), ["model", "day"])


_DRIFT_NUMBERS = [f.name for f in REQUEST.fields if f.dataType.simpleString() != "string"]
_DRIFT_TEXT = [f.name for f in REQUEST.fields if f.name not in (KEY, *_DRIFT_NUMBERS)]


def _cells(columns: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", part, CAST("{c}" AS {kind}) AS value FROM parts""" for c in columns)


@register("drift_check", over_base(f"""
SELECT "column", 'ks' AS test, {r6_sql('max(abs(r / all_r - n / all_n))')} AS statistic FROM (
  SELECT "column", sum(ref) OVER up AS r, sum(new) OVER up AS n,
    sum(ref) OVER (PARTITION BY "column") AS all_r, sum(new) OVER (PARTITION BY "column") AS all_n
  FROM (SELECT "column", value, count(*) FILTER (part = 0) AS ref, count(*) FILTER (part = 1) AS new
        FROM ({_cells(_DRIFT_NUMBERS, 'DOUBLE')}) AS c GROUP BY 1, 2) AS v
  WINDOW up AS (PARTITION BY "column" ORDER BY value)) AS k GROUP BY 1
UNION ALL
SELECT "column", 'chi_square', {r6_sql('''sum(
  (ref - level * all_r / n) * (ref - level * all_r / n) / (level * all_r / n)
  + (new - level * all_n / n) * (new - level * all_n / n) / (level * all_n / n))''')} FROM (
  SELECT "column", ref::DOUBLE AS ref, new::DOUBLE AS new, (ref + new)::DOUBLE AS level,
    (sum(ref) OVER w)::DOUBLE AS all_r, (sum(new) OVER w)::DOUBLE AS all_n, (sum(ref + new) OVER w)::DOUBLE AS n
  FROM (SELECT "column", value, count(*) FILTER (part = 0) AS ref, count(*) FILTER (part = 1) AS new
        FROM ({_cells(_DRIFT_TEXT, 'VARCHAR')}) AS c GROUP BY 1, 2) AS v
  WINDOW w AS (PARTITION BY "column")) AS x GROUP BY 1""", """parts AS (
  SELECT base.*, CASE WHEN rn * 100 >= n * 80 THEN 1 ELSE 0 END AS part FROM base JOIN (
    SELECT "customerID" AS id, row_number() OVER (PARTITION BY "Churn" ORDER BY md5("customerID"), "customerID") - 1 AS rn,
           count(*) OVER (PARTITION BY "Churn") AS n FROM base) AS r ON id = base."customerID")"""))
def drift_check(spark, sf_dir):
    """Test part against training part."""
    halves = stage(split.train_test(staged_churn(spark, sf_dir), KEY, TARGET), "halves")
    train, test = halves.where("split = 'train'"), halves.where("split = 'test'")
    return rounded(monitor.drift_check(train, test, _DRIFT_NUMBERS, _DRIFT_TEXT), ["statistic"])


@register("champion_challenger", over_base(f"""
SELECT 'alpha' AS champion, {r6_sql('a.roc_auc')} AS champion_auc, 'beta' AS challenger, {r6_sql('b.roc_auc')} AS challenger_auc,
  b.roc_auc > a.roc_auc AS deploy
FROM metrics AS a JOIN metrics AS b ON a.model = 'alpha' AND b.model = 'beta'""", *_TO_METRICS))
def champion_challenger(spark, sf_dir):
    found = stage(metrics(spark, sf_dir), "metrics")
    pair = monitor.champion_challenger(found.where("model = 'alpha'"), found.where("model = 'beta'"))
    return rounded(pair, ["champion_auc", "challenger_auc"])


@register("model_info", over_base("""
SELECT model AS best_model_name, CAST(accuracy AS DECIMAL(5,4))::DOUBLE AS accuracy,
  CAST(precision AS DECIMAL(5,4))::DOUBLE AS precision_score, CAST(recall AS DECIMAL(5,4))::DOUBLE AS recall_score,
  CAST(f1 AS DECIMAL(5,4))::DOUBLE AS f1_score, CAST(roc_auc AS DECIMAL(5,4))::DOUBLE AS roc_auc,
  '2000-08-01 00:00:00' AS training_date, 3 AS feature_count
FROM metrics ORDER BY CAST(roc_auc AS DECIMAL(5,4)) DESC, model LIMIT 1""", *_TO_METRICS))
def model_info(spark, sf_dir):
    rows = registry.performance_rows(metrics(spark, sf_dir), instant())
    return plain(registry.model_info(rows, 3))


# --- nearest neighbours over vectors ---

_NEAR = """pairs AS (
  SELECT q.vec_id, d.vec_id AS neighbour, d.label,
    sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1),
      lambda i: (q.embedding[i]::DOUBLE - d.embedding[i]::DOUBLE) * (q.embedding[i]::DOUBLE - d.embedding[i]::DOUBLE)))) AS distance
  FROM queries AS q, donors AS d WHERE q.vec_id <> d.vec_id
), near AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(distance, 9), neighbour) AS INTEGER) AS rank FROM pairs)"""


@register("knn_join", "WITH queries AS (SELECT * FROM embeddings), donors AS (SELECT * FROM embeddings),\n" + _NEAR + """
SELECT vec_id, rank, neighbour, round(distance, 6) AS distance FROM near WHERE rank <= 5""")
def knn_join(spark, sf_dir):
    """The five nearest other vectors of every vector."""
    rows = table(spark, sf_dir, "embeddings")
    index = knn.KnnIndex.fit(rows, "vec_id", "embedding")
    near = index.neighbours(rows, "vec_id", "embedding", 5, other_than_self=True)
    return near.withColumn("distance", F.round("distance", 6))


@register("model_knn", """WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM embeddings
), queries AS (SELECT * FROM ranked WHERE rn * 100 >= n * 80
), donors AS (SELECT * FROM ranked WHERE rn * 100 < n * 80),
""" + _NEAR + """
SELECT v.vec_id, q.label, v.label AS prediction, v.share FROM (
  SELECT vec_id, label, count(*) / 5 AS share, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) AS best
  FROM near WHERE rank <= 5 GROUP BY 1, 2) AS v JOIN queries AS q ON q.vec_id = v.vec_id WHERE best = 1""")
def model_knn(spark, sf_dir):
    """Classify the test part by the votes of its five nearest training rows."""
    halves = split.train_test(table(spark, sf_dir, "embeddings"), "vec_id", "label")
    index = knn.KnnIndex.fit(halves.where("split = 'train'"), "vec_id", "embedding", ["label"])
    test = halves.where("split = 'test'")
    shares = knn.vote(index.neighbours(test, "vec_id", "embedding", 5), "vec_id", "label")
    return test.select("vec_id", "label").join(knn.predicted_class(shares, "vec_id"), "vec_id")
