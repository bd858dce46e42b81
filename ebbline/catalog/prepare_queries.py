"""Preparation, selection and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbline.catalog.oracle_base import over_base
from ebbline.catalog.registry import churn, r6_sql, register, rounded, staged_churn, table
from ebbline.fixed_values import BINARY_COLUMNS, KEY, ONE_HOT_COLUMNS, SERVICE_COLUMNS, TARGET
from ebbline.functions import expressions as e
from ebbline.functions.expressions import named
from ebbline.operators import encode, scale, select, split
from ebbline.operators.profile import columns_of
from ebbline.plans import features as prep
from ebbline.plans import training
from ebbline.schemas import ATTRIBUTE_NAMES, CHURN_TABLE
from ebbline.workspace import stage

# --- pieces of oracle SQL ---

_NUMBER = """CASE WHEN regexp_full_match(trim("TotalCharges"), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
  THEN TRY_CAST(trim("TotalCharges") AS DOUBLE) END"""
_CHARGED = f"""charged AS (
  SELECT * REPLACE (CASE WHEN tenure = 0 THEN 0.0::DOUBLE ELSE {_NUMBER} END AS "TotalCharges") FROM base)"""
_FILLED = """near AS (
  SELECT r."customerID" AS id, d."TotalCharges" AS value, row_number() OVER (PARTITION BY r."customerID" ORDER BY
    CAST(r.tenure - d.tenure AS DOUBLE) * (r.tenure - d.tenure)
      + (r."MonthlyCharges" - d."MonthlyCharges") * (r."MonthlyCharges" - d."MonthlyCharges"), d."customerID") AS rn
  FROM charged AS r, charged AS d WHERE r."TotalCharges" IS NULL AND d."TotalCharges" IS NOT NULL
), imputed AS (
  SELECT id, sum(value) / count(*) AS value FROM near WHERE rn <= 5 GROUP BY id
), filled AS (
  SELECT charged.* REPLACE (coalesce("TotalCharges", imputed.value) AS "TotalCharges")
  FROM charged LEFT JOIN imputed ON id = "customerID")"""
_SERVICES = "(" + " + ".join(f"""CASE WHEN "{c}" = 'Yes' THEN 1 ELSE 0 END""" for c in SERVICE_COLUMNS) + ")"
_GROUP = """CASE WHEN tenure > 0 AND tenure <= 12 THEN '0-1yr' WHEN tenure > 12 AND tenure <= 24 THEN '1-2yr'
  WHEN tenure > 24 AND tenure <= 36 THEN '2-3yr' WHEN tenure > 36 AND tenure <= 48 THEN '3-4yr'
  WHEN tenure > 48 AND tenure <= 72 THEN '4+yr' END"""
_STAGE = """CASE WHEN tenure > 0 AND tenure <= 6 THEN 'New' WHEN tenure > 6 AND tenure <= 12 THEN 'Growing'
  WHEN tenure > 12 AND tenure <= 24 THEN 'Mature' WHEN tenure > 24 AND tenure <= 72 THEN 'Loyal' END"""
_MADE = f"""made AS (
  SELECT *, {_SERVICES} AS services, {_GROUP} AS tenure_group, {_STAGE} AS customer_lifecycle FROM filled)"""
_SERVICE_LEVELS = ["No", "No internet service", "Yes"]
_LEVELS = {
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    **{c: _SERVICE_LEVELS for c in SERVICE_COLUMNS},
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaymentMethod": ["Bank transfer", "Credit card", "Electronic check", "Mailed check"],
    "tenure_group": ["0-1yr", "1-2yr", "2-3yr", "3-4yr", "4+yr"],
    "customer_lifecycle": ["New", "Growing", "Mature", "Loyal"],
}


def _binary(column: str) -> str:
    return f"""CASE WHEN "{column}" IN ('Yes', 'Male') THEN 1 WHEN "{column}" IN ('No', 'Female') THEN 0 END"""


def _indicators(levels: dict[str, list[str]]) -> dict[str, str]:
    return {
        f"{c}_{level}": f"""CASE WHEN "{c}" = '{level}' THEN 1.0 ELSE 0.0 END"""
        for c, known in levels.items() for level in known[1:]
    }


_FEATURES = {
    **{c: _binary(c) if c in BINARY_COLUMNS else f'"{c}"' for c in ATTRIBUTE_NAMES if c not in _LEVELS},
    "avg_monthly_charges": '"TotalCharges" / (tenure + 1)',
    "charges_per_service": '"MonthlyCharges" / (services + 1)',
    "total_services": "services",
    "service_adoption_rate": "services / 6.0::DOUBLE",
    "high_risk_contract": """CASE WHEN "Contract" = 'Month-to-month' THEN 1 ELSE 0 END""",
    "high_risk_payment": """CASE WHEN "PaymentMethod" = 'Electronic check' THEN 1 ELSE 0 END""",
    **_indicators(_LEVELS),
}
_APPROXIMATE = ["TotalCharges", "avg_monthly_charges"]
_FEATURE_TABLE = (
    """features AS (SELECT "customerID", CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END AS "Churn", """
    + ", ".join(
        f'CAST({r6_sql(x) if n in _APPROXIMATE else x} AS DOUBLE) AS "{n}"' for n, x in _FEATURES.items()
    )
    + " FROM made)"
)
_CELLS = """cells AS (
  UNPIVOT features ON COLUMNS(* EXCLUDE ("customerID", "Churn")) INTO NAME feature VALUE value)"""
_TO_FEATURES = (_CHARGED, _FILLED, _MADE, _FEATURE_TABLE)


def feature_rows(spark, sf_dir):
    """The prepared table; the mean of imputed charges is rounded, so that both engines see equal ties."""
    base = staged_churn(spark, sf_dir)
    out = prep.FeaturePipeline.fit(base).transform(base)
    return rounded(out, _APPROXIMATE)


# --- cleaning and encoding ---


@register("coerce_numeric", over_base(f"""SELECT "customerID", {_NUMBER} AS "TotalCharges" FROM base"""))
def coerce_numeric(spark, sf_dir):
    return churn(spark, sf_dir).select(KEY, e.to_number(F.col("TotalCharges")).alias("TotalCharges"))


@register("fix_zero_tenure", over_base('SELECT "customerID", tenure, "TotalCharges" FROM charged', _CHARGED))
def fix_zero_tenure(spark, sf_dir):
    return prep.numeric_charges(churn(spark, sf_dir)).select(KEY, "tenure", "TotalCharges")


@register("serve_fill_zero", over_base(f"""
SELECT "customerID", coalesce({_NUMBER}, 0.0::DOUBLE) AS "TotalCharges" FROM base"""))
def serve_fill_zero(spark, sf_dir):
    return prep.charges_or_zero(churn(spark, sf_dir)).select(KEY, "TotalCharges")


# All numeric columns of the churn table, and its charges as a number.
_NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]


@register("median_fill", over_base('SELECT "customerID", ' + ", ".join(
    r6_sql(f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median("{c}") FROM numbers))') + f' AS "{c}"' for c in _NUMERIC
) + " FROM numbers", f'numbers AS (SELECT * REPLACE ({_NUMBER} AS "TotalCharges") FROM base)'))
def median_fill(spark, sf_dir):
    base = staged_churn(spark, sf_dir).withColumn("TotalCharges", e.to_number(F.col("TotalCharges")))
    columns = columns_of(base, numeric=True)
    return rounded(scale.median_fill(base.select(KEY, *columns), columns), columns)


@register("knn_impute", over_base(f"""
SELECT "customerID", tenure, "MonthlyCharges", {r6_sql('"TotalCharges"')} AS "TotalCharges" FROM filled""",
    _CHARGED, _FILLED))
def knn_impute(spark, sf_dir):
    base = prep.numeric_charges(staged_churn(spark, sf_dir))
    donors = prep.donor_points(base, "TotalCharges", "tenure", "MonthlyCharges", KEY)
    out = prep.impute(base, donors, "TotalCharges", "tenure", "MonthlyCharges")
    return rounded(out.select(KEY, "tenure", "MonthlyCharges", "TotalCharges"), ["TotalCharges"])


@register("tenure_binning", over_base(f"""
SELECT "customerID", tenure, {_GROUP} AS tenure_group, {_STAGE} AS customer_lifecycle FROM base"""))
def tenure_binning(spark, sf_dir):
    return churn(spark, sf_dir).select(
        KEY, "tenure",
        e.tenure_group(F.col("tenure")).alias("tenure_group"),
        e.customer_lifecycle(F.col("tenure")).alias("customer_lifecycle"),
    )


@register("binary_encode", over_base(
    'SELECT "customerID", ' + ", ".join(f'{_binary(c)} AS "{c}"' for c in BINARY_COLUMNS) + " FROM base"))
def binary_encode(spark, sf_dir):
    return churn(spark, sf_dir).select(KEY, *[e.binary_code(F.col(c)).alias(c) for c in BINARY_COLUMNS])


@register("service_counts", over_base(f"""
SELECT "customerID", {_SERVICES} AS total_services, {_SERVICES} / 6.0::DOUBLE AS service_adoption_rate FROM base"""))
def service_counts(spark, sf_dir):
    made = e.engineered_columns()
    names = ["total_services", "service_adoption_rate"]
    return churn(spark, sf_dir).select(KEY, *[made[n].alias(n) for n in names])


@register("value_metrics", over_base(f"""
SELECT "customerID", "TotalCharges" / (tenure + 1) AS avg_monthly_charges,
  "MonthlyCharges" / ({_SERVICES} + 1) AS charges_per_service, {_SERVICES} / 6.0::DOUBLE AS service_adoption_rate
FROM charged""", _CHARGED))
def value_metrics(spark, sf_dir):
    made = e.engineered_columns()
    names = ["avg_monthly_charges", "charges_per_service", "service_adoption_rate"]
    return prep.numeric_charges(churn(spark, sf_dir)).select(KEY, *[made[n].alias(n) for n in names])


@register("risk_flags", over_base(f"""
SELECT "customerID", {_FEATURES['high_risk_contract']} AS high_risk_contract,
  {_FEATURES['high_risk_payment']} AS high_risk_payment FROM base"""))
def risk_flags(spark, sf_dir):
    made = e.engineered_columns()
    return churn(spark, sf_dir).select(KEY, *[made[n].alias(n) for n in ["high_risk_contract", "high_risk_payment"]])


_ENCODED = [f.name for f in CHURN_TABLE.fields if f.dataType.simpleString() == "string" and f.name != KEY]


@register("label_encode", over_base('SELECT "customerID", ' + ", ".join(
    f'CAST(dense_rank() OVER (ORDER BY "{c}") - 1 AS INTEGER) AS "{n}"'
    for c, n in [(KEY, "key_code"), *[(c, c) for c in _ENCODED]]) + " FROM base"))
def label_encode(spark, sf_dir):
    rows = staged_churn(spark, sf_dir).select(KEY, F.col(KEY).alias("key_code"), *_ENCODED)
    return encode.label_encode(rows, ["key_code", *_ENCODED])


_ENCODED_LEVELS = {c: _LEVELS[c] for c in ONE_HOT_COLUMNS if c in ATTRIBUTE_NAMES}


@register("one_hot", over_base('SELECT "customerID", ' + ", ".join(
    f'CAST({x} AS DOUBLE) AS "{n}"' for n, x in _indicators(_ENCODED_LEVELS).items()) + " FROM base"))
def one_hot(spark, sf_dir):
    rows = staged_churn(spark, sf_dir).select(KEY, *_ENCODED_LEVELS)
    return encode.one_hot(rows, encode.fit_levels(rows, list(_ENCODED_LEVELS)))


@register("one_hot_many_levels", """
SELECT c_custkey, "column", level, code FROM (
  SELECT c_custkey, 'c_name' AS "column", c_name AS level, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) FROM customer
) AS held WHERE code > 0""")
def one_hot_many_levels(spark, sf_dir):
    """Sparse indicators of a column with as many levels as rows beside one with few."""
    return encode.one_hot_entries(table(spark, sf_dir, "customer"), "c_custkey", ["c_name", "c_mktsegment"])


@register("project_features", over_base('SELECT * EXCLUDE ("customerID", "Churn") FROM base'))
def project_features(spark, sf_dir):
    return prep.project_features(churn(spark, sf_dir))


@register("align_features", over_base("""
SELECT "customerID", CAST(tenure AS DOUBLE) AS tenure, 0.0::DOUBLE AS "Contract_Two year", "MonthlyCharges",
  CAST("SeniorCitizen" AS DOUBLE) AS "SeniorCitizen" FROM base"""))
def align_features(spark, sf_dir):
    rows = churn(spark, sf_dir).select(KEY, "MonthlyCharges", *[F.col(c).cast("double").alias(c) for c in ("SeniorCitizen", "tenure")])
    return prep.align_features(rows, ["tenure", "Contract_Two year", "MonthlyCharges", "SeniorCitizen"], [KEY])


@register("feature_table", over_base("SELECT * FROM features", *_TO_FEATURES))
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir)


_NEW = """newcomers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender
  FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM past))"""


@register("union_new_customer", over_base(f"""
SELECT "customerID", gender, tenure, "Contract", {_GROUP} AS tenure_group FROM base
UNION ALL SELECT id, gender, NULL, NULL, NULL FROM newcomers""", _NEW))
def union_new_customer(spark, sf_dir):
    base = churn(spark, sf_dir)
    key = F.col("c_custkey")
    records = table(spark, sf_dir, "customer").select(
        key.cast("string").alias(KEY), F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender")
    ).join(base.select(KEY), KEY, "left_anti")
    both = prep.with_new_records(base, records)
    return both.select(KEY, "gender", "tenure", "Contract", e.tenure_group(F.col("tenure")).alias("tenure_group"))


# --- splits ---

_RANKED = """ranked AS (
  SELECT "customerID", "Churn", row_number() OVER (PARTITION BY "Churn" ORDER BY md5("customerID"), "customerID") - 1 AS rn,
         count(*) OVER (PARTITION BY "Churn") AS n FROM base)"""


@register("stratified_split", over_base("""
SELECT "customerID", "Churn", CASE WHEN rn * 100 >= n * 80 THEN 'test' ELSE 'train' END AS split_80_20,
  CASE WHEN rn * 100 >= n * 70 THEN 'test' ELSE 'train' END AS split_70_30 FROM ranked""", _RANKED))
def stratified_split(spark, sf_dir):
    rows = staged_churn(spark, sf_dir).select(KEY, TARGET)
    first = split.train_test(rows, KEY, TARGET, 20).withColumnRenamed("split", "split_80_20")
    return split.train_test(first, KEY, TARGET, 30).withColumnRenamed("split", "split_70_30")


@register("split_class_counts", over_base("""
SELECT "Churn", CASE WHEN rn * 100 >= n * 80 THEN 'test' ELSE 'train' END AS split, count(*) AS n
FROM ranked GROUP BY 1, 2""", _RANKED))
def split_class_counts(spark, sf_dir):
    rows = staged_churn(spark, sf_dir).select(KEY, TARGET)
    return split.train_test(rows, KEY, TARGET).groupBy(TARGET, "split").agg(F.count("*").alias("n"))


@register("stratified_folds", over_base("""
SELECT "customerID", "Churn", CAST(floor(rn * 5 / n) AS INTEGER) AS fold FROM ranked""", _RANKED))
def stratified_folds(spark, sf_dir):
    return split.stratified_folds(staged_churn(spark, sf_dir).select(KEY, TARGET), KEY, TARGET)


@register("class_weights", over_base("""
SELECT "Churn", count(*) AS rows,
  (SELECT count(*) FROM base) / ((SELECT count(DISTINCT "Churn") FROM base) * count(*)) AS weight FROM base GROUP BY 1"""))
def class_weights(spark, sf_dir):
    return split.class_weights(churn(spark, sf_dir), TARGET)


# Every feature of the prepared table is scaled.
@register("robust_scale", over_base('SELECT r."customerID", ' + ", ".join(
    f"""{r6_sql(f'''(r."{c}" - (SELECT median("{c}") FROM train))
      / (SELECT CASE WHEN quantile_cont("{c}", 0.75) = quantile_cont("{c}", 0.25) THEN 1.0
                ELSE quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25) END FROM train)''')} AS "{c}" """
    for c in _FEATURES) + " FROM features AS r", *_TO_FEATURES, _RANKED, """train AS (
  SELECT features.* FROM features JOIN ranked ON ranked."customerID" = features."customerID" WHERE rn * 100 < n * 80)"""))
def robust_scale(spark, sf_dir):
    rows = stage(feature_rows(spark, sf_dir), "features")
    columns = prep.numeric_features(rows)
    halves = stage(split.train_test(rows, KEY, TARGET), "split")
    fitted = scale.RobustScale.fit(halves.where("split = 'train'"), columns)
    return rounded(fitted.transform(halves).select(KEY, *[named(c) for c in columns]), columns)


# --- selection ---

_F = f"""anova AS (
  SELECT feature, CASE WHEN within > 0 THEN between_ / (within / (n - 2)) END AS score FROM (
    SELECT c.feature, sum((c.value - m.mean) * (c.value - m.mean)) AS within, any_value(b.between_) AS between_, count(*) AS n
    FROM cells AS c JOIN class_means AS m ON m.feature = c.feature AND m."Churn" = c."Churn"
    JOIN (SELECT m.feature, sum(m.n * (m.mean - a.mean) * (m.mean - a.mean)) AS between_
          FROM class_means AS m JOIN (SELECT feature, avg(value) AS mean FROM cells GROUP BY 1) AS a ON a.feature = m.feature
          GROUP BY 1) AS b ON b.feature = c.feature GROUP BY 1) AS sums)"""
_MEANS = """class_means AS (SELECT feature, "Churn", avg(value) AS mean, count(*) AS n FROM cells GROUP BY 1, 2)"""
_MI = """binned AS (
  SELECT c.feature, c."Churn", CASE WHEN v.levels <= 10 THEN v.level - 1 ELSE v.before * 10 // v.n END AS bin
  FROM cells AS c JOIN (
    SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS level,
           count(*) OVER (PARTITION BY feature) AS levels,
           sum(k) OVER (PARTITION BY feature) AS n,
           sum(k) OVER (PARTITION BY feature ORDER BY value) - k AS before
    FROM (SELECT feature, value, count(*) AS k FROM cells GROUP BY 1, 2) AS counted) AS v
  ON v.feature = c.feature AND v.value = c.value
), cell_counts AS (
  SELECT feature, bin, "Churn", count(*)::DOUBLE AS n_xy FROM binned GROUP BY 1, 2, 3
), information AS (
  SELECT feature, sum(n_xy / n * ln(n_xy * n / (n_x * n_y))) AS score FROM (
    SELECT feature, n_xy, sum(n_xy) OVER (PARTITION BY feature) AS n, sum(n_xy) OVER (PARTITION BY feature, bin) AS n_x,
           sum(n_xy) OVER (PARTITION BY feature, "Churn") AS n_y FROM cell_counts) AS shares GROUP BY 1)"""


def _label_counts(rows):
    return select.counts_by_label(rows, prep.numeric_features(rows), TARGET)


@register("anova_f_scores", over_base(
    f"SELECT feature, {r6_sql('score')} AS score FROM anova", *_TO_FEATURES, _CELLS, _MEANS, _F))
def anova_f_scores(spark, sf_dir):
    return rounded(select.anova_f(_label_counts(feature_rows(spark, sf_dir))), ["score"])


@register("mutual_information", over_base(
    f"SELECT feature, {r6_sql('score')} AS score FROM information", *_TO_FEATURES, _CELLS, _MI))
def mutual_information(spark, sf_dir):
    return rounded(select.mutual_information(_label_counts(feature_rows(spark, sf_dir))), ["score"])


_TOP = """SELECT feature FROM (SELECT feature, row_number() OVER (
  ORDER BY {score} DESC NULLS LAST, feature) AS rn FROM {source}) AS r WHERE rn <= 20"""


_VOTES = f"""
SELECT feature, count(DISTINCT method) AS votes, count(DISTINCT method) >= 2 AS selected FROM (
  SELECT 'univariate' AS method, feature FROM ({_TOP.format(score='round(score, 9)', source='anova')}) AS a
  UNION ALL SELECT 'mutual_info', feature FROM ({_TOP.format(score='round(score, 9)', source='information')}) AS b
  UNION ALL SELECT 'mean_gap', feature FROM ({_TOP.format(score='round(score, 9)', source='gaps')}) AS c
  UNION ALL SELECT 'share_nonzero', feature FROM ({_TOP.format(score='score', source='nonzero')}) AS d) AS m
GROUP BY 1"""
_VOTE_PARTS = [
    *_TO_FEATURES, _CELLS, _MEANS, _F, _MI, """gaps AS (
  SELECT c.feature, abs(max(CASE WHEN "Churn" = 1 THEN mean END) - max(CASE WHEN "Churn" = 0 THEN mean END)) AS score
  FROM class_means AS c GROUP BY 1)""", """nonzero AS (
  SELECT feature, count(*) FILTER (value <> 0) AS score FROM cells GROUP BY 1)""",
]


@register("feature_votes", over_base(_VOTES, *_VOTE_PARTS))
def feature_votes(spark, sf_dir):
    return _voted(feature_rows(spark, sf_dir))


def _voted(rows):
    """The vote over F scores, mutual information and two further rankings that SQL can state."""
    counts = training.stage(_label_counts(rows), "label-counts")

    def nine(scores):
        return select.top_features(scores.withColumn("score", F.round("score", 9)))

    value, n0, n1 = F.col("value"), F.col("n0"), F.col("n1")
    gap = F.abs(F.sum(value * n1) / F.sum(n1) - F.sum(value * n0) / F.sum(n0))
    nonzero = F.coalesce(F.sum(F.when(value != 0, n0 + n1)), F.lit(0))
    return select.feature_votes({
        "univariate": nine(select.anova_f(counts)),
        "mutual_info": nine(select.mutual_information(counts)),
        "mean_gap": nine(counts.groupBy("feature").agg(gap.alias("score"))),
        "share_nonzero": select.top_features(counts.groupBy("feature").agg(nonzero.alias("score"))),
    })


@register("feature_vote_report", over_base(f"""
SELECT CAST(row_number() OVER (ORDER BY votes DESC, feature) AS INTEGER) AS place, feature, votes, selected,
  (SELECT count(DISTINCT feature) FROM cells) AS features, count(*) FILTER (selected) OVER () AS kept,
  round(100.0::DOUBLE * ((SELECT count(DISTINCT feature) FROM cells) - count(*) FILTER (selected) OVER ())
    / (SELECT count(DISTINCT feature) FROM cells), 6) AS reduction_percent
FROM ({_VOTES}) AS v QUALIFY place <= 15""", *_VOTE_PARTS))
def feature_vote_report(spark, sf_dir):
    """The 15 features with most votes, how many are kept, and by how much the table narrows."""
    rows = feature_rows(spark, sf_dir)
    report = select.vote_report(_voted(rows), len(prep.numeric_features(rows)))
    return report.withColumn("reduction_percent", F.round("reduction_percent", 6))


@register("tree_importance")
def tree_importance(spark, sf_dir):
    rows = training.stage(feature_rows(spark, sf_dir), "features")
    return select.top_features(training.tree_importance(rows, prep.numeric_features(rows), TARGET))


@register("l1_selection")
def l1_selection(spark, sf_dir):
    rows = training.stage(feature_rows(spark, sf_dir), "features")
    return training.l1_coefficients(rows, prep.numeric_features(rows), TARGET)


@register("feature_votes_models")
def feature_votes_models(spark, sf_dir):
    """The vote of all four methods: F scores, mutual information, forest importance, L1 coefficients."""
    rows = training.stage(feature_rows(spark, sf_dir), "features")
    return training.vote_features(rows, prep.numeric_features(rows), TARGET)
