"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbline.catalog.oracle_base import over_base
from ebbline.catalog.registry import churn, r6_sql, register, rounded, sig, sig_sql, staged_churn
from ebbline.fixed_values import (
    CLASS_PLOT_COLUMNS, KEY, NUMERIC_PLOT_COLUMNS, STRONG_CORRELATION, TARGET,
)
from ebbline.functions.expressions import tenure_group, to_number
from ebbline.operators import correlate, profile
from ebbline.schemas import CHURN_TABLE

NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
PARSED = """parsed AS (
  SELECT * REPLACE (TRY_CAST(nullif(trim("TotalCharges"), '') AS DOUBLE) AS "TotalCharges") FROM base)"""


def _long(columns: list[str], source: str, keep: str = "", kind: str = "DOUBLE") -> str:
    parts = [
        f"""SELECT '{c}' AS "column", {keep}CAST("{c}" AS {kind}) AS value FROM {source} WHERE "{c}" IS NOT NULL"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


LONG = f"long AS ({_long(NUMERIC, 'parsed')})"
QUARTILES = """quart AS (
  SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1)"""


def parsed(spark, sf_dir):
    return churn(spark, sf_dir).withColumn("TotalCharges", to_number(F.col("TotalCharges")))


@register("churn_by_segment", over_base("""
SELECT CASE WHEN tenure > 0 AND tenure <= 12 THEN '0-1yr' WHEN tenure > 12 AND tenure <= 24 THEN '1-2yr'
            WHEN tenure > 24 AND tenure <= 36 THEN '2-3yr' WHEN tenure > 36 AND tenure <= 48 THEN '3-4yr'
            WHEN tenure > 48 AND tenure <= 72 THEN '4+yr' END AS tenure_group,
  "Contract", count(*) AS customers, count(*) FILTER ("Churn" = 'Yes') AS churned,
  count(*) FILTER ("Churn" = 'Yes') / count(*) AS churn_rate,
  CAST(sum(CAST(round("MonthlyCharges" * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS mean_monthly_charge
FROM base GROUP BY 1, 2"""))
def churn_by_segment(spark, sf_dir):
    grouped = churn(spark, sf_dir).withColumn("tenure_group", tenure_group(F.col("tenure")))
    return profile.churn_by_segment(grouped, ["tenure_group", "Contract"])


@register("validate_input", over_base("""
SELECT 'table_is_empty' AS rule, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT AS violations FROM base
UNION ALL SELECT 'target_column_missing', 0
UNION ALL SELECT 'target_not_yes_or_no', count(*) FILTER (NOT coalesce("Churn" IN ('Yes', 'No'), false)) FROM base"""))
def validate_input(spark, sf_dir):
    return profile.validate_input(churn(spark, sf_dir))


@register("dataset_shape", over_base("SELECT count(*) AS samples, 20::BIGINT AS features FROM base"))
def dataset_shape(spark, sf_dir):
    return profile.dataset_shape(churn(spark, sf_dir))


@register("columns_by_type", over_base(" UNION ALL ".join(
    f"""SELECT '{f.name}' AS "column", count("{f.name}") AS non_null,
  '{"categorical" if f.dataType.simpleString() == "string" else "numeric"}' AS kind FROM base""" for f in CHURN_TABLE.fields)))
def columns_by_type(spark, sf_dir):
    return profile.columns_by_type(churn(spark, sf_dir))


@register("column_profile", over_base(" UNION ALL ".join(
    f"""SELECT '{f.name}' AS "column", '{f.dataType.simpleString()}' AS data_type,
  count("{f.name}") AS non_null_count, count(*) - count("{f.name}") AS null_count,
  (count(*) - count("{f.name}")) / count(*) * 100 AS null_percentage,
  count(DISTINCT "{f.name}") AS unique_values FROM base""" for f in CHURN_TABLE.fields)))
def column_profile(spark, sf_dir):
    return profile.column_profile(churn(spark, sf_dir))


@register("describe_numeric", over_base(f"""
SELECT long."column", count(value) AS "count", {r6_sql('avg(value)')} AS mean,
  {sig_sql('stddev_samp(value)')} AS std, min(value) AS min, max(value) AS max,
  {r6_sql('max(q1)')} AS q1, {r6_sql('max(median)')} AS median, {r6_sql('max(q3)')} AS q3
FROM long JOIN quart ON quart."column" = long."column" GROUP BY 1""", PARSED, LONG, QUARTILES))
def describe_numeric(spark, sf_dir):
    out = rounded(profile.describe_numeric(parsed(spark, sf_dir), NUMERIC), ["mean", "q1", "median", "q3"])
    return rounded(out, ["std"], sig)


@register("numeric_statistics", over_base(f"""
SELECT long."column", {r6_sql('avg(value)')} AS mean, min(value) AS min, max(value) AS max,
  max(mode_value) AS mode, {sig_sql('var_samp(value)')} AS variance, {sig_sql('stddev_samp(value)')} AS std,
  {r6_sql('skewness(value)')} AS skewness, {r6_sql('kurtosis(value)')} AS kurtosis,
  {r6_sql('max(q1)')} AS q1, {r6_sql('max(median)')} AS median, {r6_sql('max(q3)')} AS q3,
  {r6_sql('max(q3) - max(q1)')} AS iqr
FROM long JOIN quart ON quart."column" = long."column" JOIN modes ON modes."column" = long."column"
GROUP BY 1""", PARSED, LONG, QUARTILES, """modes AS (
  SELECT "column", value AS mode_value FROM (
    SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS rn
    FROM long GROUP BY 1, 2) AS counted WHERE rn = 1)"""))
def numeric_statistics(spark, sf_dir):
    out = profile.numeric_statistics(parsed(spark, sf_dir), NUMERIC)
    out = rounded(out, ["mean", "skewness", "kurtosis", "q1", "median", "q3", "iqr"])
    return rounded(out, ["variance", "std"], sig)


@register("iqr_outliers", over_base(f"""
SELECT long."column", {r6_sql('q1 - (q3 - q1) * 1.5')} AS lower_bound, {r6_sql('q3 + (q3 - q1) * 1.5')} AS upper_bound,
  count(*) FILTER (value < q1 - (q3 - q1) * 1.5 OR value > q3 + (q3 - q1) * 1.5) AS outliers
FROM long JOIN quart ON quart."column" = long."column" GROUP BY 1, 2, 3""", PARSED, LONG, QUARTILES))
def iqr_outliers(spark, sf_dir):
    return rounded(profile.iqr_outliers(parsed(spark, sf_dir), NUMERIC), ["lower_bound", "upper_bound"])


@register("target_distribution", over_base("""
SELECT "Churn", count(*) AS n, count(*) / (SELECT count(*) FROM base) * 100 AS percentage FROM base GROUP BY 1"""))
def target_distribution(spark, sf_dir):
    return profile.target_distribution(churn(spark, sf_dir))


_TEXT = [f.name for f in CHURN_TABLE.fields if f.dataType.simpleString() == "string" and f.name != TARGET]


@register("categorical_distribution", over_base("""
SELECT t."column", t.value, t.n, t.n / (SELECT count(*) FROM base) * 100 AS percentage
FROM (SELECT "column", value, count(*) AS n, count(*) OVER (PARTITION BY "column") AS levels
      FROM texts GROUP BY 1, 2) AS t WHERE levels <= 10""", f"texts AS ({_long(_TEXT, 'base', kind='VARCHAR')})"))
def categorical_distribution(spark, sf_dir):
    return profile.categorical_distribution(churn(spark, sf_dir), _TEXT)


@register("churn_by_category", over_base("""
SELECT "column", value, "Churn", count(*) AS n FROM texts GROUP BY 1, 2, 3""",
    f"""texts AS ({_long(CLASS_PLOT_COLUMNS, 'base', '"Churn", ', 'VARCHAR')})"""))
def churn_by_category(spark, sf_dir):
    return profile.counts_by_class(churn(spark, sf_dir), CLASS_PLOT_COLUMNS)


_PLOT = f"""long AS ({_long(NUMERIC_PLOT_COLUMNS, 'parsed', '"Churn", ')})"""


@register("churn_histogram", over_base("""
SELECT b."column", b."Churn", b.bin, low + b.bin * width AS bin_start, coalesce(n, 0) AS n
FROM (SELECT "column", low, width, "Churn", CAST(bin AS INTEGER) AS bin
      FROM ranges, (SELECT DISTINCT "Churn" FROM base) AS classes, range(30) AS bins(bin)) AS b
LEFT JOIN (SELECT long."column", "Churn", CAST(least(floor((value - low) / width), 29) AS INTEGER) AS bin, count(*) AS n
           FROM long JOIN ranges ON ranges."column" = long."column" GROUP BY 1, 2, 3) AS f
  ON f."column" = b."column" AND f."Churn" = b."Churn" AND f.bin = b.bin""", PARSED, _PLOT, """ranges AS (
  SELECT "column", min(value) AS low, (max(value) - min(value)) / 30 AS width FROM long GROUP BY 1)"""))
def churn_histogram(spark, sf_dir):
    return profile.class_histogram(parsed(spark, sf_dir), NUMERIC_PLOT_COLUMNS)


@register("churn_boxplot", over_base(f"""
SELECT long."column", long."Churn", {r6_sql('q1')} AS q1, {r6_sql('median')} AS median, {r6_sql('q3')} AS q3,
  min(value) FILTER (value >= q1 - (q3 - q1) * 1.5 AND value <= q3 + (q3 - q1) * 1.5) AS whisker_low,
  max(value) FILTER (value >= q1 - (q3 - q1) * 1.5 AND value <= q3 + (q3 - q1) * 1.5) AS whisker_high,
  count(*) FILTER (NOT (value >= q1 - (q3 - q1) * 1.5 AND value <= q3 + (q3 - q1) * 1.5)) AS fliers
FROM long JOIN quart ON quart."column" = long."column" AND quart."Churn" = long."Churn"
GROUP BY 1, 2, 3, 4, 5""", PARSED, _PLOT, """quart AS (
  SELECT "column", "Churn", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1, 2)"""))
def churn_boxplot(spark, sf_dir):
    return rounded(profile.class_boxplot(parsed(spark, sf_dir), NUMERIC_PLOT_COLUMNS), ["q1", "median", "q3"])


_CODED = [f.name for f in CHURN_TABLE.fields if f.name != KEY]
_CODES = "coded AS (SELECT \"customerID\", " + ", ".join(
    f"""coalesce("{c}", (SELECT median("{c}") FROM parsed)) AS "{c}" """ if c == "TotalCharges"
    else f"""CAST(dense_rank() OVER (ORDER BY "{c}") - 1 AS DOUBLE) AS "{c}" """ if c in _TEXT + [TARGET]
    else f"""CAST("{c}" AS DOUBLE) AS "{c}" """ for c in _CODED) + " FROM parsed)"
_LONG_CODES = """cells AS (UNPIVOT coded ON COLUMNS(* EXCLUDE "customerID") INTO NAME feature VALUE value)"""


@register("correlation_matrix", over_base(f"""
SELECT a.feature AS feature_a, b.feature AS feature_b, {r6_sql('corr(a.value, b.value)')} AS correlation
FROM cells AS a JOIN cells AS b ON a."customerID" = b."customerID" GROUP BY 1, 2""", PARSED, _CODES, _LONG_CODES))
def correlation_matrix(spark, sf_dir):
    numbers = correlate.encoded_for_correlation(staged_churn(spark, sf_dir))
    return rounded(correlate.correlation_matrix(numbers), ["correlation"])


@register("target_correlation", over_base(f"""
SELECT feature, {r6_sql('correlation')} AS correlation, abs(correlation) > 0.3 AS strong FROM (
  SELECT a.feature, corr(a.value, b.value) AS correlation
  FROM cells AS a JOIN cells AS b ON a."customerID" = b."customerID" AND b.feature = 'Churn' AND a.feature <> 'Churn'
  GROUP BY 1) AS c ORDER BY abs(correlation) DESC, feature LIMIT 15""", PARSED, _CODES, _LONG_CODES))
def target_correlation(spark, sf_dir):
    numbers = correlate.encoded_for_correlation(staged_churn(spark, sf_dir))
    top = correlate.strongest(correlate.target_correlation(numbers), 15)
    return rounded(top.withColumn("strong", F.abs("correlation") > STRONG_CORRELATION), ["correlation"])


@register("preview_rows", over_base('SELECT * FROM base ORDER BY "customerID" LIMIT 5'))
def preview_rows(spark, sf_dir):
    return profile.preview_rows(churn(spark, sf_dir), KEY)
