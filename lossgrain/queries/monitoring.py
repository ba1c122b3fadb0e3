"""Queries of the prediction log: summaries and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrain.operators import model as md
from lossgrain.operators import monitor as mo
from lossgrain.queries.modelling import ATTRIBUTED, attributions
from lossgrain.queries.registry import query, rounded, rs
from lossgrain.queries.testbed import baseline, features, log, orig, sql
from lossgrain.session import pin, scratch_path
from lossgrain.sources import daily_summary as dy
from lossgrain.sources import prediction_log as pl

PERIOD = "strftime(min(ts), '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(max(ts), '%Y-%m-%d %H:%M:%S')"
NUMBERS = """objects AS (
  SELECT *, CASE WHEN json_valid(features_json) THEN CAST(features_json AS JSON) END AS j FROM log),
entries AS (
  SELECT ts, predicted_lgd, k AS feature, json_extract(j, '$.' || k) AS v FROM (
    SELECT ts, predicted_lgd, j, unnest(json_keys(j)) AS k FROM objects WHERE json_type(j) = 'OBJECT')),
numbers AS (
  SELECT ts, feature, CASE WHEN json_type(v) = 'BOOLEAN' THEN CASE WHEN CAST(v AS VARCHAR) = 'true'
      THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END ELSE CAST(CAST(v AS VARCHAR) AS DOUBLE) END AS value
  FROM entries WHERE json_type(v) IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN'))"""
MEANS_SQL = NUMBERS + """,
means AS (SELECT feature, avg(value) AS serving_mean, count(*) AS n FROM numbers GROUP BY feature)"""
SHIFTS = MEANS_SQL + f""",
shifts AS (SELECT m.feature, m.serving_mean, m.n, b.train_mean,
  {rs('abs(serving_mean - train_mean) / abs(train_mean)', 4)} AS mean_shift
  FROM means m JOIN baseline b ON m.feature = b.feature WHERE b.train_mean <> 0)"""


@query("mon1_prediction_summary", sql(f"""SELECT count(*) AS n_predictions, round(avg(predicted_lgd), 6) AS mean_predicted_lgd,
  {PERIOD} AS period FROM log""", "log"))
def mon1(spark, d):
    return mo.prediction_summary(log(spark, d))


@query("mon2_json_feature_means", sql(f"SELECT feature, {rs('serving_mean', 4)} AS serving_mean, n FROM means",
                                      "log", extra=MEANS_SQL))
def mon2(spark, d):
    return rounded(mo.json_feature_means(log(spark, d)), ["serving_mean"], 4)


@query("j7_drift_join", sql(f"""SELECT m.feature, {rs('serving_mean', 4)} AS serving_mean, n, train_mean FROM means m
  JOIN baseline b ON m.feature = b.feature WHERE train_mean <> 0""", "log", "baseline", extra=MEANS_SQL))
def j7(spark, d):
    return rounded(mo.drift_join(mo.json_feature_means(log(spark, d)), baseline(spark)), ["serving_mean"], 4)


@query("mon3_mean_shift", sql("SELECT feature, mean_shift FROM shifts", "log", "baseline", extra=SHIFTS))
def mon3(spark, d):
    return mo.mean_shift(mo.json_feature_means(log(spark, d)), baseline(spark)).select("feature", "mean_shift")


@query("mon4_drift_alerts", sql("SELECT feature, mean_shift, mean_shift > 0.1 AS alert FROM shifts",
                                "log", "baseline", extra=SHIFTS))
def mon4(spark, d):
    shifts = mo.mean_shift(mo.json_feature_means(log(spark, d)), baseline(spark))
    return mo.drift_alerts(shifts).select("feature", "mean_shift", "alert")


@query("mon4_performance_alerts", sql(f"""SELECT model_version, {rs('m')} AS mean_predicted_lgd, {rs('e')} AS mae,
  abs(m - CAST(0.2 AS DOUBLE)) / CAST(0.2 AS DOUBLE) > 0.1 AS mean_alert, e > CAST(0.1 AS DOUBLE) * 1.05 AS mae_alert FROM (
  SELECT model_version, avg(predicted_lgd) AS m, avg(abs(predicted_lgd - CAST(0.1 AS DOUBLE))) AS e FROM log
  GROUP BY model_version)""", "log"))
def mon4_performance(spark, d):
    current = log(spark, d).groupBy("model_version").agg(
        F.avg("predicted_lgd").alias("mean_predicted_lgd"), F.avg(F.abs(F.col("predicted_lgd") - 0.1)).alias("mae"))
    return rounded(mo.performance_alerts(current, 0.2, 0.1), ["mean_predicted_lgd", "mae"])


KS = ["orig_upb", "orig_ltv", "credit_score"]


def ks_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, max(abs(s - t)) AS ks FROM (
    SELECT sum(n_s) OVER (ORDER BY value) / CAST(sum(n_s) OVER () AS DOUBLE) AS s,
      sum(n_t) OVER (ORDER BY value) / CAST(sum(n_t) OVER () AS DOUBLE) AS t FROM (
      SELECT {c} AS value, count(*) FILTER (WHERE vintage_year >= 1999) AS n_s,
        count(*) FILTER (WHERE vintage_year < 1999) AS n_t FROM orig WHERE {c} IS NOT NULL GROUP BY {c}))"""


@query("mon5_ks_statistic", sql(f"SELECT feature, {rs('ks')} AS ks, ks > 0.1 AS alert FROM (" +
                                " UNION ALL ".join(map(ks_sql, KS)) + ")", "orig"))
def mon5(spark, d):
    loans = orig(spark, d)
    late = F.col("vintage_year") >= 1999
    return rounded(mo.ks_statistic(loans.where(late), loans.where(~late), KS), ["ks"])


def ranks_sql(name: str, condition: str) -> str:
    return f"""{name} AS (SELECT feature, row_number() OVER (ORDER BY round(avg(abs(attribution)), 6) DESC, feature) AS place
    FROM attributed a JOIN features f ON a.loan_seq_num = f.loan_seq_num WHERE {condition} GROUP BY feature)"""


MON6 = ATTRIBUTED + ",\n" + ranks_sql("old", "f.vintage_year <= 1997 AND feature <> 'orig_term'") + ",\n" + ranks_sql(
    "new", "f.vintage_year > 1997")


@query("mon6_rank_stability", sql("""SELECT coalesce(o.feature, n.feature) AS feature, CAST(o.place AS INTEGER) AS previous_rank,
  CAST(n.place AS INTEGER) AS current_rank, CAST(abs(o.place - n.place) AS INTEGER) AS rank_change,
  coalesce(abs(o.place - n.place) > 2, true) AS alert FROM old o FULL JOIN new n ON o.feature = n.feature
  WHERE o.place <= 3 OR n.place <= 3""", "features", extra=MON6))
def mon6(spark, d):
    loans = pin(features(spark, d))
    importance = lambda df: rounded(
        md.global_importance(attributions(df), None), ["mean_abs"]).withColumnRenamed("mean_abs", "importance")
    old = importance(loans.where(F.col("vintage_year") <= 1997)).where(F.col("feature") != "orig_term")
    return mo.rank_stability(old, importance(loans.where(F.col("vintage_year") > 1997)))


@query("mon7_summary_by_period", sql(f"""SELECT CAST(date_trunc('week', ts) AS DATE) AS period_start, count(*) AS n_predictions,
  round(avg(predicted_lgd), 6) AS mean_predicted_lgd, {PERIOD} AS period FROM log GROUP BY ALL""", "log"))
def mon7(spark, d):
    return mo.summary_by_period(log(spark, d), baseline(spark), "week")[0]


@query("mon7_shift_by_period", sql(f"""SELECT period_start, m.feature, {rs('serving_mean', 4)} AS serving_mean,
  {rs('abs(serving_mean - train_mean) / abs(train_mean)', 4)} AS mean_shift FROM (
    SELECT CAST(date_trunc('month', ts) AS DATE) AS period_start, feature, avg(value) AS serving_mean
    FROM numbers GROUP BY ALL) m JOIN baseline b ON m.feature = b.feature WHERE train_mean <> 0""",
    "log", "baseline", extra=NUMBERS))
def mon7_shift(spark, d):
    shifts = mo.summary_by_period(log(spark, d), baseline(spark), "month")[1]
    return rounded(shifts, ["serving_mean"], 4).select("period_start", "feature", "serving_mean", "mean_shift")


def daily(spark, d):
    """Daily partials of the log, refreshed after each of two appends that share days; the second append repeats rows."""
    entries = log(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    log_path, path = scratch_path(spark, "mon7-log"), scratch_path(spark, "mon7-days")
    even = F.pmod(F.xxhash64("prediction_id"), F.lit(2)) == 0
    for part in (entries.where(even), entries):
        pl.append_predictions(spark, log_path, part)
        dy.refresh(spark, log_path, path)
    return dy.read_partials(spark, path)


@query("mon7_merged_summary", sql(f"""SELECT CAST(date_trunc('quarter', ts) AS DATE) AS period_start, count(*) AS n_predictions,
  round(avg(predicted_lgd), 6) AS mean_predicted_lgd, {PERIOD} AS period FROM log GROUP BY ALL""", "log"))
def mon7_merged(spark, d):
    return dy.period_summary(daily(spark, d), "quarter")


@query("mon7_merged_shift", sql(f"""SELECT period_start, m.feature, {rs('serving_mean', 4)} AS serving_mean, n,
  {rs('abs(serving_mean - train_mean) / abs(train_mean)', 4)} AS mean_shift FROM (
    SELECT CAST(date_trunc('week', ts) AS DATE) AS period_start, feature, avg(value) AS serving_mean, count(*) AS n
    FROM numbers GROUP BY ALL) m JOIN baseline b ON m.feature = b.feature WHERE train_mean <> 0""",
    "log", "baseline", extra=NUMBERS))
def mon7_merged_shift(spark, d):
    shifts = mo.mean_shift(dy.period_means(daily(spark, d), "week"), baseline(spark))
    return rounded(shifts, ["serving_mean"], 4).select("period_start", "feature", "serving_mean", "n", "mean_shift")
