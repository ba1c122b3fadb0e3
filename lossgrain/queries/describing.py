"""Queries of the descriptive operators.

Operators that read their input more than once get it as a written table, the
way a stage of the batch run would hand it over.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrain.operators import describe as ds
from lossgrain.operators import resolve as rv
from lossgrain.queries.registry import query, rounded, rs
from lossgrain.queries.testbed import cleaned, features, hist, orig, resolved, sql
from lossgrain.session import pin

Y = "loss_given_default"
MEDIAN = f"quantile_cont({Y}, 0.5)"


@query("a1_dedupe_first", sql("""SELECT loan_seq_num, min_by(zero_balance_removal_upb, position) AS first_upb,
  min_by(current_delinquency_status, position) AS first_status FROM hist GROUP BY loan_seq_num""", "hist"))
def a1(spark, d):
    order = [rv.fixed_order("monthly_reporting_period", F.col("position"))]
    columns = ["loan_seq_num", "zero_balance_removal_upb", "current_delinquency_status",
               "monthly_reporting_period", "position"]
    first = rv.dedupe_first(hist(spark, d).select(*columns), "loan_seq_num", order)
    return first.select("loan_seq_num", F.col("zero_balance_removal_upb").alias("first_upb"),
                        F.col("current_delinquency_status").alias("first_status"))


@query("a2_last_per_loan", sql("SELECT * FROM resolved", "resolved"))
def a2(spark, d):
    return resolved(spark, d)


@query("a3_lgd_summary", sql(f"""SELECT count({Y}) AS n, {rs(f'avg({Y})')} AS mean_lgd, {rs(MEDIAN)} AS median_lgd,
  {rs(f'100.0 * count(*) FILTER (WHERE {Y} = 0) / count(*)')} AS pct_zero,
  {rs(f'100.0 * count(*) FILTER (WHERE {Y} = 1) / count(*)')} AS pct_one FROM cleaned""", "cleaned"))
def a3(spark, d):
    return rounded(ds.lgd_summary(pin(cleaned(spark, d))), ["mean_lgd", "median_lgd", "pct_zero", "pct_one"])


A4 = [Y, "orig_ltv", "orig_upb", "orig_interest_rate", "orig_dti"]


@query("a4_describe", sql(" UNION ALL ".join(f"""SELECT '{c}' AS feature, count({c}) AS n, {rs(f'avg({c})', 4)} AS mean,
  {rs(f'stddev_samp({c})', 4)} AS std, {rs(f'min({c})', 4)} AS min, {rs(f'quantile_cont({c}, 0.25)', 4)} AS q25,
  {rs(f'quantile_cont({c}, 0.5)', 4)} AS q50, {rs(f'quantile_cont({c}, 0.75)', 4)} AS q75,
  {rs(f'max({c})', 4)} AS max FROM cleaned""" for c in A4), "cleaned"))
def a4(spark, d):
    return rounded(ds.describe(pin(cleaned(spark, d)), A4), ["mean", "std", "min", "q25", "q50", "q75", "max"], 4)


@query("a5_vintage_stats", sql(f"""SELECT vintage_year, count(*) AS n, {rs(f'avg({Y})')} AS mean_lgd,
  {rs(MEDIAN)} AS median_lgd FROM cleaned GROUP BY vintage_year""", "cleaned"))
def a5(spark, d):
    return rounded(ds.vintage_stats(pin(cleaned(spark, d))), ["mean_lgd", "median_lgd"])


@query("a6_segment_stats", sql(f"""SELECT channel, {rs(f'avg({Y})')} AS mean_lgd, count(*) AS n FROM cleaned
  WHERE channel IS NOT NULL GROUP BY channel""", "cleaned"))
def a6(spark, d):
    return rounded(ds.segment_stats(cleaned(spark, d), "channel"), ["mean_lgd"])


@query("a6_region_stats", sql(f"""SELECT region, {rs(f'avg({Y})')} AS mean_lgd, count(*) AS n,
  {rs(f'stddev_samp({Y})')} AS std_lgd FROM features GROUP BY region""", "features"))
def a6_region(spark, d):
    stats = ds.segment_stats(features(spark, d), "region", with_std=True, ascending=True)
    return rounded(stats, ["mean_lgd", "std_lgd"])


def clipped_sql(x: str, low: float, high: float) -> str:
    return (f"CASE WHEN {x} < {low} THEN CAST({low} AS DOUBLE) WHEN {x} > {high} "
            f"THEN CAST({high} AS DOUBLE) ELSE CAST({x} AS DOUBLE) END")


def edges_sql(values: str, bins: int) -> str:
    """Tables ``v`` (the values) and ``edges`` (each bin with its two limits)."""
    return f"""v AS ({values}),
edges AS (SELECT CAST(i AS INTEGER) AS bin, (i - 1) * w + lo AS low, CASE WHEN i = {bins} THEN hi ELSE i * w + lo END AS high
  FROM (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / CAST({bins} AS DOUBLE) AS w FROM v), range(1, {bins} + 1) AS r(i))"""


def histogram_sql(values: str, bins: int) -> str:
    """Left-closed bins by comparison with the edge table, for a column ``x`` of different values."""
    return f"""WITH {edges_sql(values, bins)} SELECT bin, {rs('low')} AS bin_low, count(*) AS n FROM v
    JOIN edges ON x >= low AND (x < high OR bin = {bins}) GROUP BY bin, low"""


@query("a9_binned_mean", sql(f"""SELECT bin, {rs('low')} AS bin_low, {rs('high')} AS bin_high, {rs('avg(y)')} AS mean_y,
  count(*) AS n FROM v JOIN edges ON x <= high AND (x > low OR bin = 1) GROUP BY bin, low, high""", "features",
    extra=edges_sql(f"""SELECT {clipped_sql('ltv_at_default', 0.0, 200.0)} AS x, {Y} AS y FROM features
    WHERE ltv_at_default IS NOT NULL""", 10)))
def a9(spark, d):
    return rounded(ds.binned_mean(pin(features(spark, d))), ["bin_low", "bin_high", "mean_y"])


@query("a10_histogram", sql(
    f"SELECT * FROM ({histogram_sql(f'SELECT {Y} AS x FROM cleaned WHERE {Y} IS NOT NULL', 50)})", "cleaned"))
def a10(spark, d):
    return rounded(ds.histogram(pin(cleaned(spark, d)), Y, 50), ["bin_low"])


@query("a10_histogram_of_hundredths", sql(
    f"SELECT * FROM ({histogram_sql(f'SELECT round({Y}, 2) AS x FROM cleaned WHERE {Y} IS NOT NULL', 50)})", "cleaned"))
def a10_hundredths(spark, d):
    """Losses of two decimals lie on the edges of their bins."""
    losses = cleaned(spark, d).select(F.round(Y, 2).alias(Y))
    return rounded(ds.histogram(pin(losses), Y, 50), ["bin_low"])


@query("a11_ecdf", sql(f"""SELECT {rs('value', 9)} AS value, n, {rs('(upto - n + 1) / CAST(total AS DOUBLE)', 9)} AS first_step,
  {rs('upto / CAST(total AS DOUBLE)', 9)} AS last_step FROM (
    SELECT value, n, sum(n) OVER (ORDER BY value) AS upto, sum(n) OVER () AS total FROM (
      SELECT {Y} AS value, count(*) AS n FROM cleaned WHERE {Y} IS NOT NULL GROUP BY {Y}))""", "cleaned"))
def a11(spark, d):
    return rounded(ds.ecdf(cleaned(spark, d)), ["value", "first_step", "last_step"], 9)


@query("a12_pct_underwater", sql(
    f"SELECT {rs('100.0 * count(*) FILTER (WHERE ltv_at_default > 100) / count(*)')} AS pct_underwater FROM features",
    "features"))
def a12(spark, d):
    return rounded(ds.pct_underwater(features(spark, d)), ["pct_underwater"])


A13 = ["orig_ltv", "orig_upb", "orig_interest_rate", "orig_term", "credit_score", "orig_dti", "ltv_at_default",
       "hpi_change", "unemployment_rate_at_default", "months_delinquent_at_default", "current_upb"]


def corr_sql(a: str, b: str) -> str:
    return rs(f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END")


@query("a13_corr_with_target", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {corr_sql(c, Y)} AS corr FROM features" for c in A13), "features"))
def a13(spark, d):
    return rounded(ds.corr_with_target(features(spark, d), A13), ["corr"])


A14 = ["orig_ltv", "orig_upb", "orig_interest_rate", "credit_score", "orig_dti", "ltv_at_default", "hpi_change", Y]


@query("a14_corr_matrix", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS row, '{b}' AS col, {corr_sql(a, b)} AS corr FROM features"
    for i, a in enumerate(A14) for b in A14[:i]), "features"))
def a14(spark, d):
    return rounded(ds.corr_matrix(features(spark, d), A14), ["corr"])


A15 = ["property_type", "occupancy_status", "channel", "property_state"]


@query("a15_category_profile", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_classes,
    array_to_string(list_sort(list(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL)), ',') AS classes FROM orig"""
    for c in A15), "orig"))
def a15(spark, d):
    profile = ds.category_profile(orig(spark, d), A15, lists=True)
    return profile.withColumn("classes", F.array_join("classes", ","))


@query("a16_months_delinquent", sql("SELECT * FROM delinquent", "delinquent"))
def a16(spark, d):
    return rv.months_delinquent(hist(spark, d))
