"""Queries of feature construction, encoding and macro joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import month_of_period, tail_weight
from lossgrain.operators import features as ft
from lossgrain.operators import macro
from lossgrain.operators import resolve as rv
from lossgrain.operators import transform as tr
from lossgrain.queries.registry import query, r, rounded, rs
from lossgrain.queries.testbed import (
    DEFAULT_MONTH, REGION_SQL, cleaned, features, hist, hpi, month_sql, orig, rates, sql, with_macro,
)

Y = K.TARGET
CATEGORIES = ["property_type", "occupancy_status", "channel", "region"]


@query("p8_with_ltv_at_default", sql(f"SELECT loan_seq_num, {rs('ltv_at_default')} AS ltv_at_default FROM features", "features"))
def p8(spark, d):
    loans = ft.with_ltv_at_default(with_macro(spark, d, cleaned(spark, d)))
    return rounded(loans, ["ltv_at_default"]).select("loan_seq_num", "ltv_at_default")


@query("p9_with_region", sql(f"""SELECT loan_seq_num, {REGION_SQL} AS region, {REGION_SQL} AS state
  FROM (SELECT loan_seq_num, property_state AS state FROM orig)""", "orig"))
def p9(spark, d):
    loans = ft.with_region(tr.normalize_names(orig(spark, d)), replace_state=True)
    return loans.select("loan_seq_num", "region", "state")


@query("p10_with_modification_numeric", sql("""SELECT modification_flag, CASE WHEN modification_flag = 'Y' THEN 1 ELSE 0 END
  AS modification_flag_numeric, count(*) AS n FROM hist GROUP BY ALL""", "hist"))
def p10(spark, d):
    flagged = ft.with_modification_numeric(hist(spark, d))
    return flagged.groupBy("modification_flag", "modification_flag_numeric").agg(F.count("*").alias("n"))


@query("p11_with_default", sql("""SELECT loan_seq_num, CAST(0 AS DOUBLE) AS hpi_change,
  orig_interest_rate AS unemployment_rate_at_default, 3 AS months_delinquent_at_default FROM orig""", "orig"))
def p11(spark, d):
    loans = orig(spark, d).withColumn("unemployment_rate_at_default", F.col("orig_interest_rate"))
    return tr.with_placeholders(loans).select("loan_seq_num", *K.PLACEHOLDERS)


def dictionary_sql(source: str, columns: list[str]) -> str:
    return "dictionary AS (SELECT \"column\", value, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1 " \
        "AS INTEGER) AS code FROM (" + " UNION ".join(
            f"SELECT '{c}' AS \"column\", coalesce({c}, 'Unknown') AS value FROM {source}" for c in columns) + "))"


ORIG_CATEGORIES = ["property_type", "occupancy_status", "channel", "property_state"]


@query("p12_fit_encoder", sql("SELECT * FROM dictionary", "orig", extra=dictionary_sql("orig", ORIG_CATEGORIES)))
def p12(spark, d):
    return ft.fit_encoder(orig(spark, d), ORIG_CATEGORIES)


P13_FIT = "fitted AS (SELECT * FROM orig WHERE property_state <> 'TX' AND channel IS NOT NULL),\n"


@query("p13_apply_encoder", sql("SELECT o.loan_seq_num, " + ", ".join(
    f"coalesce((SELECT any_value(code) FROM dictionary WHERE \"column\" = '{c}' AND value = coalesce(o.{c}, 'Unknown')), "
    f"(SELECT CAST(count(*) AS INTEGER) FROM dictionary WHERE \"column\" = '{c}')) AS {c}" for c in ORIG_CATEGORIES)
    + " FROM orig o", "orig", extra=P13_FIT + dictionary_sql("fitted", ORIG_CATEGORIES)))
def p13(spark, d):
    loans = orig(spark, d)
    seen = loans.where((F.col("property_state") != "TX") & F.col("channel").isNotNull())
    dictionary = ft.fit_encoder(seen, ORIG_CATEGORIES)
    return ft.apply_encoder(loans, dictionary, ORIG_CATEGORIES, "next").select("loan_seq_num", *ORIG_CATEGORIES)


@query("p14_encode_serving", sql(f"""SELECT loan_seq_num,
  CASE property_type WHEN 'CO' THEN 0 WHEN 'CP' THEN 1 WHEN 'MH' THEN 2 WHEN 'PU' THEN 3 WHEN 'SF' THEN 4 ELSE 5 END AS property_type,
  CASE occupancy_status WHEN 'I' THEN 0 WHEN 'P' THEN 1 WHEN 'S' THEN 2 ELSE 3 END AS occupancy_status,
  CASE channel WHEN 'B' THEN 0 WHEN 'C' THEN 1 WHEN 'R' THEN 2 WHEN 'T' THEN 3 ELSE 4 END AS channel,
  CASE {REGION_SQL} WHEN 'Midwest' THEN 0 WHEN 'Northeast' THEN 1 WHEN 'Southeast' THEN 3 WHEN 'Southwest' THEN 4
    WHEN 'West' THEN 5 ELSE 2 END AS state
  FROM (SELECT *, property_state AS state FROM orig)""", "orig"))
def p14(spark, d):
    loans = ft.encode_serving(tr.normalize_names(orig(spark, d)))
    return loans.select("loan_seq_num", *K.CATEGORICAL_FEATURES)


def encoded(spark, d):
    """Model-ready loans: region as state, fixed codes for the categories."""
    return ft.encode_serving(features(spark, d))


@query("p15_feature_matrix", sql(f"""SELECT loan_seq_num, property_type, occupancy_status, channel, orig_ltv, orig_upb,
  orig_interest_rate, orig_term, {rs('ltv_at_default')} AS ltv_at_default, months_delinquent_at_default,
  {rs('hpi_change')} AS hpi_change, unemployment_rate_at_default, 0 AS not_there, {rs(Y)} AS {Y}, vintage_year
  FROM features""", "features"))
def p15(spark, d):
    columns = ["property_type", "occupancy_status", "channel", *K.NUMERIC_FEATURES, "not_there"]
    matrix = ft.feature_matrix(features(spark, d), columns, keep=["loan_seq_num"])
    return rounded(matrix, ["ltv_at_default", "hpi_change", Y])


@query("p16_sanitize", sql("""SELECT loan_seq_num, CASE WHEN key_number % 9 IN (0, 1) THEN CAST(0 AS DOUBLE)
  WHEN key_number % 9 = 2 THEN CAST('1.7976931348623157e308' AS DOUBLE)
  WHEN key_number % 9 = 3 THEN CAST('-1.7976931348623157e308' AS DOUBLE) ELSE orig_ltv END AS orig_ltv,
  CAST(0 AS DOUBLE) AS not_there FROM orig""", "orig"))
def p16(spark, d):
    ltv = F.col("orig_ltv")
    for k, v in {0: None, 1: float("nan"), 2: float("inf"), 3: float("-inf")}.items():
        ltv = F.when(F.col("key_number") % 9 == k, F.lit(v).cast("double")).otherwise(ltv)
    loans = orig(spark, d).withColumn("orig_ltv", ltv)
    return ft.sanitize(loans, ["orig_ltv", "not_there"]).select("loan_seq_num", "orig_ltv", "not_there")


SCALED = ["orig_ltv", "orig_upb", "orig_interest_rate", "constant"]


def scaled_sql(c: str) -> str:
    return f"""({c} - (SELECT avg({c}) FROM t)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM t)"""


P17 = "t AS (SELECT *, CAST(7.5 AS DOUBLE) AS constant FROM orig WHERE vintage_year <= 1999),\n" \
      "u AS (SELECT *, CAST(7.5 AS DOUBLE) AS constant FROM orig)"


@query("p17_scale", sql("SELECT loan_seq_num, " + ", ".join(f"{rs(scaled_sql(c), 5)} AS {c}" for c in SCALED)
                        + " FROM u", "orig", extra=P17))
def p17(spark, d):
    loans = orig(spark, d).withColumn("constant", F.lit(7.5))
    stats = ft.scaler_stats(loans.where(F.col("vintage_year") <= 1999), SCALED)
    return rounded(ft.scale(loans, stats, SCALED), SCALED, 5).select("loan_seq_num", *SCALED)


@query("a7_fit_scaler", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {rs(f'avg({c})', 3)} AS mean,
    {rs(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END', 3)} AS scale FROM t""" for c in SCALED),
    "orig", extra=P17))
def a7(spark, d):
    loans = orig(spark, d).withColumn("constant", F.lit(7.5)).where(F.col("vintage_year") <= 1999)
    return rounded(ft.scaler_stats(loans, SCALED), ["mean", "scale"], 3)


@query("p18_tail_weight", sql(f"""SELECT loan_seq_num, {rs(f'1 + CAST(2 AS DOUBLE) * pow(abs({Y} - CAST(0.5 AS DOUBLE)) * 2, 2)')}
  AS weight FROM target""", "target"))
def p18(spark, d):
    from lossgrain.queries.testbed import resolved

    target = rv.with_lgd(resolved(spark, d))
    return target.select("loan_seq_num", r(tail_weight(Y)).alias("weight"))


@query("p19_to_features_json", sql("""SELECT loan_seq_num, '{"property_type":"' || property_type || '","channel":'
  || CASE WHEN channel IS NULL THEN 'null' ELSE '"' || channel || '"' END || ',"orig_term":'
  || CAST(CAST(orig_loan_term AS INTEGER) AS VARCHAR) || '}' AS features_json FROM orig""", "orig"))
def p19(spark, d):
    loans = orig(spark, d).withColumn("orig_term", F.col("orig_loan_term").cast("int"))
    json = ft.features_json(["property_type", "channel", "orig_term"])
    return loans.select("loan_seq_num", json.alias("features_json"))


@query("p20_with_prediction_id", sql("""SELECT loan_seq_num, sha256('run-1|' || loan_seq_num) AS prediction_id FROM orig""", "orig"))
def p20(spark, d):
    return ft.with_prediction_id(orig(spark, d), ["loan_seq_num"], "run-1").select("loan_seq_num", "prediction_id")


@query("p21_format_predictions", sql("""SELECT loan_seq_num, round(orig_ltv / 333, 6) AS lgd,
  round(orig_ltv / 400, 6) AS ci_lower, round(orig_ltv / 300, 6) AS ci_upper, 'v1' AS model_version FROM orig""", "orig"))
def p21(spark, d):
    scored = orig(spark, d).select(
        "loan_seq_num", (F.col("orig_ltv") / 333).alias("lgd"),
        (F.col("orig_ltv") / 400).alias("lower"), (F.col("orig_ltv") / 300).alias("upper"))
    return ft.format_predictions(scored, "v1").select(
        "loan_seq_num", "lgd", F.col("confidence_interval_90.lower").alias("ci_lower"),
        F.col("confidence_interval_90.upper").alias("ci_upper"), "model_version")


@query("j2_join_hpi", sql(f"SELECT loan_seq_num, {rs('hpi_change')} AS hpi_change FROM with_macro", "with_macro"))
def j2(spark, d):
    loans = macro.join_hpi(cleaned(spark, d), hpi(spark, d))
    return rounded(loans, ["hpi_change"]).select("loan_seq_num", "hpi_change")


@query("j3_join_unemployment", sql("SELECT loan_seq_num, unemployment_rate_at_default FROM with_macro", "with_macro"))
def j3(spark, d):
    loans = macro.join_unemployment(cleaned(spark, d), rates(spark, d))
    return loans.select("loan_seq_num", "unemployment_rate_at_default")


J4 = f"""observed AS (SELECT state, CAST(month + k AS DATE) AS day, rate + day(CAST(month + k AS DATE)) AS rate
  FROM rates, (VALUES (4), (19)) AS t(k) WHERE month(month) % 4 = 1),
dated AS (SELECT *, CAST({DEFAULT_MONTH} + CAST(length(loan_seq_num) * 5 AS INTEGER) AS DATE) AS event FROM cleaned)"""


@query("j4_asof_macro", sql("""SELECT d.loan_seq_num, g.rate AS rate_asof FROM dated d
  ASOF LEFT JOIN observed g ON d.state = g.state AND d.event >= g.day""", "cleaned", "rates", extra=J4))
def j4(spark, d):
    """Events and observations inside months, none or several observations a month."""
    observed = rates(spark, d).where(F.month("month") % 4 == 1).select(
        "state", F.explode(F.array(F.date_add("month", 4), F.date_add("month", 19))).alias("day"),
        "rate").withColumn("rate", F.col("rate") + F.dayofmonth("day"))
    event = F.date_add(macro.default_month(), (F.length("loan_seq_num") * 5).cast("int"))
    loans = macro.asof_macro(cleaned(spark, d), observed, ["state"], event, "day")
    return loans.select("loan_seq_num", "rate_asof")


@query("j2_join_hpi_msa", sql(f"""SELECT c.loan_seq_num,
  {rs("coalesce(CASE WHEN h0.hpi <> 0 THEN h1.hpi / h0.hpi - 1 END, CAST(0 AS DOUBLE))")} AS hpi_change
  FROM (SELECT *, 'M' || CAST(customer % 40 AS VARCHAR) AS msa, CAST(strptime(first_payment_date, '%Y%m') AS DATE) AS m0,
    {DEFAULT_MONTH} AS m1 FROM cleaned) c
  LEFT JOIN areas h0 ON c.msa = h0.msa AND year(m0) = h0.year AND quarter(m0) = h0.quarter
  LEFT JOIN areas h1 ON c.msa = h1.msa AND year(m1) = h1.year AND quarter(m1) = h1.quarter""", "cleaned", extra="""areas AS (
  SELECT 'M' || CAST(l_suppkey % 37 AS VARCHAR) AS msa, CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(quarter(l_shipdate) AS INTEGER) AS quarter, round(avg(l_extendedprice), 2) AS hpi FROM lineitem GROUP BY ALL)"""))
def j2_msa(spark, d):
    """House prices by metropolitan area; some areas have none."""
    area = lambda c, n: F.concat(F.lit("M"), (F.col(c) % n).cast("string"))
    prices = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(
        area("l_suppkey", 37).alias("msa"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter"),
    ).agg(F.round(F.avg("l_extendedprice"), 2).alias("hpi"))
    loans = cleaned(spark, d).withColumn("msa", area("customer", 40))
    return rounded(macro.join_hpi(loans, prices, by="msa"), ["hpi_change"]).select("loan_seq_num", "hpi_change")


SCENARIO_SQL = "scenarios AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', {s}, CAST({u} AS DOUBLE), CAST({h} AS DOUBLE))" for n, s, u, h in K.SCENARIOS
) + ") AS s(scenario, severity, d_unemployment, d_hpi))"


@query("j6_cross_scenarios", sql(f"""SELECT loan_seq_num, scenario, severity,
  {rs('unemployment_rate_at_default + d_unemployment')} AS unemployment_rate_at_default,
  {rs('hpi_change + d_hpi')} AS hpi_change FROM with_macro CROSS JOIN scenarios""", "with_macro", extra=SCENARIO_SQL))
def j6(spark, d):
    loans = macro.cross_scenarios(with_macro(spark, d, cleaned(spark, d)))
    loans = rounded(loans, ["unemployment_rate_at_default", "hpi_change"])
    return loans.select("loan_seq_num", "scenario", "severity", "unemployment_rate_at_default", "hpi_change")
