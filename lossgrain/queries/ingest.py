"""Queries of sources, quality checks, ingestion transforms and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrain import constants as K
from lossgrain.operators import quality as qa
from lossgrain.operators import resolve as rv
from lossgrain.operators import transform as tr
from lossgrain.queries.registry import query, r, rounded, rs
from lossgrain.queries.testbed import (
    CHANNEL, HIGH, LOW, PROPERTY, REGION_SQL, choose_sql, cleaned, hist, log, orig, rates, resolved,
    sql, table,
)
from lossgrain.session import scratch_path
from lossgrain.sources import prediction_log as pl
from lossgrain.sources import stage as st
from lossgrain.sources import text as tx

Y = K.TARGET

# --- sources --------------------------------------------------------------

RAW_TOKENS = {0: "NA", 1: "", 2: "NULL", 3: "nan"}


def raw_origination(spark, d):
    """Originations in the full 32-column text layout, some tokens missing."""
    o = orig(spark, d)
    score = F.coalesce(F.col("credit_score").cast("int").cast("string"), F.lit("9999"))
    token = F.element_at(F.array(*[F.lit(t) for t in RAW_TOKENS.values()]), (F.col("key_number") % 4 + 1).cast("int"))
    o = o.withColumn("credit_score", F.when(F.col("key_number") % 10 == 3, token).otherwise(score))
    o = o.withColumn("postal_code", F.concat(F.lit("0"), (F.col("key_number") % 9000 + 1000).cast("string")))
    return o.withColumns({c: F.lit(None).cast("string") for c in K.ORIGINATION_COLUMNS if c not in o.columns})


def write_origination(spark, d, label):
    """Text files on the shared folder, named like the published ones."""
    path = scratch_path(spark, label)
    tx.write_delimited(raw_origination(spark, d), K.ORIGINATION_COLUMNS, path)
    return path


ORIG_TEXT = """SELECT loan_seq_num, CASE WHEN key_number % 10 = 3 THEN NULL
  ELSE coalesce(CAST(CAST(credit_score AS INTEGER) AS VARCHAR), '9999') END AS credit_score,
  first_payment_date, property_state, property_type, occupancy_status, channel,
  '0' || CAST(key_number % 9000 + 1000 AS VARCHAR) AS postal_code FROM orig"""
S1_COLUMNS = ["loan_seq_num", "credit_score", "first_payment_date", "property_state", "property_type",
              "occupancy_status", "channel", "postal_code"]


@query("s1_read_delimited", sql(ORIG_TEXT, "orig"))
def s1(spark, d):
    path = write_origination(spark, d, "s1")
    return tx.read_delimited(spark, path, K.ORIGINATION_COLUMNS, "part-*.txt").select(*S1_COLUMNS)


@query("s2_discover", "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, true AS found, "
                      "CAST(0 AS BIGINT) AS n_missing_dir FROM orders JOIN customer ON o_custkey = c_custkey")
def s2(spark, d):
    path = write_origination(spark, d, "s2")
    files = tx.discover(spark, path, "part-*.txt")
    missing = tx.read_delimited(spark, f"{path}/absent", K.ORIGINATION_COLUMNS, "part-*.txt")
    rows = tx.read_delimited(spark, path, K.ORIGINATION_COLUMNS, "part-*.txt")
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("loan_seq_num").alias("n_keys")).withColumns({
        "found": files.agg(F.count("*") > 0).scalar(),
        "n_missing_dir": missing.agg(F.count("*")).scalar(),
    })


@query("s3_split_rejects", """SELECT l_linestatus AS kind,
  count(*) FILTER (WHERE l_orderkey % 13 <> 5) AS kept, count(*) FILTER (WHERE l_orderkey % 13 = 5) AS rejected,
  count(*) FILTER (WHERE l_orderkey % 13 <> 5 AND l_orderkey % 13 <> 4) AS with_last_field
  FROM lineitem GROUP BY l_linestatus""")
def s3(spark, d):
    li = table(spark, d, "lineitem")
    line = F.concat_ws("|", F.col("l_orderkey").cast("string"), "l_linestatus", "l_returnflag")
    line = F.when(F.col("l_orderkey") % 13 == 5, F.concat(line, F.lit("|x|y"))).when(
        F.col("l_orderkey") % 13 == 4, F.concat_ws("|", F.col("l_orderkey").cast("string"), "l_linestatus")
    ).otherwise(line)
    path = scratch_path(spark, "s3")
    li.select(line.alias("value")).write.text(path)
    rows = tx.read_lines(spark, path, ["key", "kind", "flag"], "part-*.txt")
    good, bad = tx.split_rejects(rows, 3)
    kept = good.groupBy("kind").agg(F.count("*").alias("kept"), F.count("flag").alias("with_last_field"))
    lost = bad.groupBy(F.split("line", "\\|")[1].alias("kind")).agg(F.count("*").alias("rejected"))
    return kept.join(lost, "kind")


@query("s4_stage", sql(f"""SELECT vintage_year, count(*) AS n, {rs('sum(orig_upb)', 2)} AS upb FROM orig
  WHERE vintage_year BETWEEN {LOW} AND {HIGH} GROUP BY vintage_year""", "orig"))
def s4(spark, d):
    path = scratch_path(spark, "s4")
    st.stage(orig(spark, d), path, "vintage_year")
    staged = rv.filter_vintage(st.load_stage(spark, path), LOW, HIGH)
    return rounded(staged.groupBy("vintage_year").agg(F.count("*").alias("n"), F.sum("orig_upb").alias("upb")),
                   ["upb"], 2)


@query("s5_load_stage", sql("SELECT loan_seq_num, first_payment_date, orig_ltv FROM orig", "orig"))
def s5(spark, d):
    path = scratch_path(spark, "s5")
    st.stage(orig(spark, d), path)
    return st.load_stage(spark, path).select("loan_seq_num", "first_payment_date", "orig_ltv")


@query("s6_read_macro_csv", sql("SELECT state, month, rate FROM rates", "rates"))
def s6(spark, d):
    path = scratch_path(spark, "s6")
    rates(spark, d).write.option("header", True).csv(path)
    return st.read_macro_csv(spark, path, "state string, month date, rate double")


S7_NEW = """incoming AS (
  SELECT prediction_id, ts, predicted_lgd FROM log WHERE CAST(prediction_id AS BIGINT) % 2 = 1
  UNION ALL SELECT prediction_id, ts + INTERVAL 1 HOUR, predicted_lgd / CAST(2 AS DOUBLE) FROM log)"""


@query("s7_append_predictions", sql("""SELECT prediction_id, ts, predicted_lgd FROM log
  WHERE CAST(prediction_id AS BIGINT) % 3 = 0
UNION ALL SELECT prediction_id, min(ts), min_by(predicted_lgd, ts) FROM incoming
  WHERE CAST(prediction_id AS BIGINT) % 3 <> 0 GROUP BY prediction_id""", "log", extra=S7_NEW))
def s7(spark, d):
    entries = log(spark, d)
    number = F.col("prediction_id").cast("bigint")
    retried = entries.withColumn("ts", F.col("ts") + F.expr("interval 1 hour")).withColumn(
        "predicted_lgd", F.col("predicted_lgd") / 2.0)
    path = scratch_path(spark, "s7")
    as_written = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp"))
    pl.append_predictions(spark, path, as_written(entries.where(number % 3 == 0)))
    pl.append_predictions(spark, path, as_written(entries.where(number % 2 == 1).unionByName(retried)))
    logged = pl.read_predictions(spark, path)
    return logged.select("prediction_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "predicted_lgd")


@query("s7_compacted_log", sql("""SELECT prediction_id, ts, predicted_lgd FROM log
  WHERE CAST(ts AS DATE) >= (SELECT min(CAST(ts AS DATE)) + INTERVAL 1 DAY FROM log)""", "log"))
def s7_compacted(spark, d):
    """The log by the hash of its ids in three named batches, one of them sent twice, compacted, from its second day on."""
    entries = log(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    path, part = scratch_path(spark, "s7c"), F.pmod(F.xxhash64("prediction_id"), F.lit(3))
    for n in (0, 1, 2, 1):
        pl.append_predictions(spark, path, entries.where(part == n), batch=f"part {n}")
    pl.compact_log(spark, path)
    first = entries.agg(F.date_format(F.min("ts") + F.expr("interval 1 day"), "yyyy-MM-dd")).first()[0]
    logged = pl.read_predictions(spark, path, days=(first, "9999"))
    return logged.select("prediction_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "predicted_lgd")


@query("s8_read_predictions", sql("SELECT prediction_id, features_json, predicted_lgd, model_version FROM log", "log"))
def s8(spark, d):
    path = scratch_path(spark, "s8")
    pl.append_predictions(spark, path, log(spark, d).withColumn("ts", F.col("ts").cast("timestamp")))
    return pl.read_predictions(spark, path).drop("ts")


S9 = ["orig_ltv", "orig_upb", "orig_interest_rate", "orig_term"]


@query("s9_training_means", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rs(f'avg({c})', 4)} AS train_mean FROM cleaned" for c in S9), "cleaned"))
def s9(spark, d):
    path = scratch_path(spark, "s9")
    st.save_training_means(cleaned(spark, d), S9, path)
    return rounded(st.load_training_means(spark, path), ["train_mean"], 4)


# --- quality --------------------------------------------------------------

@query("q1_require_columns", sql("SELECT loan_seq_num, zero_balance_code FROM hist", "hist"))
def q1(spark, d):
    history = qa.require_columns(hist(spark, d), K.REQUIRED_PERFORMANCE)
    return history.select("loan_seq_num", "zero_balance_code")


@query("q2_check_null_keys", sql("""SELECT count(*) FILTER (WHERE monthly_reporting_period IS NULL) AS null_keys
  FROM hist""", "hist"))
def q2(spark, d):
    return qa.null_keys(qa.check_null_keys(hist(spark, d), "loan_seq_num"), "monthly_reporting_period")


@query("q3_count_duplicate_keys", sql(
    "SELECT count(*) - count(DISTINCT loan_seq_num) AS duplicate_keys FROM hist", "hist"))
def q3(spark, d):
    return qa.count_duplicate_keys(hist(spark, d), "loan_seq_num")


@query("q4_key_profile", sql(
    "SELECT count(*) AS n_rows, count(DISTINCT loan_seq_num) AS n_keys FROM hist", "hist"))
def q4(spark, d):
    return qa.key_profile(hist(spark, d), "loan_seq_num")


def requests(spark, d):
    """Scoring requests with faults of every kind."""
    key = F.col("key_number")
    return orig(spark, d).select(
        "loan_seq_num",
        "customer",
        F.when(key % 23 != 0, F.col("orig_ltv") + F.when(key % 37 == 0, 150.0).otherwise(0.0)).alias("orig_ltv"),
        F.when(key % 17 == 0, -F.col("orig_upb")).otherwise(F.col("orig_upb")).alias("orig_upb"),
        "orig_interest_rate",
        F.col("orig_loan_term").alias("orig_term"),
        (F.col("orig_ltv") * 1.2).alias("ltv_at_default"),
        (key % 125).cast("int").alias("months_delinquent_at_default"),
        ((key % 90).cast("double") / 10.0 - 1.0).alias("hpi_change"),
        (key % 52).cast("double").alias("unemployment_rate_at_default"),
        F.when(key % 19 == 0, "XX").otherwise(F.col("property_type")).alias("property_type"),
        "occupancy_status",
        "channel",
        F.when(key % 29 == 0, "CAL").otherwise(F.col("property_state")).alias("state"),
    )


REQUESTS = """requests AS (
  SELECT loan_seq_num, customer,
    CASE WHEN key_number % 23 <> 0 THEN orig_ltv + CASE WHEN key_number % 37 = 0 THEN 150 ELSE 0 END END AS orig_ltv,
    CASE WHEN key_number % 17 = 0 THEN -orig_upb ELSE orig_upb END AS orig_upb,
    orig_interest_rate, orig_loan_term AS orig_term, orig_ltv * CAST(1.2 AS DOUBLE) AS ltv_at_default,
    key_number % 125 AS months_delinquent_at_default,
    CAST(key_number % 90 AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(1 AS DOUBLE) AS hpi_change,
    CAST(key_number % 52 AS DOUBLE) AS unemployment_rate_at_default,
    CASE WHEN key_number % 19 = 0 THEN 'XX' ELSE property_type END AS property_type, occupancy_status, channel,
    CASE WHEN key_number % 29 = 0 THEN 'CAL' ELSE property_state END AS state
  FROM orig),
checked AS (SELECT *, concat_ws(',',
    CASE WHEN channel IS NULL OR channel NOT IN ('R','B','C','T') THEN 'channel' END,
    CASE WHEN hpi_change NOT BETWEEN -1 AND 5 THEN 'hpi_change' END,
    CASE WHEN ltv_at_default NOT BETWEEN 0 AND 300 THEN 'ltv_at_default' END,
    CASE WHEN months_delinquent_at_default NOT BETWEEN 1 AND 120 THEN 'months_delinquent_at_default' END,
    CASE WHEN occupancy_status NOT IN ('P','S','I') THEN 'occupancy_status' END,
    CASE WHEN orig_interest_rate NOT BETWEEN 0 AND 30 THEN 'orig_interest_rate' END,
    CASE WHEN orig_ltv IS NULL OR orig_ltv NOT BETWEEN 0 AND 200 THEN 'orig_ltv' END,
    CASE WHEN orig_term NOT BETWEEN 60 AND 480 THEN 'orig_term' END,
    CASE WHEN orig_upb <= 0 THEN 'orig_upb' END,
    CASE WHEN property_type NOT IN ('SF','CO','CP','MH','PU') THEN 'property_type' END,
    CASE WHEN length(state) <> 2 THEN 'state' END,
    CASE WHEN unemployment_rate_at_default NOT BETWEEN 0 AND 50 THEN 'unemployment_rate_at_default' END
  ) AS violations FROM requests)"""


@query("q5_validate_rows", sql("SELECT loan_seq_num, violations FROM checked", "orig", extra=REQUESTS))
def q5(spark, d):
    valid, rejected = qa.validate_rows(requests(spark, d))
    rejected = rejected.select("loan_seq_num", F.array_join("violations", ",").alias("violations"))
    return valid.select("loan_seq_num", F.lit("").alias("violations")).unionByName(rejected)


Q6 = REQUESTS + """,
verdicts AS (SELECT customer, count(*) AS n_loans, count(*) FILTER (WHERE violations <> '') AS n_invalid
  FROM checked GROUP BY customer)"""


@query("q6_batch_verdicts", sql("""SELECT customer, n_loans, n_invalid, n_loans <= 1000 AND n_invalid = 0 AS accepted
  FROM verdicts""", "orig", extra=Q6))
def q6(spark, d):
    return qa.batch_verdicts(requests(spark, d), "customer")


@query("q6_validate_batches", sql("""SELECT c.customer, c.loan_seq_num FROM checked c JOIN verdicts v
  ON c.customer = v.customer WHERE v.n_loans <= 1000 AND v.n_invalid = 0""", "orig", extra=Q6))
def q6_rows(spark, d):
    return qa.validate_batches(requests(spark, d), "customer").select("customer", "loan_seq_num")


Q7 = ["loan_seq_num", "orig_cltv", "credit_score", "orig_dti", "channel", "monthly_reporting_period",
      "zero_balance_effective_date", "net_sale_proceeds", "expenses", "mi_recoveries", "actual_loss"]


@query("q7_null_rates", sql("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {rs(f'count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE)')} AS null_rate,
    count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE) > 0.05 AS flagged FROM cleaned"""
    for c in Q7) + ") WHERE null_rate > 0", "cleaned"))
def q7(spark, d):
    return rounded(qa.null_rates(cleaned(spark, d).select(*Q7)), ["null_rate"])


@query("q8_imputation_audit", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_filled, {rs(f'quantile_cont({c}, 0.5)')} AS fill_value
    FROM orig WHERE vintage_year BETWEEN {LOW} AND {HIGH}""" for c in K.MEDIAN_FILL), "orig"))
def q8(spark, d):
    audit = tr.imputation_audit(rv.filter_vintage(orig(spark, d), LOW, HIGH))
    return audit.withColumn("fill_value", r(F.col("fill_value").cast("double")))


@query("q8_dropped_rows", sql("""SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE NOT coalesce(zero_balance_removal_upb > 0, false)) AS dropped_by_upb,
  count(*) FILTER (WHERE zero_balance_removal_upb > 0 AND actual_loss IS NULL) AS dropped_by_target FROM resolved""", "resolved"))
def q8_dropped(spark, d):
    return qa.dropped_rows(resolved(spark, d), target=F.col("actual_loss"))


# --- transforms -----------------------------------------------------------

P1_TEXT = {0: "unknown", 1: "", 2: "20x001", 3: " 199803 "}


@query("p1_with_vintage_year", sql("""SELECT loan_seq_num, CAST(floor(CASE WHEN key_number % 50 IN (0, 1, 2) THEN NULL
  WHEN key_number % 50 = 3 THEN 199803 ELSE CAST(first_payment_date AS DOUBLE) END / 100) AS INTEGER) AS vintage_year
  FROM orig""", "orig"))
def p1(spark, d):
    text = F.col("first_payment_date")
    for k, v in P1_TEXT.items():
        text = F.when(F.col("key_number") % 50 == k, v).otherwise(text)
    loans = orig(spark, d).drop("vintage_year").withColumn("first_payment_date", text)
    return tr.with_vintage_year(loans).select("loan_seq_num", "vintage_year")


@query("p2_cast_numeric", sql("""SELECT loan_seq_num, orig_upb,
  CASE key_number % 12 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL
    WHEN 4 THEN CAST(1500 AS DOUBLE) ELSE orig_ltv END AS orig_ltv FROM orig""", "orig"))
def p2(spark, d):
    ltv = F.col("orig_ltv").cast("string")
    for k, v in {0: "12d", 1: "n/a", 2: "  ", 3: "nan", 4: "1.5e3"}.items():
        ltv = F.when(F.col("key_number") % 12 == k, v).otherwise(ltv)
    ltv = F.concat(F.lit(" "), ltv)
    raw = orig(spark, d).select("loan_seq_num", F.col("orig_upb").cast("string").alias("orig_upb"), ltv.alias("orig_ltv"))
    return tr.cast_numeric(raw, K.ORIGINATION_NUMERIC)


@query("p3_fill_zero", sql("""SELECT loan_seq_num, coalesce(expenses, 0) AS expenses,
  coalesce(mi_recoveries, 0) AS mi_recoveries, net_sale_proceeds FROM hist""", "hist"))
def p3(spark, d):
    return tr.fill_zero(hist(spark, d)).select("loan_seq_num", "expenses", "mi_recoveries", "net_sale_proceeds")


@query("p4_fill_median", sql("SELECT loan_seq_num, " + ", ".join(
    f"{rs(f'coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM orig))')} AS {c}" for c in K.MEDIAN_FILL)
    + " FROM orig", "orig"))
def p4(spark, d):
    return rounded(tr.fill_median(orig(spark, d)), K.MEDIAN_FILL).select("loan_seq_num", *K.MEDIAN_FILL)


@query("p5_fill_const", sql("""SELECT modification_flag, count(*) AS n FROM (
  SELECT coalesce(modification_flag, 'N') AS modification_flag FROM hist) GROUP BY modification_flag""", "hist"))
def p5(spark, d):
    return tr.fill_const(hist(spark, d)).groupBy("modification_flag").agg(F.count("*").alias("n"))


@query("p6_normalize_names", sql("""SELECT loan_seq_num, property_state AS state, orig_loan_term AS orig_term
  FROM orig""", "orig"))
def p6(spark, d):
    return tr.normalize_names(orig(spark, d)).select("loan_seq_num", "state", "orig_term")


@query("p7_with_lgd", sql(f"SELECT loan_seq_num, {rs(Y)} AS {Y} FROM target", "target"))
def p7(spark, d):
    return rounded(rv.with_lgd(resolved(spark, d)), [Y]).select("loan_seq_num", Y)


@query("p7_with_lgd_fallback", sql(f"""SELECT loan_seq_num, {rs('''CASE WHEN raw < 0 THEN 0 WHEN raw > 1 THEN 1
  ELSE raw END''')} AS {Y} FROM (SELECT loan_seq_num, coalesce(actual_loss, 0) / zero_balance_removal_upb AS raw
  FROM resolved WHERE zero_balance_removal_upb > 0)""", "resolved"))
def p7_fallback(spark, d):
    return rounded(rv.with_lgd(resolved(spark, d).drop("expenses")), [Y]).select("loan_seq_num", Y)


@query("p22_null_sentinels", sql("""SELECT loan_seq_num, nullif(CASE WHEN key_number % 10 = 0 THEN 9999
  ELSE credit_score END, 9999) AS credit_score FROM orig""", "orig"))
def p22(spark, d):
    loans = orig(spark, d).fillna(9999.0, ["credit_score"])
    return tr.null_sentinels(loans).select("loan_seq_num", "credit_score")


# --- filters --------------------------------------------------------------

@query("f1_filter_vintage", sql(f"SELECT loan_seq_num, vintage_year FROM orig WHERE vintage_year BETWEEN {LOW} AND {HIGH}", "orig"))
def f1(spark, d):
    return rv.filter_vintage(orig(spark, d), LOW, HIGH).select("loan_seq_num", "vintage_year")


@query("f2_filter_defaults", sql("""SELECT zero_balance_code, count(*) AS n FROM hist
  WHERE zero_balance_code IN ('02', '03', '06', '09') GROUP BY zero_balance_code""", "hist"))
def f2(spark, d):
    return rv.filter_defaults(hist(spark, d)).groupBy("zero_balance_code").agg(F.count("*").alias("n"))


@query("f3_drop_null_target", sql("SELECT loan_seq_num, actual_loss FROM resolved WHERE actual_loss IS NOT NULL", "resolved"))
def f3(spark, d):
    return rv.drop_null_target(resolved(spark, d), "actual_loss").select("loan_seq_num", "actual_loss")


@query("f4_sample_fraction", sql("""SELECT loan_seq_num, count(*) AS n FROM hist
  WHERE '0' || substr(md5(loan_seq_num || ':42'), 1, 8) < '019999999' GROUP BY loan_seq_num""", "hist"))
def f4(spark, d):
    return rv.sample_fraction(hist(spark, d), "loan_seq_num", 0.1).groupBy("loan_seq_num").agg(F.count("*").alias("n"))


@query("j1_join_loans", sql(f"""SELECT loan_seq_num, state, orig_term, vintage_year, {rs(Y)} AS {Y} FROM cleaned""", "cleaned"))
def j1(spark, d):
    return rounded(cleaned(spark, d), [Y]).select("loan_seq_num", "state", "orig_term", "vintage_year", Y)
