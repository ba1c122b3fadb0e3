"""The driver tables read as loan data, as DataFrames and as SQL views.

Each frame below has one SQL text of the same name; the two are written side
by side because the comparison depends on their agreement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrain.operators import features as ft
from lossgrain.operators import macro
from lossgrain.operators import resolve as rv
from lossgrain.operators import transform as tr

LOW, HIGH = 1996, 2000
STATES = ["CA", "TX", "NY", "FL", "IL", "OH", "WA", "GA", "PR", "AZ", "NJ", "NC", "MI",
          "PA", "VA", "CO", "NV", "OR", "TN", "MN", "OK", "LA", "DC", "MA", "KS"]
PROPERTY = {"BUILDING": "SF", "AUTOMOBILE": "CO", "MACHINERY": "MH", "HOUSEHOLD": "PU", "FURNITURE": "CP"}
OCCUPANCY = {"F": "P", "O": "I", "P": "S"}
CHANNEL = {"1": "R", "2": "B", "3": "C", "4": "T"}
RESOLUTION = {"RO": "02", "RF": "03", "AO": "06", "AF": "09", "NO": "01"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(key: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


def choose_sql(key: str, mapping: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def state_of(nation: str) -> Column:
    return F.element_at(F.array(*map(F.lit, STATES)), F.col(nation) + 1)


def state_sql(nation: str) -> str:
    return "([" + ", ".join(f"'{s}'" for s in STATES) + f"])[{nation} + 1]"


def period(ts: str) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("string")


def period_sql(ts: str) -> str:
    return f"CAST(year({ts}) * 100 + month({ts}) AS VARCHAR)"


def unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


# --- originations ---------------------------------------------------------

def orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        key.cast("string").alias("loan_seq_num"),
        key.alias("key_number"),
        F.col("o_custkey").alias("customer"),
        period("o_orderdate").alias("first_payment_date"),
        F.year("o_orderdate").alias("vintage_year"),
        F.col("o_totalprice").alias("orig_upb"),
        (50 + key % 71).cast("double").alias("orig_ltv"),
        unless(key % 11 == 0, (50 + key % 71 + key % 13).cast("double")).alias("orig_cltv"),
        (F.lit(3.0) + (F.col("o_custkey") % 500).cast("double") / 100.0).alias("orig_interest_rate"),
        F.when(key % 4 == 0, 180.0).otherwise(360.0).alias("orig_loan_term"),
        unless(key % 10 == 0, (580 + key % 240).cast("double")).alias("credit_score"),
        unless(key % 7 == 0, (15 + F.col("o_custkey") % 36).cast("double")).alias("orig_dti"),
        choose(F.col("c_mktsegment"), PROPERTY).alias("property_type"),
        choose(F.col("o_orderstatus"), OCCUPANCY).alias("occupancy_status"),
        choose(F.substring("o_orderpriority", 1, 1), CHANNEL).alias("channel"),
        state_of("c_nationkey").alias("property_state"),
    )


ORIG = f"""orig AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS loan_seq_num, o_orderkey AS key_number, o_custkey AS customer,
    {period_sql('o_orderdate')} AS first_payment_date,
    CAST(year(o_orderdate) AS INTEGER) AS vintage_year,
    o_totalprice AS orig_upb,
    CAST(50 + o_orderkey % 71 AS DOUBLE) AS orig_ltv,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(50 + o_orderkey % 71 + o_orderkey % 13 AS DOUBLE) END AS orig_cltv,
    CAST(3 AS DOUBLE) + CAST(o_custkey % 500 AS DOUBLE) / CAST(100 AS DOUBLE) AS orig_interest_rate,
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(180 AS DOUBLE) ELSE CAST(360 AS DOUBLE) END AS orig_loan_term,
    CASE WHEN o_orderkey % 10 <> 0 THEN CAST(580 + o_orderkey % 240 AS DOUBLE) END AS credit_score,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(15 + o_custkey % 36 AS DOUBLE) END AS orig_dti,
    {choose_sql('c_mktsegment', PROPERTY)} AS property_type,
    {choose_sql('o_orderstatus', OCCUPANCY)} AS occupancy_status,
    {choose_sql('substr(o_orderpriority, 1, 1)', CHANNEL)} AS channel,
    {state_sql('c_nationkey')} AS property_state
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


# --- monthly histories ----------------------------------------------------

HISTORY_VALUES = [
    "monthly_reporting_period", "zero_balance_code", "zero_balance_effective_date",
    "zero_balance_removal_upb", "net_sale_proceeds", "expenses", "mi_recoveries", "actual_loss",
    "current_upb", "current_delinquency_status", "modification_flag",
]


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    code = choose(F.concat("l_returnflag", "l_linestatus"), RESOLUTION)
    status = F.when(F.col("l_linenumber") == 7, "XX").otherwise(F.col("l_linenumber").cast("string"))
    flag = F.when(F.col("l_linenumber") == 5, None).when(F.col("l_linenumber") % 3 == 0, "Y").otherwise("N")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("loan_seq_num"),
        unless(F.col("l_partkey") % 97 == 0, period("l_shipdate")).alias("monthly_reporting_period"),
        code.alias("zero_balance_code"),
        unless(F.col("l_partkey") % 19 == 0, period("l_shipdate")).alias("zero_balance_effective_date"),
        F.when(F.col("l_quantity") == 50, 0.0).otherwise(price).alias("zero_balance_removal_upb"),
        unless(F.col("l_linenumber") % 7 == 0, price * (F.col("l_quantity") / 50.0)).alias("net_sale_proceeds"),
        unless(F.col("l_partkey") % 5 == 0, price * F.col("l_tax") * 5.0).alias("expenses"),
        unless(F.col("l_suppkey") % 6 == 0, price * F.col("l_discount")).alias("mi_recoveries"),
        unless(F.col("l_suppkey") % 9 == 0, price * 0.25).alias("actual_loss"),
        F.when(code.isin("02", "03", "06", "09"), 0.0).otherwise(price).alias("current_upb"),
        status.alias("current_delinquency_status"),
        flag.alias("modification_flag"),
        # Ship day, line and part tell the rows of an order apart, so the further fields of the SQL's position
        # never decide. 43 bits: 13, 4 and 26.
        ((F.date_diff("l_shipdate", F.lit("1990-01-01").cast("date")).cast("long") * 16 + F.col("l_linenumber"))
         * (1 << 26) + F.col("l_partkey")).alias("position"),
    )


HIST = f"""hist AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_seq_num,
    CASE WHEN l_partkey % 97 <> 0 THEN {period_sql('l_shipdate')} END AS monthly_reporting_period,
    {choose_sql('(l_returnflag || l_linestatus)', RESOLUTION)} AS zero_balance_code,
    CASE WHEN l_partkey % 19 <> 0 THEN {period_sql('l_shipdate')} END AS zero_balance_effective_date,
    CASE WHEN l_quantity = 50 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS zero_balance_removal_upb,
    CASE WHEN l_linenumber % 7 <> 0 THEN l_extendedprice * (l_quantity / CAST(50 AS DOUBLE)) END AS net_sale_proceeds,
    CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice * l_tax * CAST(5 AS DOUBLE) END AS expenses,
    CASE WHEN l_suppkey % 6 <> 0 THEN l_extendedprice * l_discount END AS mi_recoveries,
    CASE WHEN l_suppkey % 9 <> 0 THEN l_extendedprice * CAST(0.25 AS DOUBLE) END AS actual_loss,
    CASE WHEN l_returnflag IN ('R', 'A') THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS current_upb,
    CASE WHEN l_linenumber = 7 THEN 'XX' ELSE CAST(l_linenumber AS VARCHAR) END AS current_delinquency_status,
    CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber % 3 = 0 THEN 'Y' ELSE 'N' END AS modification_flag,
    row(coalesce(CASE WHEN l_partkey % 97 <> 0 THEN {period_sql('l_shipdate')} END, '999999'),
        l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS position
  FROM lineitem)"""


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [rv.fixed_order("monthly_reporting_period", F.col("position"))]
    return rv.last_per_loan(rv.filter_defaults(hist(spark, sf_dir)), order=order, columns=HISTORY_VALUES)


RESOLVED = "resolved AS (\n  SELECT loan_seq_num,\n    " + ",\n    ".join(
    f"max_by({c}, position) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in HISTORY_VALUES
) + "\n  FROM hist WHERE zero_balance_code IN ('02', '03', '06', '09') GROUP BY loan_seq_num)"


LGD_SQL = """CASE WHEN raw IS NULL THEN NULL WHEN raw < 0 THEN CAST(0 AS DOUBLE)
      WHEN raw > 1 THEN CAST(1 AS DOUBLE) ELSE raw END"""
TARGET = f"""target AS (
  SELECT * EXCLUDE (raw), {LGD_SQL} AS loss_given_default
  FROM (SELECT *, (zero_balance_removal_upb - coalesce(net_sale_proceeds, 0) + coalesce(expenses, 0)
      - coalesce(mi_recoveries, 0)) / zero_balance_removal_upb AS raw
    FROM resolved WHERE zero_balance_removal_upb > 0))"""


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = rv.with_lgd(tr.fill_const(resolved(spark, sf_dir)))
    return rv.merge_and_clean(target, rv.filter_vintage(orig(spark, sf_dir), LOW, HIGH))


CLEANED = f"""cleaned AS (
  SELECT t.* EXCLUDE (modification_flag), coalesce(t.modification_flag, 'N') AS modification_flag,
    o.* EXCLUDE (loan_seq_num, property_state, orig_loan_term),
    o.property_state AS state, o.orig_loan_term AS orig_term
  FROM target t JOIN orig o ON t.loan_seq_num = o.loan_seq_num
  WHERE o.vintage_year BETWEEN {LOW} AND {HIGH} AND t.loss_given_default IS NOT NULL)"""


# --- macro series ---------------------------------------------------------

def hpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .groupBy(
            state_of("s_nationkey").alias("state"),
            F.year("l_shipdate").alias("year"),
            F.quarter("l_shipdate").alias("quarter"),
        )
        .agg(F.round(F.avg("l_extendedprice"), 2).alias("hpi"))
    )


HPI = f"""hpi AS (
  SELECT {state_sql('s_nationkey')} AS state, CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(quarter(l_shipdate) AS INTEGER) AS quarter, round(avg(l_extendedprice), 2) AS hpi
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    month = F.make_date(F.year("l_shipdate"), F.month("l_shipdate"), F.lit(1))
    return (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .groupBy(state_of("s_nationkey").alias("state"), month.alias("month"))
        .agg(F.round(F.avg("l_discount") * 100, 4).alias("rate"))
    )


RATES = f"""rates AS (
  SELECT {state_sql('s_nationkey')} AS state, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
    round(avg(l_discount) * 100, 4) AS rate
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""


def month_sql(text: str) -> str:
    return f"CAST(strptime({text}, '%Y%m') AS DATE)"


DEFAULT_MONTH = month_sql("coalesce(zero_balance_effective_date, monthly_reporting_period)")

# --- features -------------------------------------------------------------

DELINQUENT = """delinquent AS (
  SELECT h.loan_seq_num, CAST(greatest(count(*) FILTER (
      WHERE try_cast(h.current_delinquency_status AS DOUBLE) >= 3
        AND h.monthly_reporting_period < e.resolution), 3) AS INTEGER) AS months_delinquent_at_default
  FROM hist h JOIN (SELECT loan_seq_num, max(coalesce(monthly_reporting_period, '999999')) AS resolution
    FROM hist WHERE zero_balance_code IN ('02', '03', '06', '09') GROUP BY loan_seq_num) e
    ON h.loan_seq_num = e.loan_seq_num
  GROUP BY h.loan_seq_num)"""

REGION_SQL = """CASE WHEN state IN ('CT','ME','MA','NH','RI','VT','NJ','NY','PA') THEN 'Northeast'
      WHEN state IN ('DE','FL','GA','MD','NC','SC','VA','WV','AL','KY','MS','TN','AR','LA') THEN 'Southeast'
      WHEN state IN ('IL','IN','MI','OH','WI','IA','KS','MN','MO','NE','ND','SD') THEN 'Midwest'
      WHEN state IN ('AZ','NM','OK','TX') THEN 'Southwest'
      WHEN state IN ('AK','CA','CO','HI','ID','MT','NV','OR','UT','WA','WY','DC') THEN 'West'
      ELSE 'Other' END"""


def with_macro(spark: SparkSession, sf_dir: str, loans: DataFrame) -> DataFrame:
    loans = macro.join_hpi(loans, hpi(spark, sf_dir))
    return macro.join_unemployment(loans, rates(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned loans with every feature; ``state`` still the raw code."""
    loans = with_macro(spark, sf_dir, cleaned(spark, sf_dir))
    late = rv.months_delinquent(hist(spark, sf_dir))
    loans = loans.join(late, "loan_seq_num", "left").withColumn(
        "months_delinquent_at_default", F.coalesce("months_delinquent_at_default", F.lit(3))
    )
    loans = ft.with_ltv_at_default(loans)
    return ft.with_modification_numeric(ft.with_region(loans))


WITH_MACRO = f"""with_macro AS (
  SELECT c.*, coalesce(CASE WHEN h0.hpi <> 0 THEN h1.hpi / h0.hpi - 1 END, CAST(0 AS DOUBLE)) AS hpi_change,
    coalesce(u.rate, CAST(7.5 AS DOUBLE)) AS unemployment_rate_at_default
  FROM (SELECT *, {month_sql('first_payment_date')} AS m0, {DEFAULT_MONTH} AS m1 FROM cleaned) c
  LEFT JOIN hpi h0 ON c.state = h0.state AND year(m0) = h0.year AND quarter(m0) = h0.quarter
  LEFT JOIN hpi h1 ON c.state = h1.state AND year(m1) = h1.year AND quarter(m1) = h1.quarter
  LEFT JOIN rates u ON c.state = u.state AND u.month = m1)"""

LTV_SQL = """orig_upb / (greatest(CASE WHEN orig_ltv <> 0 THEN orig_ltv END, CAST(1 AS DOUBLE)) / CAST(100 AS DOUBLE))
      * (CAST(1 AS DOUBLE) + coalesce(hpi_change, 0))"""

FEATURES = f"""features AS (
  SELECT * EXCLUDE (ratio), CASE WHEN ratio > 300 THEN CAST(300 AS DOUBLE) ELSE ratio END AS ltv_at_default
  FROM (SELECT m.*, coalesce(d.months_delinquent_at_default, 3) AS months_delinquent_at_default,
      {REGION_SQL} AS region,
      CASE WHEN modification_flag = 'Y' THEN 1 ELSE 0 END AS modification_flag_numeric,
      zero_balance_removal_upb / nullif({LTV_SQL}, 0) * CAST(100 AS DOUBLE) AS ratio
    FROM with_macro m LEFT JOIN delinquent d ON m.loan_seq_num = d.loan_seq_num))"""


# --- prediction log -------------------------------------------------------

def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_of(table(spark, sf_dir, "events"))


def log_of(e: DataFrame) -> DataFrame:
    payload = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"),
        F.lit(', "orig_ltv": '), (50 + F.col("user_id") % 71).cast("string"),
        F.lit(', "hpi_change": -0.'), (10 + F.col("event_id") % 80).cast("string"),
        F.lit(', "modified": '), F.when(F.col("event_id") % 3 == 0, "true").otherwise("false"),
        F.lit(', "state": "CA", "gap": null}'),
    )
    return e.select(
        F.col("event_id").cast("string").alias("prediction_id"),
        "ts",
        F.when(F.col("event_id") % 50 == 0, "no json").when(F.col("event_id") % 50 == 1, "[1, 2]")
        .otherwise(payload).alias("features_json"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("predicted_lgd"),
        F.col("event_type").alias("model_version"),
    )


LOG = """log AS (
  SELECT CAST(event_id AS VARCHAR) AS prediction_id, ts,
    CASE WHEN event_id % 50 = 0 THEN 'no json' WHEN event_id % 50 = 1 THEN '[1, 2]' ELSE
      substr(props, 1, length(props) - 1) || ', "orig_ltv": ' || CAST(50 + user_id % 71 AS VARCHAR)
      || ', "hpi_change": -0.' || CAST(10 + event_id % 80 AS VARCHAR)
      || ', "modified": ' || CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END
      || ', "state": "CA", "gap": null}' END AS features_json,
    least(value / CAST(500 AS DOUBLE), CAST(1 AS DOUBLE)) AS predicted_lgd, event_type AS model_version
  FROM events)"""

BASELINE = {"k": 45.0, "orig_ltv": 78.5, "hpi_change": -0.05, "unused": 3.0, "modified": 0.0}


def baseline(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BASELINE.items()), "feature string, train_mean double")


BASELINE_SQL = "baseline AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', CAST({v} AS DOUBLE))" for k, v in BASELINE.items()
) + ") AS b(feature, train_mean))"

VIEWS = {
    "orig": (ORIG, []),
    "hist": (HIST, []),
    "resolved": (RESOLVED, ["hist"]),
    "target": (TARGET, ["resolved"]),
    "cleaned": (CLEANED, ["target", "orig"]),
    "hpi": (HPI, []),
    "rates": (RATES, []),
    "delinquent": (DELINQUENT, ["hist"]),
    "with_macro": (WITH_MACRO, ["cleaned", "hpi", "rates"]),
    "features": (FEATURES, ["with_macro", "delinquent"]),
    "log": (LOG, []),
    "baseline": (BASELINE_SQL, []),
}


def sql(body: str, *views: str, extra: str = "") -> str:
    """``body`` behind the views it needs and their own needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in VIEWS[name][1]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        add(name)
    parts = [VIEWS[name][0] for name in ordered] + ([extra] if extra else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
