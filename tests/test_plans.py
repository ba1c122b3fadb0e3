"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from lossgrain.operators import macro
from lossgrain.operators import order_stats as os_
from lossgrain.operators import resolve as rv
from lossgrain.queries import testbed as tb
from lossgrain.session import pin

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cleaned(spark):
    return pin(tb.cleaned(spark, SMALL))


def test_keys_are_reduced_before_the_shuffle(spark):
    history = tb.hist(spark, SMALL)
    for df in (rv.last_per_loan(history, columns=["expenses"]),
               rv.dedupe_first(history.select("loan_seq_num", "expenses"), "loan_seq_num", [F.col("expenses")])):
        text = plan(df)
        assert "partial_m" in text and text.count("Exchange hashpartitioning") == 1 and "Window" not in text


def test_fixed_width_orders_take_hash_aggregates(spark):
    history = tb.hist(spark, SMALL).where("monthly_reporting_period is not null")
    order = [rv.fixed_order("monthly_reporting_period", F.col("position"))]
    numbers = ["zero_balance_removal_upb", "net_sale_proceeds", "expenses", "mi_recoveries", "actual_loss"]
    for df in (rv.last_per_loan(history, order=order, columns=numbers),
               rv.dedupe_first(history.select("loan_seq_num", "expenses", "position"), "loan_seq_num", ["position"])):
        text = plan(df)
        assert text.count("HashAggregate(key") == 2 and "Sort" not in text


def test_filters_and_columns_reach_the_scan(spark, cleaned):
    text = plan(rv.filter_vintage(cleaned, 1997, 1998).select("loan_seq_num"))
    assert "PushedFilters: [IsNotNull(vintage_year), GreaterThanOrEqual(vintage_year,1997)" in text
    assert "ReadSchema: struct<loan_seq_num:string,vintage_year:int>" in text


def test_join_uses_the_partitioning_of_the_aggregate(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        perf = tb.resolved(spark, SMALL).select("loan_seq_num", "expenses")
        orig = spark.read.parquet(f"{SMALL}/orders.parquet").select(
            F.col("o_orderkey").cast("string").alias("loan_seq_num"), "o_totalprice")
        assert plan(rv.join_loans(perf, orig)).count("Exchange hashpartitioning(loan_seq_num") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_late_months_take_one_shuffle(spark):
    text = plan(rv.months_delinquent(tb.hist(spark, SMALL)))
    assert text.count("Exchange hashpartitioning") == 1


def test_scenarios_join_nothing(spark, cleaned):
    loans = cleaned.withColumns({"hpi_change": F.lit(0.0), "unemployment_rate_at_default": F.lit(5.0)})
    text = plan(macro.cross_scenarios(loans))
    assert "Join" not in text and "Exchange" not in text and "Product" not in text


def test_quantile_rows_are_cut_to_the_wanted_cells(spark, cleaned):
    text = plan(os_.quantiles(cleaned, "loss_given_default", [0.5]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "percentile" not in text
