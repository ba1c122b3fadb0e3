"""House-price and unemployment series, as-of lookups and scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import month_of_period
from lossgrain.operators.lookup import BROADCAST_BYTES, attach, lookup_join, measured


def default_month(
    effective: str = "zero_balance_effective_date", reported: str = "monthly_reporting_period"
) -> Column:
    """Month of default: the effective date, else the reporting period."""
    return F.coalesce(month_of_period(effective), month_of_period(reported))


def join_hpi(
    loans: DataFrame,
    hpi: DataFrame,
    origination: Column | None = None,
    default: Column | None = None,
    bound: int = BROADCAST_BYTES,
    by: str = "state",
) -> DataFrame:
    """Index change between two quarters of an area; 0 where one is missing.

    ``hpi`` has one row per ``by, year, quarter`` with the index ``hpi``;
    ``by`` is a column of both sides, ``state`` or ``msa``.
    """
    origination = month_of_period("first_payment_date") if origination is None else origination
    default = default_month() if default is None else default
    dated = loans.withColumns({"_from": origination, "_to": default})
    table, small = measured(hpi, bound)
    for side in ("from", "to"):
        keys = {f"_y_{side}": F.year(f"_{side}"), f"_q_{side}": F.quarter(f"_{side}")}
        points = table.select(
            by,
            F.col("year").alias(f"_y_{side}"),
            F.col("quarter").alias(f"_q_{side}"),
            F.col("hpi").alias(f"_hpi_{side}"),
        )
        dated = attach(dated.withColumns(keys), points, [by, *keys], small=small)
    change = F.try_divide(F.col("_hpi_to"), F.col("_hpi_from")) - F.lit(1.0)
    return dated.withColumn("hpi_change", F.coalesce(change, F.lit(0.0))).select(
        *[c for c in loans.columns if c != "hpi_change"], "hpi_change"
    )


def join_unemployment(
    loans: DataFrame,
    rates: DataFrame,
    default: Column | None = None,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rate of the state in the month of default, 7.5 where missing.

    ``rates`` has one row per ``state, month`` (first day) with ``rate``.
    """
    default = default_month() if default is None else default
    points = rates.select("state", F.col("month").alias("_month"), F.col("rate").alias("_rate"))
    joined = lookup_join(loans.withColumn("_month", default), points, ["state", "_month"], "left", bound)
    name = "unemployment_rate_at_default"
    fallback = F.lit(K.PLACEHOLDERS[name])
    return joined.withColumn(name, F.coalesce(F.col("_rate"), fallback)).select(
        *[c for c in loans.columns if c != name], name
    )


def observations_by_month(series: DataFrame, by: Sequence[str], date: str, value: str) -> tuple[DataFrame, DataFrame]:
    """The series per month, and its newest observations.

    A month has its own observations in order and the last one before it, so
    an event of the month finds its value without other months. Missing dates
    and values are no observations; of several at one date the largest holds.
    """
    by = list(by)
    points = (
        series.select(*by, F.col(date).cast("date").alias("_date"), F.col(value).alias("_value"))
        .where(F.col("_date").isNotNull() & F.col("_value").isNotNull())
        .groupBy(*by, "_date").agg(F.max("_value").alias("_value"))
        .withColumn("_next", F.lead("_date").over(Window.partitionBy(*by).orderBy("_date")))
    )
    until = F.trunc(F.coalesce(F.date_sub("_next", 1), F.col("_date")), "month")
    held = points.withColumn(
        "_month", F.explode(F.sequence(F.trunc("_date", "month"), until, F.expr("interval 1 month"))))
    months = held.groupBy(*by, "_month").agg(
        F.sort_array(F.collect_list(F.struct("_date", "_value"))).alias("_seen"))
    newest = points.where(F.col("_next").isNull()).select(
        *by, F.col("_date").alias("_end"), F.col("_value").alias("_end_value"))
    return months, newest


def asof_macro(
    loans: DataFrame,
    series: DataFrame,
    by: Sequence[str],
    event: Column,
    date: str = "month",
    value: str = "rate",
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """Newest observation at or before the event's day, null if none.

    The series is laid out by month, which makes the as-of question an
    equality lookup; the days are compared inside the row that was found. No
    observation after the event is used, and no pair of loan and observation
    other than the month's own is ever formed.
    """
    by = list(by)
    months, newest = observations_by_month(series, by, date, value)
    months, small = measured(months, bound)
    newest, few = measured(newest, bound)
    dated = loans.withColumn("_event", event.cast("date")).withColumn("_month", F.trunc("_event", "month"))
    found = attach(attach(dated, months, [*by, "_month"], small=small), newest, by, small=few)
    before = F.filter("_seen", lambda o: o["_date"] <= F.col("_event"))
    at = F.when(F.col("_event") >= F.col("_end"), F.col("_end_value")).otherwise(
        F.try_element_at(before, F.lit(-1))["_value"])
    return found.withColumn(f"{value}_asof", at).select(*loans.columns, f"{value}_asof")


def cross_scenarios(
    loans: DataFrame,
    scenarios: Sequence[tuple[str, int, float, float]] = tuple(K.SCENARIOS),
) -> DataFrame:
    """Each loan once per scenario, with the shocks added to its macro features.

    The scenarios are literals, so every loan is repeated where it lies and
    nothing is joined.
    """
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("scenario"),
            F.lit(severity).alias("severity"),
            F.lit(float(jobs)).alias("_unemployment"),
            F.lit(float(prices)).alias("_hpi"),
        )
        for name, severity, jobs, prices in scenarios
    ])
    return (
        loans.select("*", F.inline(rows))
        .withColumn(
            "unemployment_rate_at_default",
            F.col("unemployment_rate_at_default") + F.col("_unemployment"),
        )
        .withColumn("hpi_change", F.col("hpi_change") + F.col("_hpi"))
        .drop("_unemployment", "_hpi")
    )
