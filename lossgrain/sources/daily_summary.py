"""Daily partial aggregates of the prediction log, from which any longer period is merged.

A row stands for the values of one day, one feature and one *cell* (a narrow
range of values): their number, sum, smallest and largest, and the span of
their times. All of these merge, so the mean, the count and the quantiles of
a month or quarter come from the rows of its days, and the log is not read
again. The prediction itself is the feature ``PREDICTION``.

The table follows the commits of the log: a refresh reads the rows of the
appends that came since the last one, and its own commit records how far it
got. A refresh that is repeated, or runs twice at once, counts nothing twice;
late rows of an earlier day are further rows of that day.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lossgrain.operators.monitor import json_numbers
from lossgrain.operators.order_stats import number_cell
from lossgrain.sources import commits as cm
from lossgrain.sources import prediction_log as pl

PARTIALS_SCHEMA = (
    "day date, feature string, cell bigint, n bigint, n_values bigint, total double, "
    "low double, high double, first_ts timestamp, last_ts timestamp"
)
PREDICTION = "(prediction)"
#: Cells of a power of two; a quantile is off by less than this part of its value.
CELLS = 128
ATTEMPTS = 100


def day_partials(log: DataFrame) -> DataFrame:
    """Partial aggregates of log rows: the prediction, and every numeric feature of the logged JSON."""
    dated = log.withColumn("day", F.to_date("ts"))
    predictions = dated.select("day", "ts", F.lit(PREDICTION).alias("feature"), F.col("predicted_lgd").alias("value"))
    features = json_numbers(dated, ["day", "ts"]).select("day", "ts", "feature", "value")
    return _merge(predictions.unionByName(features).withColumns({
        "cell": number_cell("value", CELLS), "n": F.lit(1).cast("long"),
        "n_values": F.col("value").isNotNull().cast("long"), "total": F.col("value"), "low": F.col("value"),
        "high": F.col("value"), "first_ts": F.col("ts"), "last_ts": F.col("ts")}), ["day"])


def _merge(partials: DataFrame, by: Sequence[str]) -> DataFrame:
    return partials.groupBy(*by, "feature", "cell").agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all refreshes; several of them may add to one day, feature and cell."""
    places = [f"{path}/data/{c.token}" for c in cm.commits(spark, path)]
    return spark.read.schema(PARTIALS_SCHEMA).parquet(*places) if places else spark.createDataFrame([], PARTIALS_SCHEMA)


def summarised(spark: SparkSession, path: str) -> int:
    """Number of the log's last commit that is in the table."""
    return max((int(c.note) for c in cm.commits(spark, path)), default=0)


def pending(spark: SparkSession, log_path: str, path: str) -> tuple[list[str], int]:
    """Folders of the log's appends that are not in the table yet, and the number of the last of them."""
    done = summarised(spark, path)
    found = cm.commits(spark, log_path, done) if done else cm.commits(spark, log_path)
    # A rewrite of the log holds rows that were appended before; only a table that begins with it reads it.
    added = [c for c in found if not (c.base and done)]
    return [f"{log_path}/data/token={c.token}" for c in added], max((c.version for c in found), default=done)


def refresh(spark: SparkSession, log_path: str, path: str) -> int | None:
    """Add the log's new appends; returns the number of the last one, None if there were none."""
    for _ in range(ATTEMPTS):
        version = cm.latest(spark, path) + 1
        folders, upto = pending(spark, log_path, path)
        if upto == summarised(spark, path):
            return None
        token = uuid.uuid4().hex
        day_partials(pl.appended(spark, log_path, folders)).write.parquet(f"{path}/data/{token}")
        if cm.claim(spark, path, version, token, note=str(upto)):
            return upto
        cm.delete(spark, f"{path}/data/{token}")
    raise RuntimeError(f"other writers committed first {ATTEMPTS} times: {path}")


def compact_summary(spark: SparkSession, path: str) -> int | None:
    """Merge the refreshes into one; None if another writer committed meanwhile or there are none."""
    found = cm.commits(spark, path)
    if not found:
        return None
    token, version = uuid.uuid4().hex, found[-1].version + 1
    _merge(read_partials(spark, path), ["day"]).write.parquet(f"{path}/data/{token}")
    if cm.claim(spark, path, version, token, base=True, note=str(max(int(c.note) for c in found))):
        return version
    cm.delete(spark, f"{path}/data/{token}")
    return None


# --- longer periods -------------------------------------------------------

def by_period(partials: DataFrame, unit: str = "month") -> DataFrame:
    """Partials of each month, quarter, week or year, merged from its days."""
    start = F.date_trunc(unit, F.col("day")).cast("date")
    return _merge(partials.withColumn("period_start", start), ["period_start"])


def period_summary(partials: DataFrame, unit: str = "month") -> DataFrame:
    """Count, mean prediction and span of every period, as ``prediction_summary`` has them."""
    text = [F.date_format(f(c), "yyyy-MM-dd HH:mm:ss") for f, c in ((F.min, "first_ts"), (F.max, "last_ts"))]
    return by_period(partials.where(F.col("feature") == PREDICTION), unit).groupBy("period_start").agg(
        F.sum("n").alias("n_predictions"),
        F.round(F.try_divide(F.sum("total"), F.sum("n_values")), 6).alias("mean_predicted_lgd"),
        F.concat(text[0], F.lit(" to "), text[1]).alias("period"))


def period_means(partials: DataFrame, unit: str = "month") -> DataFrame:
    """Mean of every feature in every period, as ``json_feature_means`` has them."""
    return by_period(partials.where(F.col("feature") != PREDICTION), unit).groupBy("period_start", "feature").agg(
        F.try_divide(F.sum("total"), F.sum("n_values")).alias("serving_mean"), F.sum("n").alias("n"))


def period_quantiles(partials: DataFrame, probabilities: Sequence[float], unit: str = "month") -> DataFrame:
    """Quantiles of every feature in every period, off by less than a cell: ``period_start, feature, n, q``.

    The wanted rank lies in one cell; its place there is taken between the
    smallest and largest value of the cell.
    """
    cells = by_period(partials.where("cell is not null"), unit)
    ordered = Window.partitionBy("period_start", "feature").orderBy("cell")
    upto = F.sum("n_values").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("n_values").over(Window.partitionBy("period_start", "feature"))
    placed = cells.withColumns({"upto": upto, "whole": whole})

    def within(p: float) -> Column:
        rank = F.lit(float(p)) * (F.col("whole") - 1).cast("double")
        begins = F.col("upto") - F.col("n_values")
        share = F.coalesce(F.try_divide(rank - begins, F.col("n_values") - 1), F.lit(0.0))
        value = F.col("low") + (F.col("high") - F.col("low")) * F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
        return F.max(F.when((F.floor(rank) >= begins) & (F.floor(rank) < F.col("upto")), value))

    return placed.groupBy("period_start", "feature").agg(
        F.max("whole").alias("n"), F.array(*[within(p) for p in probabilities]).alias("q"))
