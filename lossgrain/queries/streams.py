"""Queries of the streaming operators, run to the end of the given events."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from lossgrain.queries.monitoring import NUMBERS
from lossgrain.queries.registry import query, rounded, rs
from lossgrain.queries.testbed import baseline, log, log_of, sql
from lossgrain.session import scratch_path
from lossgrain.sources import prediction_log as pl
from lossgrain.streaming import log as sl


def events_stream(spark, d, retries: bool = False):
    """The events table as a stream of log entries, optionally sent twice."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    if retries:
        source = source.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return log_of(source)


@query("x1_stream_log", sql("SELECT prediction_id, ts, predicted_lgd FROM log", "log"))
def x1(spark, d):
    stream = sl.stream_log(events_stream(spark, d, retries=True))
    path = sl.run_to_table(stream.select("prediction_id", "ts", "predicted_lgd"), "x1")
    written = spark.read.schema("prediction_id string, ts timestamp, predicted_lgd double").parquet(path)
    return written.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def window_sql(days: int, slide: int) -> str:
    """Start of every epoch-aligned window that holds ``ts``."""
    copies = ", ".join(str(i) for i in range(days // slide))
    return f"""SELECT *, to_timestamp((floor(epoch(ts) / ({slide} * 86400)) - i) * {slide} * 86400)::TIMESTAMPTZ
      AT TIME ZONE 'UTC' AS "start" FROM log, (SELECT unnest([{copies}]) AS i)"""


SUMMARY_COLUMNS = f"""count(*) AS n_predictions, {rs('avg(predicted_lgd)')} AS mean_predicted_lgd,
  min(ts) AS first_ts, max(ts) AS last_ts"""


def plain(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def run_summary(spark, d, label, window, slide=None):
    stream = sl.stream_summary(events_stream(spark, d), window, slide)
    path = sl.run_to_table(stream, label, "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
    table = sl.latest(spark, path, ["start", "end"], schema).drop("end")
    return rounded(plain(table, "start", "first_ts", "last_ts"), ["mean_predicted_lgd"])


@query("x2_stream_summary", sql(f'SELECT "start", {SUMMARY_COLUMNS} FROM ({window_sql(7, 7)}) GROUP BY "start"', "log"))
def x2(spark, d):
    return run_summary(spark, d, "x2", "7 days")


@query("x2_stream_summary_sliding", sql(f'SELECT "start", {SUMMARY_COLUMNS} FROM ({window_sql(10, 5)}) GROUP BY "start"', "log"))
def x2_sliding(spark, d):
    return run_summary(spark, d, "x2s", "10 days", "5 days")


@query("x3_stream_drift", sql(f"""SELECT "start", m.feature, {rs('serving_mean', 4)} AS serving_mean, n,
  {rs('abs(serving_mean - train_mean) / abs(train_mean)', 4)} AS mean_shift FROM (
    SELECT to_timestamp(floor(epoch(ts) / (30 * 86400)) * 30 * 86400)::TIMESTAMPTZ AT TIME ZONE 'UTC' AS "start", feature,
      avg(value) AS serving_mean, count(*) AS n FROM numbers GROUP BY ALL) m
  JOIN baseline b ON m.feature = b.feature WHERE train_mean <> 0""", "log", "baseline", extra=NUMBERS))
def x3(spark, d):
    stream = sl.stream_drift(events_stream(spark, d), baseline(spark))
    path = sl.run_to_table(stream, "x3", "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
    table = sl.latest(spark, path, ["start", "end", "feature"], schema)
    return rounded(plain(table, "start"), ["serving_mean"], 4).select("start", "feature", "serving_mean", "n", "mean_shift")


# --- several batches, restarts, late rows ---------------------------------

#: Days of the log fall into three parts; a tenth of the first part's rows come with the last one, behind the watermark.
PARTED = """span AS (SELECT CAST(min(ts) AS DATE) AS d0, (CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE)) // 3 AS third FROM log),
parted AS (SELECT log.*, CAST(ts AS DATE) - d0 < third AND CAST(prediction_id AS BIGINT) % 10 = 3 AS late FROM log, span),
kept AS (SELECT * EXCLUDE (late) FROM parted WHERE NOT late)"""


def log_parts(spark, d):
    entries = log(spark, d)
    first = entries.agg(F.to_date(F.min("ts")).alias("d0"), F.to_date(F.max("ts")).alias("d1")).first()
    third = (first.d1 - first.d0).days // 3
    day = F.date_diff(F.to_date("ts"), F.lit(first.d0))
    part = F.when(day < third, 0).when(day < 2 * third, 1).otherwise(2)
    held = (part == 0) & (F.col("prediction_id").cast("bigint") % 10 == 3)
    return [entries.where(F.when(held, 2).otherwise(part) == n) for n in range(3)]


def feed(spark, d, run):
    """Give ``run`` a stream of one part after another, each time as a new query."""
    source = scratch_path(spark, "source")
    for part in log_parts(spark, d):
        part.write.mode("append").parquet(source)
        run(spark.readStream.schema(part.schema).parquet(source))


def restarted(spark, d, label, stream, mode):
    """Table of a query that is stopped and started again between the parts."""
    place = scratch_path(spark, label)
    feed(spark, d, lambda source: sl.run_to_table(stream(source), label, mode, place))
    return place


@query("x1_restarted_log", sql("SELECT prediction_id, ts, predicted_lgd FROM kept", "log", extra=PARTED))
def x1_restarted(spark, d):
    columns = ["prediction_id", "ts", "predicted_lgd"]
    twice = F.explode(F.array(F.lit(1), F.lit(2)))
    path = restarted(spark, d, "x1r", lambda source: sl.stream_log(
        source.withColumn("_copy", twice).drop("_copy")).select(*columns), "append")
    return plain(spark.read.schema("prediction_id string, ts timestamp, predicted_lgd double").parquet(path), "ts")


@query("x1_late_rows", sql("SELECT prediction_id, ts, predicted_lgd, late FROM parted", "log", extra=PARTED))
def x1_late(spark, d):
    path = scratch_path(spark, "x1l")
    feed(spark, d, lambda source: sl.write_log(source, path))
    both = pl.read_predictions(spark, f"{path}/log").withColumn("late", F.lit(False)).unionByName(
        sl.late_rows(spark, path).withColumn("late", F.lit(True)))
    return plain(both.select("prediction_id", "ts", "predicted_lgd", "late"), "ts")


@query("x2_restarted_summary", sql(
    f'SELECT "start", {SUMMARY_COLUMNS} FROM ({window_sql(7, 7).replace("FROM log,", "FROM kept,")}) GROUP BY "start"', "log", extra=PARTED))
def x2_restarted(spark, d):
    schema = None

    def summary(source):
        nonlocal schema
        stream = sl.stream_summary(source, "7 days")
        schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
        return stream

    path = restarted(spark, d, "x2r", summary, "update")
    table = sl.latest(spark, path, ["start", "end"], schema).drop("end")
    return rounded(plain(table, "start", "first_ts", "last_ts"), ["mean_predicted_lgd"])


@query("x3_restarted_drift", sql(f"""SELECT "start", m.feature, {rs('serving_mean', 4)} AS serving_mean, n,
  {rs('abs(serving_mean - train_mean) / abs(train_mean)', 4)} AS mean_shift FROM (
    SELECT to_timestamp(floor(epoch(ts) / (7 * 86400)) * 7 * 86400)::TIMESTAMPTZ AT TIME ZONE 'UTC' AS "start", feature,
      avg(value) AS serving_mean, count(*) AS n FROM numbers GROUP BY ALL) m
  JOIN baseline b ON m.feature = b.feature WHERE train_mean <> 0""", "log", "baseline",
    extra=PARTED + ",\n" + NUMBERS.replace("FROM log)", "FROM kept)")))
def x3_restarted(spark, d):
    schema = None

    def drift(source):
        nonlocal schema
        stream = sl.stream_drift(source, baseline(spark), "7 days")
        schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
        return stream

    path = restarted(spark, d, "x3r", drift, "update")
    table = sl.latest(spark, path, ["start", "end", "feature"], schema)
    return rounded(plain(table, "start"), ["serving_mean"], 4).select("start", "feature", "serving_mean", "n", "mean_shift")
