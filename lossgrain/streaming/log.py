"""Streaming form of the prediction log and its drift summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lossgrain.operators.monitor import json_numbers
from lossgrain.session import pin, scratch_path
from lossgrain.sources import commits as cm
from lossgrain.sources import prediction_log as pl

EPOCH_WINDOW = "30 days"


def as_instant(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need an instant; a zone-free timestamp is read as such."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def stream_log(df: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Each prediction id once; state is dropped behind the watermark."""
    return as_instant(df).withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["prediction_id"])


def stream_summary(
    df: DataFrame, window: str = EPOCH_WINDOW, slide: str | None = None, watermark: str = "1 day"
) -> DataFrame:
    """Count, mean prediction and period per tumbling or sliding window."""
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (
        as_instant(df)
        .withWatermark("ts", watermark)
        .groupBy(span.alias("window"))
        .agg(
            F.count("*").alias("n_predictions"),
            F.avg("predicted_lgd").alias("mean_predicted_lgd"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .select("window.start", "window.end", "n_predictions", "mean_predicted_lgd", "first_ts", "last_ts")
    )


def stream_means(df: DataFrame, window: str = EPOCH_WINDOW, watermark: str = "1 day") -> DataFrame:
    """Mean of every logged numeric feature per window."""
    timed = as_instant(df).withWatermark("ts", watermark)
    return (
        json_numbers(timed, ["ts"])
        .groupBy(F.window("ts", window).alias("window"), "feature")
        .agg(F.avg("value").alias("serving_mean"), F.count("*").alias("n"))
        .select("window.start", "window.end", "feature", "serving_mean", "n")
    )


def stream_drift(
    df: DataFrame, baseline: DataFrame, window: str = EPOCH_WINDOW, watermark: str = "1 day"
) -> DataFrame:
    """Shift of each feature mean per window against a static baseline."""
    means = stream_means(df, window, watermark)
    known = baseline.where(F.col("train_mean") != 0)
    shift = F.abs(F.col("serving_mean") - F.col("train_mean")) / F.abs("train_mean")
    return means.join(known, "feature").withColumn("mean_shift", F.round(shift, 4))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer, spark: SparkSession) -> StreamingQuery:
    """Start with the state in RocksDB: on disk, in changed parts only, so that it may outgrow the memory of a task."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def run_to_table(stream: DataFrame, label: str, mode: str = "append", place: str | None = None) -> str:
    """Process everything available and leave the result as a table.

    Append output goes to a file sink. Revised rows of update mode are kept
    per micro-batch with its number, as files cannot be revised. Returns the
    path of the table. A run that is given the path of an earlier one goes on
    from its checkpoint: with its state, its watermark and what is new in the
    source.
    """
    spark = stream.sparkSession
    path = place or scratch_path(spark, label)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-state")
    writer = writer.trigger(availableNow=True)
    if mode == "append":
        writer = writer.format("parquet").option("path", path)
    else:
        def keep(batch: DataFrame, number: int) -> None:
            numbered = batch.withColumn("_batch", F.lit(number))
            numbered.write.mode("overwrite").parquet(f"{path}/_batch_no={number}")

        writer = writer.foreachBatch(keep)
    query = _start(writer, spark)
    query.awaitTermination()
    return path


SEEN_SCHEMA = "batch bigint, arrived bigint, late bigint, newest timestamp"


def write_log(stream: DataFrame, path: str, watermark: str = "1 day") -> None:
    """Process everything available into the prediction log at ``path``/log, with late rows kept apart in ``path``/late.

    A row is late if its time lies more than ``watermark`` before the newest
    time of the batches before its own. What arrived, how much of it was late
    and the newest time are observed while a batch is written and kept in
    ``path``/seen, so a restart goes on with the same bound. A batch that is
    processed again changes nothing: the log knows it by name, and its other
    rows are replaced.
    """
    spark = stream.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        bound = seen_batches(spark, path).where(F.col("batch") < number).agg(
            (F.max("newest") - F.expr(f"interval {watermark}")).alias("bound")).first()["bound"]
        late = F.coalesce(F.col("ts") < F.lit(bound), F.lit(False)) if bound else F.lit(False)
        seen = Observation()
        marked = pin(as_instant(batch).withColumn("_late", late).observe(
            seen, F.count("*").alias("arrived"), F.count_if("_late").alias("late"), F.max("ts").alias("newest")))
        marked.where("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        pl.append_predictions(spark, f"{path}/log", marked.where("not _late").drop("_late"), batch=f"batch {number}")
        found = seen.get
        spark.createDataFrame([(number, found["arrived"], found["late"], found["newest"])], SEEN_SCHEMA).write.mode(
            "overwrite").parquet(f"{path}/seen/no={number}")

    writer = stream.writeStream.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(take)
    _start(writer, spark).awaitTermination()


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/*") if cm.exists(spark, path) else spark.createDataFrame([], schema)


def seen_batches(spark: SparkSession, path: str) -> DataFrame:
    """Per batch: rows that arrived, late ones among them, newest time."""
    return _table(spark, f"{path}/seen", SEEN_SCHEMA)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late for the log."""
    return _table(spark, f"{path}/late", pl.LOG_SCHEMA)


def latest(spark: SparkSession, path: str, keys: list[str], schema) -> DataFrame:
    """The newest revision of every key from an update-mode table."""
    rows = spark.read.schema(schema).parquet(f"{path}/*")
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in values]).drop("_batch")
