"""Summaries and drift of the prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrain import constants as K
from lossgrain.operators.order_stats import with_running_counts


def prediction_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean prediction and period; nulls for an empty log."""
    text = [F.date_format(f("ts"), "yyyy-MM-dd HH:mm:ss") for f in (F.min, F.max)]
    period = F.concat(text[0], F.lit(" to "), text[1])
    columns = [
        F.count("*").alias("n_predictions"),
        F.round(F.avg("predicted_lgd"), 6).alias("mean_predicted_lgd"),
        period.alias("period"),
    ]
    return log.groupBy(*by).agg(*columns) if by else log.agg(*columns)


def json_numbers(log: DataFrame, keep: Sequence[str] = (), column: str = "features_json") -> DataFrame:
    """One row per numeric entry of each JSON object: ``feature, value``.

    Booleans count as 1 and 0. Text, null and nested entries give no row, nor
    does a text that is not a JSON object.
    """
    parsed = log.select(*keep, F.try_parse_json(column).alias("_v"))
    # Arrays are exploded too, but without a key.
    entries = parsed.lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("_v").outer())
    ).where(F.col("key").isNotNull())
    kind = F.schema_of_variant("value")
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
    return entries.where(numeric).select(
        *keep,
        F.col("key").alias("feature"),
        F.try_variant_get("value", "$", "double").alias("value"),
    )


def json_feature_means(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric feature found in the logged JSON."""
    return (
        json_numbers(log, by)
        .groupBy(*by, "feature")
        .agg(F.avg("value").alias("serving_mean"), F.count("*").alias("n"))
    )


def rounded_means(means: DataFrame) -> DataFrame:
    return means.withColumn("serving_mean", F.round("serving_mean", 4))


def drift_join(serving: DataFrame, baseline: DataFrame) -> DataFrame:
    """Serving and training mean of the features that have both, mean not 0."""
    return serving.join(baseline.where(F.col("train_mean") != 0), "feature")


def mean_shift(means: DataFrame, baseline: DataFrame) -> DataFrame:
    """Relative shift of each served feature mean from its training mean."""
    shift = F.abs(F.col("serving_mean") - F.col("train_mean")) / F.abs("train_mean")
    return drift_join(means, baseline).withColumn("mean_shift", F.round(shift, 4))


def drift_alerts(shifts: DataFrame, threshold: float = K.DRIFT_THRESHOLD) -> DataFrame:
    return shifts.withColumn("alert", F.col("mean_shift") > threshold)


def performance_alerts(
    current: DataFrame,
    training_mean_lgd: float,
    test_mae: float,
    mean_threshold: float = K.DRIFT_THRESHOLD,
    mae_threshold: float = K.MAE_DEGRADATION,
) -> DataFrame:
    """Flags for a moved mean prediction and a worse MAE.

    ``current`` has ``mean_predicted_lgd`` and ``mae`` per row.
    """
    moved = F.abs(F.col("mean_predicted_lgd") - training_mean_lgd) / abs(training_mean_lgd)
    return current.withColumns({
        "mean_alert": moved > mean_threshold,
        "mae_alert": F.col("mae") > test_mae * (1.0 + mae_threshold),
    })


def ks_statistic(
    serving: DataFrame, training: DataFrame, features: Sequence[str],
    threshold: float = K.DRIFT_THRESHOLD,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature, exact.

    Both samples are collapsed to counts per value; the two running counts
    come from cells of values, never from one sort of a whole sample.
    """
    def long(df: DataFrame, tag: str) -> DataFrame:
        pairs = F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features
        ])
        return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).withColumn("_s", F.lit(tag))

    both = long(serving, "serving").unionByName(long(training, "training"))
    per_sample = [F.count_if(F.col("_s") == tag) for tag in ("serving", "training")]
    counts = both.groupBy("feature", "value").agg(
        per_sample[0].alias("n_s"), per_sample[1].alias("n_t")
    )
    running = with_running_counts(counts, "value", ["feature"], ["n_s", "n_t"])

    def reached(n: str) -> Column:
        return F.try_divide(F.col(f"before_{n}") + F.col(n), F.col(f"total_{n}"))

    distance = F.abs(reached("n_s") - reached("n_t"))
    return running.groupBy("feature").agg(F.max(distance).alias("ks")).withColumn(
        "alert", F.col("ks") > threshold
    )


def importance_ranks(importance: DataFrame, value: str = "importance") -> DataFrame:
    """Rank of each feature; the input has one row per model feature."""
    return importance.select(
        "feature", F.row_number().over(Window.orderBy(F.desc(value), "feature")).alias("rank")
    )


def rank_stability(
    previous: DataFrame, current: DataFrame, top: int = 3, limit: int = K.RANK_SHIFT
) -> DataFrame:
    """Rank change of every feature in the top of either side.

    A feature missing on one side counts as moved.
    """
    old = importance_ranks(previous).withColumnRenamed("rank", "previous_rank")
    new = importance_ranks(current).withColumnRenamed("rank", "current_rank")
    either = (F.col("previous_rank") <= top) | (F.col("current_rank") <= top)
    change = F.abs(F.col("previous_rank") - F.col("current_rank"))
    return (
        old.join(new, "feature", "full_outer")
        .where(either)
        .withColumn("rank_change", change)
        .withColumn("alert", F.coalesce(change > limit, F.lit(True)))
    )


def period_start(unit: str, ts: str = "ts") -> Column:
    return F.date_trunc(unit, F.col(ts)).cast("date")


def summary_by_period(log: DataFrame, baseline: DataFrame, unit: str = "month") -> tuple[DataFrame, DataFrame]:
    """Per month or quarter: the summary, and the shift of every feature."""
    dated = log.withColumn("period_start", period_start(unit))
    summary = prediction_summary(dated, ["period_start"])
    shifts = mean_shift(json_feature_means(dated, ["period_start"]), baseline)
    return summary, shifts
