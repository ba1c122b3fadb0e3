"""Benchmarks, error metrics, calibration and acceptance checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import share, tail_weight, varies
from lossgrain.operators.describe import histogram
from lossgrain.operators.lookup import BROADCAST_BYTES, attach, measured
from lossgrain.operators.order_stats import quantiles

SEGMENT = ("property_type", "occupancy_status", "vintage_year")


def segment_benchmark(
    train: DataFrame, by: Sequence[str] = SEGMENT, target: str = K.TARGET
) -> DataFrame:
    """Mean loss per segment of the training rows."""
    return train.groupBy(*by).agg(F.avg(target).alias("segment_mean"), F.count(target).alias("n"))


def apply_segment_benchmark(
    test: DataFrame,
    segments: DataFrame,
    by: Sequence[str] = SEGMENT,
    name: str = "prediction",
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """Segment mean as prediction; the overall training mean where unseen."""
    segments, small = measured(segments, bound)
    weighted = F.sum(F.col("segment_mean") * F.col("n")) / F.sum("n")
    overall = segments.agg(weighted.alias("m")).scalar()
    joined = attach(test, segments.select(*by, "segment_mean"), list(by), small=small)
    return joined.withColumn(name, F.coalesce(F.col("segment_mean"), overall)).select(
        *test.columns, name
    )


def regression_metrics(
    df: DataFrame, y: str, p: str, by: Sequence[str] = ()
) -> DataFrame:
    """n, MAE, RMSE and R squared from one pass of sums."""
    known = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    error = F.col(p) - F.col(y)
    squares = F.avg(error * error)
    r2 = F.when(varies(y), F.lit(1.0) - F.try_divide(squares, F.var_pop(y)))
    metrics = [
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(squares).alias("rmse"),
        r2.alias("r2"),
    ]
    return known.groupBy(*by).agg(*metrics) if by else known.agg(*metrics)


def weighted_mse(df: DataFrame, y: str, p: str, alpha: float = K.TAIL_ALPHA) -> DataFrame:
    error = F.col(p) - F.col(y)
    return df.agg(F.avg(tail_weight(y, alpha) * error * error).alias("weighted_mse"))


def model_comparison(metrics: DataFrame, benchmark: str = "segment_average") -> DataFrame:
    """Test metrics per model with the improvement over the benchmark in percent.

    ``metrics`` has one row per ``model``: ``mae, rmse, r2``.
    """
    base = (
        metrics.where(F.col("model") == benchmark)
        .agg(F.struct(F.max("mae").alias("mae"), F.max("rmse").alias("rmse")).alias("b"))
        .scalar()
    )
    other = F.col("model") != benchmark

    def gain(name: str) -> Column:
        before = F.col("_base")[name]
        percent = F.try_divide(before - F.col(name), before) * F.lit(100.0)
        return F.when(other, F.round(percent, 1))

    return metrics.withColumn("_base", base).select(
        "model",
        "mae",
        "rmse",
        "r2",
        gain("mae").alias("mae_improvement"),
        gain("rmse").alias("rmse_improvement"),
    )


def cut_points(df: DataFrame, value: str, bins: int) -> Column:
    """Inner limits of equally filled bins as a one-value array subquery."""
    inner = [i / bins for i in range(1, bins)]
    return quantiles(df, value, inner).agg(F.max("q").alias("q")).scalar()


def calibration(
    df: DataFrame, y: str, p: str, bins: int = 10, tolerance: float = K.CALIBRATION_TOLERANCE
) -> DataFrame:
    """Predicted against actual mean in equally filled prediction bins."""
    cuts = cut_points(df, p, bins)
    number = F.size(F.filter("_cuts", lambda cut: F.col("_p") > cut)) + 1
    return (
        df.select(F.col(y).alias("_y"), F.col(p).alias("_p"))
        .where(F.col("_p").isNotNull() & F.col("_y").isNotNull())
        .withColumn("_cuts", cuts)
        .withColumn("bin", number)
        .groupBy("bin")
        .agg(
            F.count("*").alias("n"),
            F.avg("_p").alias("mean_predicted"),
            F.avg("_y").alias("mean_actual"),
        )
        .withColumn("gap", F.col("mean_predicted") - F.col("mean_actual"))
        .withColumn("within_tolerance", F.abs("gap") <= tolerance)
        .orderBy("bin")
    )


def residual_summary(df: DataFrame, y: str, p: str, large: float = 0.3) -> DataFrame:
    """Mean, population deviation and size of large residuals, in one row."""
    error = F.col(p) - F.col(y)
    return df.agg(
        F.count(error).alias("n"),
        F.avg(error).alias("mean_residual"),
        F.stddev_pop(error).alias("std_residual"),
        F.count_if(F.abs(error) > large).alias("n_large"),
        (F.lit(100.0) * share(F.abs(error) > large)).alias("pct_large"),
    )


def residual_histogram(df: DataFrame, y: str, p: str, bins: int = 50) -> DataFrame:
    return histogram(df.select((F.col(p) - F.col(y)).alias("residual")), "residual", bins)


def residuals_by_segment(df: DataFrame, y: str, p: str, columns: Sequence[str]) -> DataFrame:
    """Mean error, MAE and n per class of each column, in one scan."""
    error = F.col(p) - F.col(y)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("segment"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        df.select(error.alias("_e"), F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("segment", "value")
        .agg(
            F.avg("_e").alias("mean_error"),
            F.avg(F.abs("_e")).alias("mae"),
            F.count("_e").alias("n"),
        )
    )


def interval_width(df: DataFrame, lower: str = "lower", upper: str = "upper") -> DataFrame:
    return df.withColumn("interval_width", F.col(upper) - F.col(lower))


def interval_summary(df: DataFrame) -> DataFrame:
    """One row: number of loans and mean interval width."""
    return interval_width(df).agg(
        F.count("interval_width").alias("n"), F.avg("interval_width").alias("mean_width")
    )


def interval_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(interval_width(df), "interval_width", bins)


def check_monotonic(scenarios: DataFrame, value: str = "mean_lgd") -> DataFrame:
    """One row: whether the loss never falls as the scenarios get harder.

    The input has one row per scenario, so its window is as small.
    """
    before = F.lag(value).over(Window.orderBy("severity"))
    steps = scenarios.select((before.isNull() | (F.col(value) >= before)).alias("ok"))
    return steps.agg(F.bool_and("ok").alias("monotonic"))


def success_criteria(
    comparison: DataFrame, model: str, calibrated: DataFrame, monotonic: DataFrame
) -> DataFrame:
    """Criterion, measured value, target and verdict for one model.

    Takes the outputs of :func:`model_comparison`, :func:`calibration` and
    :func:`check_monotonic`.
    """
    all_within = calibrated.agg(F.bool_and("within_tolerance").alias("c")).scalar()
    monotone = monotonic.agg(F.bool_and("monotonic").alias("m")).scalar()

    def numeric(name: str, column: str, target: float, strict: bool = False) -> Column:
        passed = F.col(column) > target if strict else F.col(column) >= target
        return F.struct(
            F.lit(name).alias("criterion"),
            F.col(column).cast("double").alias("actual"),
            F.lit(float(target)).alias("target"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    def flag(name: str, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("criterion"),
            F.lit(None).cast("double").alias("actual"),
            F.lit(None).cast("double").alias("target"),
            F.coalesce(value, F.lit(False)).alias("passed"),
        )

    rows = F.array(
        numeric("mae_improvement", "mae_improvement", K.MIN_MAE_IMPROVEMENT),
        numeric("rmse_improvement", "rmse_improvement", K.MIN_RMSE_IMPROVEMENT),
        numeric("r2", "r2", K.MIN_R2, strict=True),
        flag("calibration", all_within),
        flag("macro_monotonic", monotone),
    )
    return comparison.where(F.col("model") == model).select(F.inline(rows))
