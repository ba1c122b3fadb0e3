"""Batch scoring of a portfolio and the monitoring view of its log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrain import constants as K
from lossgrain.operators import features as ft
from lossgrain.operators import model as md
from lossgrain.operators import monitor as mo
from lossgrain.operators import quality as qa
from lossgrain.sources import prediction_log as pl


def score_portfolio(
    loans: DataFrame,
    members: Sequence[md.LinearScorer],
    keys: Sequence[str],
    run_id: str,
    model_version: str,
    log_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Predictions of the valid rows, and the rejected rows with their faults.

    With ``log_path`` every prediction is also logged once, whatever is
    retried.
    """
    valid, rejected = qa.validate_rows(loans)
    inputs = valid.withColumn("_input", F.struct(*K.FEATURES))
    scored = md.predict_with_interval(ft.encode_serving(inputs), members)
    scored = ft.with_prediction_id(scored, keys, run_id)
    if log_path is not None:
        entry = scored.select(
            "prediction_id",
            F.current_timestamp().alias("ts"),
            F.to_json("_input", {"ignoreNullFields": "false"}).alias("features_json"),
            F.col("lgd").alias("predicted_lgd"),
            F.lit(model_version).alias("model_version"),
        )
        pl.append_predictions(loans.sparkSession, log_path, entry)
    answer = scored.select(*keys, "prediction_id", "lgd", "lower", "upper")
    return ft.format_predictions(answer, model_version), rejected


def monitoring_summary(
    spark: SparkSession, log_path: str, baseline: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summary, feature means, and drift with alerts of a whole log."""
    log = pl.read_predictions(spark, log_path)
    means = mo.json_feature_means(log)
    drift = mo.drift_alerts(mo.mean_shift(means, baseline))
    return mo.prediction_summary(log), mo.rounded_means(means), drift
