"""Feature construction, category codes and the model matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import finite, known, lookup, varies
from lossgrain.operators.lookup import BROADCAST_BYTES, attach, measured
from lossgrain.operators.order_stats import with_running_counts

UNKNOWN = "Unknown"


def with_ltv_at_default(df: DataFrame, balance_col: str = "zero_balance_removal_upb") -> DataFrame:
    """Balance over the price-adjusted origination value, in percent, max 300."""
    if not {"orig_ltv", "orig_upb"} <= set(df.columns):
        fallback = F.col("orig_ltv") if "orig_ltv" in df.columns else F.lit(80.0)
        return df.withColumn("ltv_at_default", fallback)
    orig_ltv = known("orig_ltv")
    ltv = F.when(orig_ltv != 0, F.greatest(orig_ltv, F.lit(1.0)))
    value = F.col("orig_upb") / (ltv / F.lit(100.0))
    if "hpi_change" in df.columns:
        value = value * (F.lit(1.0) + F.coalesce(known("hpi_change"), F.lit(0.0)))
    ratio = known(F.try_divide(F.col(balance_col), value) * F.lit(100.0))
    return df.withColumn(
        "ltv_at_default", F.when(ratio.isNotNull(), F.least(ratio, F.lit(300.0)))
    )


def region_of(state: str | Column) -> Column:
    regions = {s: region for region, states in K.REGION_STATES.items() for s in states}
    return lookup(state, regions, "Other")


def with_region(df: DataFrame, replace_state: bool = False) -> DataFrame:
    """Add ``region``; optionally let ``state`` carry it into the model."""
    if "state" not in df.columns:
        return df
    df = df.withColumn("region", region_of("state"))
    return df.withColumn("state", F.col("region")) if replace_state else df


def with_modification_numeric(df: DataFrame) -> DataFrame:
    flag = F.lit(0)
    if "modification_flag" in df.columns:
        flag = F.when(F.col("modification_flag") == "Y", F.lit(1)).otherwise(F.lit(0))
    return df.withColumn("modification_flag_numeric", flag)


def fit_encoder(df: DataFrame, columns: Sequence[str] = tuple(K.CATEGORICAL_FEATURES)) -> DataFrame:
    """Dictionary ``column, value, code``: codes follow the order of the values.

    Values are counted per column first, so the ranking sees one row per
    category; it is split by leading characters for very long dictionaries.
    """
    present = [c for c in columns if c in df.columns]
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value"))
        for c in present
    ])
    values = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.lit(1).alias("n"))
    ranked = with_running_counts(values, "value", ["column"])
    return ranked.select("column", "value", F.col("before_n").cast("int").alias("code"))


def apply_encoder(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str] = tuple(K.CATEGORICAL_FEATURES),
    unknown: str = "error",
    bound: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Values to fitted codes.

    ``unknown="error"`` fails the job on a value that was not fitted,
    ``"next"`` gives it the number of fitted classes.
    """
    if unknown not in ("error", "next"):
        raise ValueError("unknown must be 'error' or 'next'")
    dictionary, small = measured(dictionary, bound)
    for c in [c for c in columns if c in df.columns]:
        classes = dictionary.where(F.col("column") == c)
        n_classes = classes.agg(F.count("*").cast("int").alias("n")).scalar()
        codes = classes.select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        text = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
        joined = attach(df.withColumn(f"_v_{c}", text), codes, [f"_v_{c}"], "left", small, salts)
        code = F.col(f"_c_{c}")
        if unknown == "next":
            code = F.coalesce(code, n_classes)
        else:
            message = F.concat(F.lit(f"value not fitted in {c}: "), F.col(f"_v_{c}"))
            code = F.when(code.isNotNull(), code).otherwise(F.raise_error(message).cast("int"))
        df = joined.withColumn(c, code).drop(f"_v_{c}", f"_c_{c}")
    return df


def encode_serving(df: DataFrame) -> DataFrame:
    """Category columns to the fixed codes of the scoring interface."""
    codes = {c: lookup(c, table, other) for c, (table, other) in K.SERVING_CODES.items() if c in df.columns}
    if "state" in df.columns:
        codes["state"] = lookup(region_of("state"), K.SERVING_REGION_CODES, K.SERVING_REGION_CODES["Other"])
    return df.withColumns(codes)


def feature_matrix(
    df: DataFrame,
    features: Sequence[str] = tuple(K.FEATURES),
    target: str = K.TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Features in model order, absent ones as 0, plus target and vintage."""
    chosen = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    extra = [c for c in [target, "vintage_year"] if c in df.columns]
    return df.select(*keep, *chosen, *extra)


def sanitize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Features made finite before scoring; an absent one becomes 0."""
    return df.withColumns(
        {c: finite(c) if c in df.columns else F.lit(0.0) for c in columns}
    )


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, mean, scale`` of training rows; population std, zero to 1."""
    row = train.agg(*[
        F.struct(
            F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), varies(c).alias("varies")
        ).alias(c)
        for c in columns
    ])
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c)["mean"].alias("mean"),
            F.when(F.col(c)["varies"], F.col(c)["std"]).otherwise(F.lit(1.0)).alias("scale"),
        )
        for c in columns
    ])
    return row.select(F.inline(pairs))


def scale(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise with fitted statistics, read once as a one-value subquery."""
    entry = F.struct("feature", F.struct("mean", "scale"))
    fitted = stats.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()

    def scaled(c: str) -> Column:
        s = F.try_element_at("_fitted", F.lit(c))
        return (F.col(c) - s["mean"]) / s["scale"]

    return df.withColumn("_fitted", fitted).withColumns({c: scaled(c) for c in columns}).drop("_fitted")


def features_json(columns: Mapping[str, str] | Sequence[str]) -> Column:
    """The input row as JSON text for the prediction log."""
    names = list(columns)
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def with_prediction_id(df: DataFrame, keys: Sequence[str], run_id: str) -> DataFrame:
    """Id that a repeated task computes again: hash of run and row key."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    return df.withColumn("prediction_id", F.sha2(F.concat_ws("|", F.lit(run_id), *parts), 256))


def format_predictions(df: DataFrame, model_version: str) -> DataFrame:
    """Rounded prediction with its interval and the model version."""
    return df.select(
        *[c for c in df.columns if c not in ("lgd", "lower", "upper")],
        F.round("lgd", 6).alias("lgd"),
        F.struct(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))
        .alias("confidence_interval_90"),
        F.lit(model_version).alias("model_version"),
    )
