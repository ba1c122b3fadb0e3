"""Scalar transforms of the ingestion and preprocessing steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import number, year_of_period
from lossgrain.operators.order_stats import column_quantiles


def with_vintage_year(df: DataFrame, col: str = "first_payment_date") -> DataFrame:
    """Year of a YYYYMM text; an existing ``vintage_year`` is kept."""
    if "vintage_year" in df.columns or col not in df.columns:
        return df
    return df.withColumn("vintage_year", year_of_period(col))


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named columns to double, unparseable text to null; absent ones skipped."""
    return df.withColumns({c: number(c) for c in columns if c in df.columns})


def fill_zero(df: DataFrame, columns: Sequence[str] = tuple(K.ZERO_FILL)) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in present})


def medians(df: DataFrame, columns: Sequence[str]) -> Column:
    """Map of column name to exact median, as a one-value subquery."""
    found = column_quantiles(df, columns, [0.5])
    entry = F.struct("feature", F.col("q")[0].alias("median"))
    return found.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()


def fill_median(df: DataFrame, columns: Sequence[str] = tuple(K.MEDIAN_FILL)) -> DataFrame:
    """Null to the exact median of its column."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    # The subquery becomes one column, so that its plan is not repeated per use.
    held = df.withColumn("_medians", medians(df, present))
    return held.withColumns(
        {c: F.coalesce(F.col(c), F.try_element_at("_medians", F.lit(c))) for c in present}
    ).drop("_medians")


def fill_const(df: DataFrame, values: Mapping[str, object] | None = None) -> DataFrame:
    values = K.CONSTANT_FILL if values is None else values
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def imputation_audit(df: DataFrame) -> DataFrame:
    """Per imputed column: how many nulls are filled and with what."""
    zero = [c for c in K.ZERO_FILL if c in df.columns]
    median = [c for c in K.MEDIAN_FILL if c in df.columns]
    const = [c for c in K.CONSTANT_FILL if c in df.columns]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in zero + median + const])
    if median:
        nulls = nulls.withColumn("_medians", medians(df, median))
    filler = {c: F.lit("0.0") for c in zero}
    filler |= {c: F.try_element_at("_medians", F.lit(c)).cast("string") for c in median}
    filler |= {c: F.lit(str(K.CONSTANT_FILL[c])) for c in const}
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_filled"), filler[c].alias("fill_value"))
        for c in zero + median + const
    ])
    return nulls.select(F.inline(rows))


def normalize_names(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(dict(K.FEATURE_NAMES if names is None else names))


def with_default(df: DataFrame, col: str, value: object) -> DataFrame:
    """A constant column, only if the frame does not have it yet."""
    return df if col in df.columns else df.withColumn(col, F.lit(value))


def with_placeholders(df: DataFrame) -> DataFrame:
    for col, value in K.PLACEHOLDERS.items():
        df = with_default(df, col, value)
    return df


def null_sentinels(df: DataFrame, codes: Mapping[str, object] | None = None) -> DataFrame:
    """Documented "missing" codes to null. Off unless called."""
    codes = {"credit_score": 9999} if codes is None else codes
    return df.withColumns(
        {c: F.nullif(F.col(c), F.lit(v)) for c, v in codes.items() if c in df.columns}
    )
