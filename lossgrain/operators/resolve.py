"""From loan histories to one resolved row per defaulted loan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import clip, number

LAST_PERIOD = "999999"


def filter_vintage(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.where(F.col("vintage_year").between(low, high))


def filter_defaults(df: DataFrame, codes: Sequence[str] = tuple(K.DEFAULT_CODES)) -> DataFrame:
    return df.where(F.col("zero_balance_code").isin(*codes))


def drop_null_target(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    return df.dropna(subset=[target])


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = K.SPLIT_SEED) -> DataFrame:
    """Keep whole keys by hash, so that a loan's history stays together."""
    limit = f"{min(max(int(fraction * 16**8), 0), 16**8):09x}"
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.where(F.concat(F.lit("0"), F.substring(digest, 1, 8)) < F.lit(limit))


def period_order(period: str = "monthly_reporting_period", *position: str) -> list[Column]:
    """Sort key of a history: period with null last, then the file position."""
    return [F.coalesce(F.col(period), F.lit(LAST_PERIOD)), *[F.col(c) for c in position]]


#: Types whose values an aggregate keeps in place.
FIXED_WIDTH = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}


def dedupe_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in a total order.

    An aggregate, not a row number: every task reduces its part of a key to
    one row before the shuffle, however many copies the key has. Rows of
    numbers with one number as the order take a hash aggregate.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    kinds = [kind for c, kind in df.dtypes if c in rest]
    if len(order) == 1 and {*kinds, df.select(order[0]).dtypes[0][1]} <= FIXED_WIDTH:
        # All columns meet the rows of a key in one order, so of equal ones all take the same row.
        ranked = df.withColumn("_order", order[0]).groupBy(*keys)
        return ranked.agg(*[F.min_by(c, "_order").alias(c) for c in rest]).select(*df.columns) if rest else df.distinct()
    row = F.struct(*[F.col(c) for c in df.columns])
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return first.select("_row.*")


#: Bits that a period of six digits leaves for the position within it.
POSITION_BITS = 43


def fixed_order(period: str | Column, position: Column, bits: int = POSITION_BITS) -> Column:
    """Period (null last) and file position as one number that sorts as the two do.

    Aggregates compare a number and keep it in place; of a struct every column
    makes its own copy and compares it field by field. A period that is not
    six digits, or a position below 0 or of more than ``bits`` bits, is an
    error, never a wrong order.
    """
    text = F.coalesce(F.col(period) if isinstance(period, str) else period, F.lit(LAST_PERIOD))
    month, at = text.try_cast("long"), position.cast("long")
    fits = (F.length(text) == 6) & month.between(100_000, 999_999) & at.between(0, (1 << bits) - 1)
    wrong = F.raise_error(F.concat_ws(" ", F.lit("order does not fit:"), text, at.cast("string")))
    return F.when(fits, month * F.lit(1 << bits) + at).otherwise(wrong)


def last_per_loan(
    df: DataFrame,
    key: str = "loan_seq_num",
    order: Sequence[Column | str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per loan and per column the last value that is not null.

    ``max_by`` skips rows whose ordering is null, so the ordering is made null
    wherever the value is. One shuffle, reduced per loan before it. With one
    number as the order (:func:`fixed_order`) number columns take a hash
    aggregate; text columns, which have no fixed width, sort each task's own
    rows by loan.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order or period_order()]
    columns = [c for c in (columns or df.columns) if c != key]
    ranked = df.withColumn("_order", order[0] if len(order) == 1 else F.struct(*order))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c) for c in columns]
    return ranked.groupBy(key).agg(*last)


def with_lgd(df: DataFrame, upb: str = "zero_balance_removal_upb") -> DataFrame:
    """Loss given default in [0, 1]; rows without a positive balance go."""
    kept = df.where(F.col(upb) > 0)
    parts = ["expenses", "net_sale_proceeds", "mi_recoveries"]
    if all(c in df.columns for c in parts):
        expenses, proceeds, insurance = (F.coalesce(F.col(c), F.lit(0.0)) for c in parts)
        loss = F.col(upb) - proceeds + expenses - insurance
    else:
        loss = F.coalesce(F.col("actual_loss"), F.lit(0.0))
    return kept.withColumn(K.TARGET, clip(loss / F.col(upb), 0.0, 1.0))


def join_loans(perf: DataFrame, orig: DataFrame, key: str = "loan_seq_num") -> DataFrame:
    """Inner join of resolved loans and originations, both unique on the key."""
    shared = (set(perf.columns) & set(orig.columns)) - {key}
    if "maturity_date" in shared:
        orig = orig.withColumnRenamed("maturity_date", "maturity_date_orig")
        shared.discard("maturity_date")
    if shared:
        raise ValueError(f"columns on both sides: {', '.join(sorted(shared))}")
    return perf.join(orig, key, "inner")


def merge_and_clean(perf: DataFrame, orig: DataFrame) -> DataFrame:
    merged = join_loans(perf, orig).withColumnsRenamed(K.FEATURE_NAMES)
    return drop_null_target(merged)


def late_or_resolving(
    status: str = "current_delinquency_status",
    codes: Sequence[str] = tuple(K.DEFAULT_CODES),
    threshold: int = 3,
    non_numeric: Sequence[str] = (),
) -> tuple[Column, Column]:
    """Whether a monthly record is 90+ days late, and whether it is a default.

    The records for which neither holds do not matter to any operator here.
    """
    late = F.coalesce(number(status) >= threshold, F.lit(False))
    if non_numeric:
        late = late | F.coalesce(F.col(status).isin(*non_numeric), F.lit(False))
    return late, F.coalesce(F.col("zero_balance_code").isin(*codes), F.lit(False))


def months_delinquent(
    history: DataFrame,
    key: str = "loan_seq_num",
    period: str = "monthly_reporting_period",
    status: str = "current_delinquency_status",
    codes: Sequence[str] = tuple(K.DEFAULT_CODES),
    threshold: int = 3,
    minimum: int = 3,
    non_numeric: Sequence[str] = (),
) -> DataFrame:
    """Per defaulted loan: months 90+ days late before its resolution.

    Only late or resolving records are shuffled, once and by loan: the months,
    the window and the final sum share that partitioning.
    ``non_numeric`` lists text statuses to count as late (default: none).
    """
    late, resolving = late_or_resolving(status, codes, threshold, non_numeric)
    monthly = (
        history.select(key, F.col(period).alias("_period"), late.alias("_late"), resolving.alias("_end"))
        .where(F.col("_late") | F.col("_end"))
        .repartition(key)
        .groupBy(key, "_period")
        .agg(F.count_if("_late").alias("_n_late"), F.bool_or("_end").alias("_end"))
    )
    ends = F.coalesce(F.col("_period"), F.lit(LAST_PERIOD))
    resolution = F.max(F.when(F.col("_end"), ends)).over(Window.partitionBy(key))
    before = F.when(F.col("_period") < F.col("_resolution"), F.col("_n_late"))
    count = F.greatest(F.coalesce(F.sum(before), F.lit(0)), F.lit(minimum)).cast("int")
    return (
        monthly.withColumn("_resolution", resolution)
        .where(F.col("_resolution").isNotNull())
        .groupBy(key)
        .agg(count.alias("months_delinquent_at_default"))
    )
