"""Data-quality checks: keys, null rates, row and batch rules, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import number as parsed
from lossgrain.session import pin


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that names the absent columns."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: number of rows without a key."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def check_null_keys(df: DataFrame, key: str) -> DataFrame:
    """The frame itself, or an error with the number of rows without a key."""
    found = null_keys(df, key).first()["null_keys"]
    if found:
        raise ValueError(f"{found} rows have a null {key}")
    return df


def count_duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows repeat a key seen before (null is a key too)."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))


def key_profile(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """One row: number of rows and of different keys."""
    if approximate:
        return df.agg(
            F.count("*").alias("n_rows"), F.approx_count_distinct(key).alias("n_keys")
        )
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("n_keys"),
    )


NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def request_rules(columns: Sequence[str], kinds: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Field name to "is bad" for one scoring request.

    ``kinds`` has the types of the columns (as in ``df.dtypes``): numbers are
    compared as they are, only texts are parsed.
    """
    def field(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None)

    def number(value: Column, name: str) -> Column:
        if (kinds or {}).get(name) not in NUMBER_TYPES:
            return parsed(value)
        plain = value.cast("double")
        return F.when(~F.isnan(plain) & (F.abs(plain) != float("inf")), plain)

    rules: dict[str, Column] = {}
    for name, (low, high) in K.REQUEST_RANGES.items():
        value = number(field(name), name)
        bad = value.isNull() | (value < low) | (value > high)
        if name in K.REQUEST_WHOLE:
            bad = bad | (value != F.floor(value))
        rules[name] = bad
    for name in K.REQUEST_POSITIVE:
        value = number(field(name), name)
        rules[name] = value.isNull() | (value <= 0)
    for name, allowed in K.REQUEST_CHOICES.items():
        value = field(name).cast("string")
        rules[name] = value.isNull() | ~value.isin(allowed)
    state = field("state").cast("string")
    rules["state"] = state.isNull() | (F.length(state) != K.REQUEST_STATE_LENGTH)
    return rules


def with_violations(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks."""
    rules = rules or request_rules(df.columns, dict(df.dtypes))
    names = F.array(*[F.when(bad, F.lit(name)) for name, bad in sorted(rules.items())])
    return df.withColumn("violations", F.filter(names, lambda name: name.isNotNull()))


def validate_rows(
    df: DataFrame, rules: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with what they break.

    The rules are evaluated once; both results read the marked rows as stored.
    """
    checked = pin(with_violations(df, rules))
    valid = checked.where(F.size("violations") == 0).drop("violations")
    return valid, checked.where(F.size("violations") > 0)


def batch_verdicts(
    df: DataFrame, batch_key: str, rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per batch: size, broken rows, and whether the whole batch is accepted."""
    checked = with_violations(df, rules)
    return checked.groupBy(batch_key).agg(
        F.count("*").alias("n_loans"),
        F.count_if(F.size("violations") > 0).alias("n_invalid"),
    ).withColumn(
        "accepted",
        F.col("n_loans").between(1, K.MAX_BATCH_LOANS) & (F.col("n_invalid") == 0),
    )


def split_batches(
    df: DataFrame, batch_key: str, rules: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of the accepted batches, and all others; rows without a batch key are one batch.

    An accepted batch has at most 1000 rows, so no key of the right side is
    hot; oversized batches have no partner and adaptive skew handling splits
    their rows on the left side.
    """
    accepted = batch_verdicts(df, batch_key, rules).where("accepted").select(F.col(batch_key).alias("_batch"))
    same = df[batch_key].eqNullSafe(F.col("_batch"))
    return df.join(accepted, same, "left_semi"), df.join(accepted, same, "left_anti")


def validate_batches(
    df: DataFrame, batch_key: str, rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows of the accepted batches."""
    return split_batches(df, batch_key, rules)[0]


def null_rates(df: DataFrame, flag_above: float = 0.05) -> DataFrame:
    """Columns that have nulls, with their share, highest first."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rate"))
                      for c in df.columns])
    return (
        rates.select(F.inline(pairs))
        .where(F.col("null_rate") > 0)
        .withColumn("flagged", F.col("null_rate") > flag_above)
        .orderBy(F.desc("null_rate"), "column")
    )


def dropped_rows(
    df: DataFrame, upb: str = "zero_balance_removal_upb", target: Column | None = None
) -> DataFrame:
    """One row: how many rows go for their balance, and for a missing ``target`` after that."""
    keep = F.coalesce(F.col(upb) > 0, F.lit(False))
    extra = [] if target is None else [F.count_if(keep & target.isNull()).alias("dropped_by_target")]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~keep).alias("dropped_by_upb"),
        *extra,
    )
