"""Column expressions shared by the operators. Nothing here runs a job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
)


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    text = as_column(c).cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def year_of_period(c: str | Column) -> Column:
    """YYYYMM text to its year; unparseable text becomes null."""
    value = number(c)
    return F.floor(value / F.lit(100)).try_cast("int")


def month_of_period(c: str | Column) -> Column:
    """YYYYMM text to the first day of that month."""
    return F.try_to_timestamp(as_column(c), F.lit("yyyyMM")).cast("date")


def known(c: str | Column) -> Column:
    """The value as a double; NaN becomes null."""
    value = as_column(c).cast("double")
    return F.when(~F.isnan(value), value)


def clip(c: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; null stays null and NaN becomes null.

    ``least`` and ``greatest`` would skip a null and take NaN for the largest
    number.
    """
    value = known(c)
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def finite(c: str | Column, largest: float = 1.7976931348623157e308) -> Column:
    """NaN and null to 0, infinities to the largest double of that sign."""
    value = F.coalesce(as_column(c).cast("double"), F.lit(0.0))
    return (
        F.when(F.isnan(value), F.lit(0.0))
        .when(value == F.lit(float("inf")), F.lit(largest))
        .when(value == F.lit(float("-inf")), F.lit(-largest))
        .otherwise(value)
    )


def lookup(c: str | Column, mapping: dict, default=None) -> Column:
    """Literal dictionary lookup with a default for everything else."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, as_column(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def share(condition: Column) -> Column:
    """Share of rows for which a condition holds; null counts as false."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def varies(c: str | Column) -> Column:
    """Aggregate: whether a column has two different values.

    Deviations merged from several tasks are not exactly zero for a constant,
    so zero spread has to be told by the extremes.
    """
    return F.max(as_column(c)) > F.min(as_column(c))


def pearson(x: str | Column, y: str | Column) -> Column:
    """Correlation over rows where both sides exist; constant input gives null.

    The built-in ``corr`` raises a division error on constant input in ANSI
    mode.
    """
    both = as_column(x).isNotNull() & as_column(y).isNotNull()
    a, b = F.when(both, as_column(x)), F.when(both, as_column(y))
    ratio = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(varies(a) & varies(b), ratio)


def tail_weight(y: str | Column, alpha: float = 2.0) -> Column:
    """1 in the middle of [0, 1], 1 + alpha at both ends, quadratic between."""
    distance = F.abs(as_column(y) - F.lit(0.5)) * F.lit(2.0)
    return F.lit(1.0) + F.lit(float(alpha)) * distance * distance


def hash_text(key: str | Column, seed: int | str) -> Column:
    """Reproducible pseudo-random text for a key: md5 of ``key:seed``."""
    return F.md5(F.concat(as_column(key).cast("string"), F.lit(f":{seed}")))
