"""Exact order statistics without sorting a group in one task.

The built-in exact ``percentile`` keeps one map of all distinct values per
group, and a running total over a whole column is one task. Both are replaced
by the same two steps: equal values are collapsed with a map-side count, and
the counts are added up per *cell*: for order statistics a fixed function of
the value that keeps the order, for running counts a range of the distinct
values. Running totals are then taken over the few cells and, separately,
inside single cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrain.operators.lookup import BROADCAST_BYTES, measured
from lossgrain.session import pin

STEPS = 8192
EXPONENT_SHIFT = 1100


def number_cell(c: str | Column, steps: int = STEPS) -> Column:
    """Cell of a double: its binary exponent and the leading bits (13 for ``STEPS``).

    Non-decreasing in the value, and independent of the data, so that two
    passes always agree on it.
    """
    value = F.col(c) if isinstance(c, str) else c
    size = F.least(F.abs(value), F.lit(1.7976931348623157e308))
    exponent = F.floor(F.log2(F.when(size > 0, size)))
    step = F.floor(size / F.pow(F.lit(2.0), exponent.cast("double")) * F.lit(float(steps)))
    cell = (exponent + EXPONENT_SHIFT) * (2 * steps) + step
    return (
        F.when(value > 0, cell).when(value < 0, -cell).when(value.isNotNull(), F.lit(0)).cast("long")
    )


def text_cell(c: str | Column, length: int = 4) -> Column:
    """Cell of a text: its first characters."""
    return F.substring(F.col(c) if isinstance(c, str) else c, 1, length)


def _running(by: list[str]):
    return Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)


def _inside(by: list[str], value: str):
    return Window.partitionBy(*by, "_cell").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)


def _keyed(by: list[str]) -> list[Column]:
    return [F.col(c).alias(f"_g_{c}") for c in by] + [F.col("_cell").alias("_g_cell")]


def _same_cell(by: list[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by] + [F.col("_cell") == F.col("_g_cell")]


def with_running_counts(
    counts: DataFrame, value: str, by: Sequence[str] = (), n: Sequence[str] = ("n",)
) -> DataFrame:
    """Add ``before_<n>`` (rows with a smaller value) and ``total_<n>``.

    ``counts`` has one row per group and distinct value with one or several
    count columns ``n``. It is written once, in ranges of group and value
    whose limits Spark samples from these rows; a range is what one task adds
    up. As no value comes twice, ranges are even however the values lie.
    """
    by, n = list(by), list(n)
    celled = pin(counts.repartitionByRange(*by, value).withColumn("_cell", F.spark_partition_id()))
    sums = celled.groupBy(*by, "_cell").agg(*[F.sum(c).alias(c) for c in n])
    whole = Window.partitionBy(*by)
    offsets = sums.select(
        *_keyed(by),
        *[(F.sum(c).over(_running(by)) - F.col(c)).alias(f"_offset_{c}") for c in n],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in n],
    )
    joined = celled.join(offsets, _same_cell(by))
    before = [
        (F.col(f"_offset_{c}") + F.sum(c).over(_inside(by, value)) - F.col(c)).alias(f"before_{c}")
        for c in n
    ]
    return joined.select(*counts.columns, *before, *[f"total_{c}" for c in n])


def order_statistics(
    df: DataFrame,
    value: str,
    ranks: Column,
    cell: Column,
    by: Sequence[str] = (),
    few_groups: bool = False,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """The values at given 0-based ranks of each group.

    ``ranks`` is an array expression over the group size column ``total``.
    Returns one row per group and rank: ``by``, ``total``, ``rank``, value.

    The first pass counts rows per cell, which leaves a few thousand rows per
    task. The second pass keeps only the cells that hold a wanted rank. Those
    are broadcast when their number is fixed by the query (no groups, or
    ``few_groups``) or was counted and is small; otherwise equal values are
    collapsed first and joined by shuffle.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, value, cell.alias("_cell"))
    sums = rows.groupBy(*by, "_cell").agg(F.count("*").alias("_in_cell"))
    upto = F.sum("_in_cell").over(_running(by))
    placed = sums.select(
        *_keyed(by),
        (upto - F.col("_in_cell")).alias("_offset"),
        upto.alias("_upto"),
        F.sum("_in_cell").over(Window.partitionBy(*by)).alias("total"),
    )
    holds = lambda r: (r >= F.col("_offset")) & (r < F.col("_upto"))
    wanted = placed.where(F.exists(ranks, holds)).drop("_upto")
    small = few_groups or not by
    if not small:
        wanted, small = measured(wanted, bound)
    if small:
        found = rows.withColumn("_n", F.lit(1)).join(F.broadcast(wanted), _same_cell(by))
    else:
        counts = rows.groupBy(*by, value, "_cell").agg(F.count("*").alias("_n"))
        found = counts.join(wanted, _same_cell(by))
    at_value = lambda r: (r >= F.col("_end") - F.col("_n")) & (r < F.col("_end"))
    return (
        found.groupBy(*by, "_cell", value)
        .agg(F.sum("_n").alias("_n"), F.max("_offset").alias("_offset"), F.max("total").alias("total"))
        .withColumn("_end", F.col("_offset") + F.sum("_n").over(_inside(by, value)))
        .select(
            *by, "total", F.explode(F.filter(F.array_distinct(ranks), at_value)).alias("rank"), value
        )
    )


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation: ``by``, ``n``, ``q`` (array).

    Groups without a single non-null value have no row.
    """
    by = list(by)
    probabilities = [float(p) for p in probabilities]
    position = [F.lit(p) * (F.col("total") - 1).cast("double") for p in probabilities]
    ranks = F.array(*[f(p).cast("long") for p in position for f in (F.floor, F.ceil)])
    found = order_statistics(df, value, ranks, number_cell(value), by, few_groups)
    groups = found.groupBy(*by).agg(
        F.max("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("rank", F.col(value).cast("double")))).alias("_at"),
    )

    def at(p: Column) -> Column:
        low = F.try_element_at(F.col("_at"), F.floor(p).cast("long"))
        high = F.try_element_at(F.col("_at"), F.ceil(p).cast("long"))
        return low + (high - low) * (p - F.floor(p))

    return groups.select(
        *by, F.col("total").alias("n"), F.array(*[at(p) for p in position]).alias("q")
    )


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Quantiles of several columns in one pass: ``feature``, ``n``, ``q``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                      for c in columns])
    long = df.select(F.inline(pairs)).where(F.col("x").isNotNull())
    return quantiles(long, "x", probabilities, ["feature"], few_groups=True)
