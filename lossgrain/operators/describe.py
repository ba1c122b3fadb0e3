"""Descriptive statistics of the loss data."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import clip, known, pearson, share
from lossgrain.operators.order_stats import (
    column_quantiles, quantiles, with_running_counts,
)


def lgd_summary(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """One row: n, mean, median, percent at 0 and at 1."""
    y = F.col(target)
    middle = quantiles(df, target, [0.5]).agg(F.max(F.col("q")[0]).alias("m")).scalar()
    return df.agg(
        F.count(y).alias("n"),
        F.avg(y).alias("mean_lgd"),
        (F.lit(100.0) * share(y == 0)).alias("pct_zero"),
        (F.lit(100.0) * share(y == 1)).alias("pct_one"),
    ).withColumn("median_lgd", middle)


def describe(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Per column: count, mean, sample std, min, quartiles, max."""
    points = [0.25, 0.5, 0.75]
    row = df.agg(*[
        F.struct(
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            *([F.percentile_approx(c, points, 100_000).alias("q")] if approximate else []),
        ).alias(c)
        for c in columns
    ])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns])
    moments = row.select(F.inline(pairs)).select("feature", "s.*")
    if not approximate:
        # Both sides have one row per named column.
        exact = column_quantiles(df, columns, points).select("feature", "q")
        moments = moments.join(F.broadcast(exact), "feature", "left")
    quartiles = [F.col("q")[i].cast("double").alias(name) for i, name in enumerate(["q25", "q50", "q75"])]
    return moments.select("feature", "n", "mean", "std", "min", *quartiles, "max")


def vintage_stats(df: DataFrame, by: str = "vintage_year", target: str = K.TARGET) -> DataFrame:
    """Per vintage: number of losses, mean and exact median."""
    means = df.groupBy(by).agg(F.count(target).alias("n"), F.avg(target).alias("mean_lgd"))
    middle = quantiles(df, target, [0.5], [by]).select(
        F.col(by).alias("_by"), F.col("q")[0].alias("median_lgd")
    )
    return (
        means.join(middle, F.col(by).eqNullSafe(F.col("_by")), "left")
        .select(by, "n", "mean_lgd", "median_lgd")
        .where(F.col(by).isNotNull())
        .orderBy(by)
    )


def segment_stats(
    df: DataFrame, col: str, with_std: bool = False, ascending: bool = False, target: str = K.TARGET
) -> DataFrame:
    """Per category: mean, count and optionally sample std of the loss."""
    extra = [F.stddev_samp(target).alias("std_lgd")] if with_std else []
    stats = df.where(F.col(col).isNotNull()).groupBy(col).agg(
        F.avg(target).alias("mean_lgd"), F.count(target).alias("n"), *extra
    )
    order = F.asc("mean_lgd") if ascending else F.desc("mean_lgd")
    return stats.orderBy(order, col)


def with_edges(df: DataFrame, constant: Column) -> DataFrame:
    """Rows with a value ``_x``, beside the limits ``_lo`` and ``_hi`` of all values.

    ``constant`` is by how much the limits move apart where all values are
    equal; it is a function of ``_lo``.
    """
    rows = df.where(F.col("_x").isNotNull())
    limits = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("e")).scalar()
    apart = F.when(F.col("_lo") == F.col("_hi"), constant).otherwise(F.lit(0.0))
    return rows.withColumn("_e", limits).select(
        *df.columns, F.col("_e.lo").alias("_lo"), F.col("_e.hi").alias("_hi")
    ).withColumns({"_lo": F.col("_lo") - apart, "_hi": F.col("_hi") + apart})


def edge(number: Column, bins: int) -> Column:
    """Edge 0 to ``bins`` of equal bins, computed in one way everywhere; the last one is the limit itself."""
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return F.when(number == bins, F.col("_hi")).otherwise(number * step + F.col("_lo"))


def bin_number(bins: int, right_closed: bool) -> Column:
    """Bin 1 to ``bins`` of ``_x``: estimated by division, then corrected against its two edges."""
    x, width = F.col("_x"), F.col("_hi") - F.col("_lo")
    place = F.coalesce(F.try_divide(x - F.col("_lo"), width), F.lit(0.0)) * F.lit(float(bins))
    guess = F.ceil(place) if right_closed else F.floor(place) + 1
    first = F.least(F.greatest(guess, F.lit(1)), F.lit(bins)).cast("int")
    below = x <= edge(first - 1, bins) if right_closed else x < edge(first - 1, bins)
    above = x > edge(first, bins) if right_closed else x >= edge(first, bins)
    return (F.when(below & (first > 1), first - 1).when(above & (first < bins), first + 1)
            .otherwise(first)).cast("int")


def binned_mean(
    df: DataFrame,
    x: str = "ltv_at_default",
    y: str = K.TARGET,
    bins: int = 10,
    low: float = 0.0,
    high: float = 200.0,
) -> DataFrame:
    """Mean of ``y`` in equal-width, right-closed bins of the clipped ``x``.

    Bins run from the smallest to the largest clipped value, the smallest one
    included; empty bins are left out.
    """
    value = clip(x, low, high)
    equal = F.when(F.col("_lo") != 0, F.abs(F.col("_lo")) * F.lit(0.001)).otherwise(F.lit(0.001))
    return (
        with_edges(df.select(value.alias("_x"), F.col(y).alias("_y")), equal)
        .groupBy(bin_number(bins, True).alias("bin"))
        .agg(
            F.avg("_y").alias("mean_y"),
            F.count("_y").alias("n"),
            F.max("_lo").alias("_lo"),
            F.max("_hi").alias("_hi"),
        )
        .select(
            "bin",
            edge(F.col("bin") - 1, bins).alias("bin_low"),
            edge(F.col("bin"), bins).alias("bin_high"),
            "mean_y",
            "n",
        )
        .orderBy("bin")
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width, left-closed bins; the last one closed on both sides."""
    return (
        with_edges(df.select(known(col).alias("_x")), F.lit(0.5))
        .groupBy(bin_number(bins, False).alias("bin"))
        .agg(F.count("*").alias("n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        .select("bin", edge(F.col("bin") - 1, bins).alias("bin_low"), "n")
        .orderBy("bin")
    )


def ecdf(df: DataFrame, col: str = K.TARGET) -> DataFrame:
    """Steps of the empirical distribution, one row per different value.

    The ``n`` observations of a value take the steps from ``first_step`` to
    ``last_step``, each ``1 / total`` higher than the one before.
    """
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    running = with_running_counts(counts, "value")
    return running.select(
        "value",
        "n",
        ((F.col("before_n") + 1) / F.col("total_n")).alias("first_step"),
        ((F.col("before_n") + F.col("n")) / F.col("total_n")).alias("last_step"),
    )


def pct_underwater(df: DataFrame, col: str = "ltv_at_default") -> DataFrame:
    return df.agg((F.lit(100.0) * share(F.col(col) > 100)).alias("pct_underwater"))


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str = K.TARGET) -> DataFrame:
    """Correlation of every column with the target, lowest first."""
    row = df.agg(*[pearson(c, target).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in columns])
    return row.select(F.inline(pairs)).orderBy(F.asc_nulls_last("corr"), "feature")


#: Rows from which the middle of each column is taken; any middle gives the same result.
SHIFT_ROWS = 1000


def _cross_products(df: DataFrame, columns: Sequence[str], shift: Sequence[float]) -> DataFrame:
    """``i, sums``: for each column x against all others y, over rows with both: n and sums of x, y, xx, yy, xy, end to end.

    Each task turns its rows into blocks of matrix products and leaves one row
    for each column. These are added up in two steps, so that no task meets
    the rows of all others.
    """
    p, middle = len(columns), np.asarray(shift)

    def add_up(batches):
        out = np.zeros((6, p, p))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            has = ~np.isnan(x)
            x, known_ = np.where(has, x - middle, 0.0), has.astype(float)
            out += np.stack([known_.T @ known_, x.T @ known_, known_.T @ x, (x * x).T @ known_, known_.T @ (x * x), x.T @ x])
        rows = out.transpose(1, 0, 2).reshape(p, 6 * p)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(p, dtype=np.int32)), pa.array(list(rows), pa.list_(pa.float64()))], ["i", "sums"])

    def join(table: pa.Table) -> pa.Table:
        rows = table.column("sums").combine_chunks()
        total = rows.flatten().to_numpy().reshape(len(rows), 6 * p).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})

    made = df.select(*[known(c).alias(f"c{j}") for j, c in enumerate(columns)]).mapInArrow(
        add_up, "i int, sums array<double>").withColumn("lane", F.spark_partition_id() % 64)
    lanes = made.groupBy("i", "lane").applyInArrow(join, "i int, sums array<double>")
    return lanes.groupBy("i").applyInArrow(join, "i int, sums array<double>")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle of the correlation matrix, over the rows where both sides exist, from one scan.

    Sums of products of all pairs come from matrix products with masks, so the
    plan does not grow with the columns. A side that is constant (to 13
    digits of its distance from the column's middle) gives null.
    """
    columns = list(columns)
    some = df.select(*[known(c).alias(f"c{j}") for j, c in enumerate(columns)]).limit(SHIFT_ROWS).toPandas()
    shift = some.median().fillna(0.0).tolist()
    names = F.array(*map(F.lit, columns))
    p = len(columns)
    rows = _cross_products(df, columns, shift).select("i", "sums", F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("j")).where("j < i")

    def total(block: int) -> Column:
        return F.element_at("sums", F.col("j") + 1 + block * p)

    n, sx, sy, sxx, syy, sxy = (total(k) for k in range(6))
    vx, vy = (ss - F.try_divide(t * t, n) for ss, t in ((sxx, sx), (syy, sy)))
    both_vary = (vx > sxx * 1e-13) & (vy > syy * 1e-13)
    corr = F.when(both_vary, (sxy - sx * sy / n) / F.sqrt(vx * vy))
    return rows.select(F.get(names, "i").alias("row"), F.get(names, "j").alias("col"), corr.alias("corr"))


def category_classes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value``: one row per class, however many a column has."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()


def category_profile(df: DataFrame, columns: Sequence[str], lists: bool = False) -> DataFrame:
    """Per category column: number of classes.

    ``lists`` adds the sorted list of them, for columns whose classes fit
    into one value; :func:`category_classes` has them as rows.
    """
    extra = [F.array_sort(F.collect_list("value")).alias("classes")] if lists else []
    return category_classes(df, columns).groupBy("feature").agg(F.count("*").alias("n_classes"), *extra)
