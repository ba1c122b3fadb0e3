"""Helpers shared by the operators: hot keys, global ranks, Arrow passes."""

from __future__ import annotations

import ctypes
from collections.abc import Sequence
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lossgrain.session import pin, scratch_path  # noqa: F401  (used by the operators)

#: A key with more than 1/HOT_SHARE of all rows is hot; so at most HOT_SHARE keys are.
HOT_SHARE = 1000


def tables(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_if_there(spark, sf_dir: str, name: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return tables(spark, sf_dir, name) if there else None


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names that ``df`` does not have, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def attach(rows: DataFrame, table: DataFrame, key: str | list[str], count: str, how: str = "left") -> DataFrame:
    """Left (or inner) join of ``rows`` with a ``table`` that has one row per ``key``.

    ``count`` names the column of ``table`` with the number of ``rows`` of the
    key. Keys that hold more than 1/HOT_SHARE of all rows are at most
    HOT_SHARE in number, so they are joined by a broadcast of that proven
    size; what is left has no hot key and is joined by a shuffle. Rows with a
    null in the first key column match nothing and do not meet in one task.
    Both inputs are read twice and should be stored tables.
    """
    keys = [key] if isinstance(key, str) else list(key)
    limit = max(rows.count() // HOT_SHARE, 1000)
    hot = table.where(F.col(count) > limit)
    if how == "inner":  # rows with a null key go, and of the others those that match nothing
        cold = rows.join(table.where(F.col(count) <= limit), keys)
        return cold if hot.isEmpty() else cold.unionByName(rows.join(F.broadcast(hot), keys))
    if hot.isEmpty():
        return _null_safe(rows, table, keys)
    flag, = fresh(rows, "is_hot")
    hot_keys = F.broadcast(hot.select(*keys, F.lit(True).alias(flag)))
    marked = rows.join(hot_keys, keys, "left")
    found = marked.where(F.col(flag)).drop(flag).join(F.broadcast(hot), keys, "left")
    return found.unionByName(
        _null_safe(marked.where(F.col(flag).isNull()).drop(flag), table.where(F.col(count) <= limit), keys))


def _null_safe(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    with_key = rows.where(F.col(keys[0]).isNotNull()).join(table, keys, "left")
    kinds = {f.name: f.dataType for f in table.schema if f.name not in keys}
    without = rows.where(F.col(keys[0]).isNull()).select(
        *rows.columns, *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    return with_key.unionByName(without)


def ranked(df: DataFrame, part: str, order: Sequence[str | Column], out: str,
           bucket: Column, buckets: int) -> DataFrame:
    """Gapless rank from 0 inside each ``part``, without a task per part.

    Rows of a part are spread over ``buckets`` numbered by ``bucket``. The
    counts per part and bucket give every bucket its first rank; only a
    bucket is sorted at once. ``bucket`` comes first in the order.
    """
    from pyspark.sql import Window

    b, base, rn = fresh(df, "rank_bucket", "rank_base", "rank_in")
    spread = df.withColumn(b, bucket.cast("int"))
    counts = spread.groupBy(part, b).agg(F.count(F.lit(1)).alias(base))
    before = Window.partitionBy(part).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    inside = Window.partitionBy(part, b).orderBy(*order)
    numbered = spread.withColumn(rn, F.row_number().over(inside) - 1)
    return numbered.join(starts, [part, b]).withColumn(
        out, (F.col(base) + F.col(rn)).cast("long")).drop(b, base, rn)


def small_batches(spark, most: int = 4 << 20) -> None:
    """Let at most about ``most`` bytes of rows go to a Python worker at once, however long the texts.

    An executor and its workers hold several batches each, in growing buffers.
    The setting stays, as frames are computed after the stage that makes them;
    it changes no result, and a smaller one is left alone.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > most:
        spark.conf.set(name, str(most))


def hand_back() -> None:
    """Return the memory that a Python worker has freed; a reused worker would hold it through all later stages."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def disjoint(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the merged spans, which come by start."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b, _ in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends
