"""Joins of a large frame to a reference table of unknown size.

A table is broadcast only when it was written and its bytes were found small.
Beyond that bound the join is a shuffle join. A sketch of frequent items finds
the keys that own a large part of the rows; only these are spread over several
tasks, and only their rows of the table are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lossgrain.session import pin, stored_bytes

#: Bytes of a written (compressed) table up to which it is broadcast.
BROADCAST_BYTES = 8 << 20


def measured(table: DataFrame, bound: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The table computed once, and whether its files have at most ``bound`` bytes."""
    table = pin(table)
    return table, stored_bytes(table) <= bound


def salt_count(df: DataFrame) -> int:
    """Parts that a hot key is spread over: the shuffle partitions, so a key can use them all."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def heavy_keys(df: DataFrame, on: Sequence[str], salts: int) -> list[int]:
    """Hashes of the keys with at least the rows of a quarter of a task, were ``salts`` tasks to share them evenly.

    One pass: a task keeps a bounded sketch of counts, and sketches are merged.
    Estimates err upwards only, by less than the limit; there are at most
    ``8 * salts`` such keys.
    """
    most = 8 * salts
    row = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on)).select(_key_hash(on).alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {most}, {min(16 * most, 1_000_000)})").alias("top")).first()
    limit = max(row.n // (4 * salts), 1)
    return sorted(x.item for x in row.top or [] if x["count"] >= limit)


def _key_hash(on: Sequence[str], kinds: dict[str, str] | None = None) -> Column:
    """Hash of a key; with ``kinds`` as if the columns had the types of the other side."""
    return F.xxhash64(*[F.col(c).try_cast(kinds[c]) if kinds else F.col(c) for c in on])


def attach(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: bool = False,
    salts: int | None = None,
) -> DataFrame:
    """Join to a table with unique keys: broadcast if small; if not, with the heavy keys salted.

    ``df`` is read once more for its heavy keys. Rows without a key match
    nothing and are spread as well.
    """
    if small:
        return df.join(F.broadcast(table), list(on), how)
    rows, spread = salted_sides(df, table, on, salts or salt_count(df))
    return rows.join(spread, [*on, "_salt"], how).drop("_salt")


def salted_sides(df: DataFrame, table: DataFrame, on: Sequence[str], salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: rows of heavy keys are dealt over all salts, their table rows are repeated."""
    heavy = heavy_keys(df, on, salts)
    kinds = {c: kind for c, kind in df.dtypes if c in on}
    is_heavy = lambda key: key.isin(heavy) if heavy else F.lit(False)
    spread = table.withColumn("_salt", F.explode(F.when(
        is_heavy(_key_hash(on, kinds)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.lit(salts)).cast("int")
    missing = F.expr(" OR ".join(f"`{c}` IS NULL" for c in on))
    return df.withColumn("_salt", F.when(is_heavy(_key_hash(on)) | missing, dealt).otherwise(F.lit(0))), spread


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    bound: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Compute and count ``table``, then join it in the way its size allows."""
    table, small = measured(table, bound)
    return attach(df, table, on, how, small, salts)
