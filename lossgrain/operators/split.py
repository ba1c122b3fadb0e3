"""Reproducible train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import hash_text
from lossgrain.operators.lookup import lookup_join
from lossgrain.operators.order_stats import order_statistics, text_cell


def split_stratified(
    df: DataFrame,
    by: str = "vintage_year",
    key: str = "loan_seq_num",
    test: float = K.TEST_SHARE,
    val: float = K.VALIDATION_SHARE,
    seed: int = K.SPLIT_SEED,
    exact: bool = True,
) -> DataFrame:
    """Add ``split``; each stratum keeps its share in every part.

    Exact mode: of the ``n`` keys of a stratum in hash order the first
    ``round(test * n)`` are test, the next ``round(val * n)`` validation. Only
    the two limiting hashes of a stratum are searched for, so no stratum is
    ever sorted. With ``exact=False`` the hash is compared with fixed shares
    and nothing is shuffled at all.
    """
    hashed = df.withColumn("_h", hash_text(key, seed))
    if not exact:
        point = F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
        part = F.when(point < test, "test").when(point < test + val, "validation").otherwise("train")
        return hashed.withColumn("split", part).drop("_h")

    def size(portion: float):
        return F.round(F.col("total") * F.lit(portion)).cast("long")

    n_test, n_val = size(test), size(val)
    ranks = F.array(n_test - 1, n_test + n_val - 1)
    found = order_statistics(hashed.select(by, "_h"), "_h", ranks, text_cell("_h"), [by])
    limits = found.groupBy(by).agg(
        F.max(F.when(F.col("rank") == n_test - 1, F.col("_h"))).alias("_last_test"),
        F.max(F.when(F.col("rank") == n_test + n_val - 1, F.col("_h"))).alias("_last_val"),
    )
    stratum = F.struct(F.coalesce(F.col(by).cast("string"), F.lit("")), F.col(by).isNull())
    limits = limits.select(stratum.alias("_s"), "_last_test", "_last_val")
    part = (
        F.when(F.col("_h") <= F.col("_last_test"), "test")
        .when(F.col("_h") <= F.col("_last_val"), "validation")
        .otherwise("train")
    )
    joined = lookup_join(hashed.withColumn("_s", stratum), limits, ["_s"])
    return joined.withColumn("split", part).select(*df.columns, "split")


def split_by_vintage(
    df: DataFrame,
    cutoff: int,
    by: str = "vintage_year",
    key: str = "loan_seq_num",
    val: float = K.VALIDATION_SHARE,
    seed: int = K.SPLIT_SEED,
) -> DataFrame:
    """Vintages after ``cutoff`` are test; an unknown vintage is a stratum of the others; the others split train/validation."""
    late = F.coalesce(F.col(by) > cutoff, F.lit(False))
    earlier = split_stratified(df.where(~late), by, key, 0.0, val, seed)
    later = df.where(late).withColumn("split", F.lit("test"))
    return earlier.unionByName(later)
