"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lossgrain.llm.common import attach, pin


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node.

    A star step reads each node's neighbours through their minimum, which is
    aggregated before the shuffle; hubs are joined by :func:`attach`. Nothing
    but two numbers per round reaches the driver.
    """
    def stored(pairs: DataFrame) -> DataFrame:
        return pin(pairs.where("u <> v").distinct())

    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))

    def state(table: DataFrame):
        return table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(e)
    for _ in range(rounds):
        both = pin(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = pin(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        large = attach(both, least, "u", "n").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v"))
        e = stored(large)
        least = pin(e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = attach(e, least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        e = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        after = state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle; raise rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
