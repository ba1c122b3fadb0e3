"""Merkle manifest of a dataset, with octopus multiproofs.

Rows are the leaves of one tree for each value of ``tree`` (a language); the
subroots of these are the leaves of a tree above. Positions come from a range
partitioned sort and counts per partition. A *leaf partition* is a run of
``2 ** levels`` neighbours: interior nodes are made inside leaf partitions, a
number of levels at a time, so a tree of any size takes a few shuffles.

To prove rows, each leaf partition works out the smallest set of nodes that
it can neither take from its rows nor derive from other nodes: at every level
the siblings of what it knows. These coordinates are fetched for all leaf
partitions by one join; each then derives the interior nodes that its proofs
share and expands the proof of every row.

Nodes are binary: a run is two neighbours, or one alone at the end of a level.

Defined results: nulls in any field, the id and the tree column are values of
their own (a null tree is the first tree); rows with equal ids are ordered by
their leaf; rows equal in all fields are interchangeable neighbours; texts are
hashed whole; an empty table has no leaves, nodes or root; further columns
are no part of a leaf and may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from lossgrain.llm.common import attach, pin

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 12
#: Key of the tree above the subroots; those of the others begin with '-' or '='.
TOP = "^"
NODE = "tree string, level int, index bigint, digest string, n bigint"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def depth(n: int) -> int:
    return max(n - 1, 0).bit_length()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def parents(nodes: list[str]) -> list[str]:
    return [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]


def missing_nodes(known: list[int], n: int) -> list[tuple[int, int]]:
    """The smallest set of ``(level, index)`` that proves the leaves ``known`` of ``n`` together."""
    out, level = [], 0
    at = sorted(set(known))
    while n > 1:
        here = set(at)
        out += [(level, i ^ 1) for i in at if i ^ 1 < n and i ^ 1 not in here]
        at = sorted({i >> 1 for i in at})
        n, level = (n + 1) // 2, level + 1
    return out


def expand(known: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> dict[int, list[str]]:
    """Proof of each known leaf: for every level ``L`` or ``R`` and the sibling, or nothing for a node alone."""
    steps = {i: [] for i in known}
    here, level = dict(known), 0
    while n > 1:
        full = here | {i: d for (lv, i), d in fetched.items() if lv == level}
        side = {i: "" if i ^ 1 >= n else ("R" if i % 2 == 0 else "L") + full[i ^ 1] for i in here}
        for leaf, path in steps.items():
            path.append(side[leaf >> level])
        here = {p: sha(full[2 * p] + (full[2 * p + 1] if 2 * p + 1 < n else "")) for p in {i >> 1 for i in here}}
        n, level = (n + 1) // 2, level + 1
    return steps


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to along its proof."""
    def up(h: Column, step: Column) -> Column:
        other = F.substr(step, F.lit(2))
        return digest(F.when(step.startswith("L"), F.concat(other, h)).when(
            step.startswith("R"), F.concat(h, other)).otherwise(h))

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substr(s, F.lit(2))), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` with ``tree, index, digest, n``, all interior ``nodes``, ``subroots`` by tree and the root."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None
    levels: int


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``index`` (from 0 in each tree) and ``n`` (rows of the tree)."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col("tree"), *order, F.col("_tie")]
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn(
        "_part", F.spark_partition_id())

    def number(batches):
        tree, last = None, 0
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                tree, last = t, last + 1 if t == tree else 0
                out.append(last)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "_in"])

    names = ["tree", *[c for c in ranged.columns if c != "tree"]]
    schema = T.StructType([*ranged.select(*names).schema.fields, T.StructField("_in", T.LongType())])
    numbered = pin(ranged.select(*names).mapInArrow(number, schema))
    counts = numbered.groupBy("tree", "_part").agg((F.max("_in") + 1).alias("_count"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "_part", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"),
        F.sum("_count").over(Window.partitionBy("tree")).alias("n"))
    return numbered.join(starts, ["tree", "_part"]).withColumn("index", F.col("_start") + F.col("_in")).drop(
        "_part", "_in", "_start")


def _interiors(leaves: DataFrame, deepest: int, levels: int) -> list[DataFrame]:
    """Stored tables of the nodes above ``leaves(tree, index, digest, n)``, ``levels`` of them a table."""
    def climb(base: int):
        def inside(table: pa.Table) -> pa.Table:
            rows = table.sort_by("index")
            n, first = rows.column("n")[0].as_py(), rows.column("index")[0].as_py()
            nodes, out = rows.column("digest").to_pylist(), []
            for level in range(base + 1, min(base + levels, depth(n)) + 1):
                nodes, first = parents(nodes), first >> 1
                out += [(level, first + i, d) for i, d in enumerate(nodes)]
            level, index, made = zip(*out) if out else ((), (), ())
            tree = rows.column("tree")[0].as_py()
            return pa.table({
                "tree": pa.array([tree] * len(out), pa.string()), "level": pa.array(level, pa.int32()),
                "index": pa.array(index, pa.int64()), "digest": pa.array(made, pa.string()),
                "n": pa.array([n] * len(out), pa.int64())})

        return inside

    stored, current = [], leaves.select("tree", "index", "digest", "n")
    for base in range(0, deepest, levels):
        block = F.shiftright("index", levels)
        made = pin(current.groupBy("tree", block.alias("block")).applyInArrow(climb(base), NODE))
        stored.append(made)
        current = made.where(F.col("level") == base + levels).select("tree", "index", "digest", "n")
    return stored


def _all(spark: SparkSession, tables: list[DataFrame], schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for t in tables:
        out = out.unionByName(t)
    return out


def build(rows: DataFrame, tree: Column, order: list[str], levels: int = LEVELS) -> Manifest:
    """The manifest of ``rows``, which have a ``digest`` each; ``order`` sorts the leaves of a tree."""
    spark = rows.sparkSession
    named = rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("-")))
    leaves = pin(_placed(named, [*[F.col(c).asc_nulls_first() for c in order], F.col("digest")]))
    largest = leaves.agg(F.max("n")).first()[0] or 0
    interiors = _interiors(leaves, depth(largest), levels)
    nodes = _all(spark, interiors, NODE)
    tops = nodes.where("index = 0").unionByName(
        leaves.where("n = 1").select("tree", F.lit(0).alias("level"), "index", "digest", "n"))
    of_tree = tops.where(F.col("level") == F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1))))
    named_tops = of_tree.select(F.lit(TOP).alias("tree"), F.col("tree").alias("subtree"), "digest")
    subroots = pin(_placed(named_tops, [F.col("subtree")]))  # '-' (null) sorts before '='
    n_trees = subroots.count()
    above = _interiors(subroots, depth(n_trees), levels)
    top = _all(spark, above, NODE).where(F.col("level") == depth(n_trees)) if n_trees > 1 else subroots
    found = top.first()
    return Manifest(leaves, _all(spark, [*interiors, *above], NODE), subroots, found and found["digest"], levels)


def of_table(docs: DataFrame, tree: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             carry: dict[str, Column] | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of a table: ``order`` and the columns ``carry`` stay beside the leaves."""
    leaf = leaf_of(*[F.col(c) for c in fields]).alias("digest")
    extra = [value.alias(name) for name, value in (carry or {}).items()]
    return build(docs.select(F.col(order).alias("id"), F.col(tree).alias("_tree"), leaf, *extra),
                 F.col("_tree"), ["id"], levels)


def _paths(wanted: DataFrame, everything: DataFrame, levels: int) -> DataFrame:
    """``wanted(tree, index, digest, n, ...)`` with ``proof`` inside its own tree.

    ``everything(tree, level, index, digest)`` holds all nodes and leaves.
    """
    block = F.shiftright("index", levels).alias("block")
    place = T.StructType([T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()),
                          T.StructField("level", T.IntegerType()), T.StructField("index", T.LongType())])

    def ask(table: pa.Table) -> pa.Table:
        at = table.column("index").to_pylist()
        found = missing_nodes(at, table.column("n")[0].as_py())
        level, index = zip(*found) if found else ((), ())
        return pa.table({
            "tree": pa.array([table.column("tree")[0].as_py()] * len(found), pa.string()),
            "block": pa.array([at[0] >> levels] * len(found), pa.int64()),
            "level": pa.array(level, pa.int32()), "index": pa.array(index, pa.int64())})

    asked = pin(wanted.select("tree", "index", "n").groupBy("tree", block).applyInArrow(ask, place))
    keys = ["tree", "level", "index"]
    # Nodes near the root are asked for by many leaf partitions: attach() spreads those.
    named = pin(asked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_asked")).join(
        everything.select(*keys, "digest"), keys))
    fetched = attach(asked, named, keys, "n_asked").select("tree", "block", "level", "index", "digest")

    def prove(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        at = rows.column("index").to_pylist()
        got = dict(zip(zip(nodes.column("level").to_pylist(), nodes.column("index").to_pylist()),
                       nodes.column("digest").to_pylist()))
        steps = expand(dict(zip(at, rows.column("digest").to_pylist())), got, rows.column("n")[0].as_py()) if at else {}
        return rows.append_column("proof", pa.array([steps[i] for i in at], pa.list_(pa.string()))).select(out.names)

    out = T.StructType([*wanted.schema.fields, T.StructField("proof", T.ArrayType(T.StringType()))])
    return wanted.withColumn("block", F.shiftright("index", levels)).groupBy("tree", "block").cogroup(
        fetched.groupBy("tree", "block")).applyInArrow(prove, out)


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``wanted`` leaves of the manifest (all of them by default) with ``subroot`` and ``proof`` up to the root."""
    leaves = manifest.leaves
    everything = manifest.nodes.select("tree", "level", "index", "digest").unionByName(
        leaves.select("tree", F.lit(0).alias("level"), "index", "digest")).unionByName(
        manifest.subroots.select("tree", F.lit(0).alias("level"), "index", "digest"))
    above = pin(_paths(manifest.subroots, everything, manifest.levels).select(
        F.col("subtree").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("_above")))
    own = _paths(leaves if wanted is None else wanted, everything, manifest.levels)
    return own.join(above, "tree").withColumn("proof", F.concat("proof", "_above")).drop("_above")
