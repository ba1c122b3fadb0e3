"""Exact additive attributions of boosted trees."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lossgrain.functions.columns import known
from lossgrain.operators.model import FittedModel, standardised
from lossgrain.session import scratch_path


@dataclass(frozen=True)
class Leaf:
    """A leaf times its tree's weight, and for each feature on its path the interval and the share of cover.

    A row is inside when ``low < x <= high``. The share is that of the
    training weight which follows the path where the feature decides.
    """

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def inside(self, x: np.ndarray) -> np.ndarray:
        """Where rows (rows x features of the path) are inside."""
        return (x > self.low) & (x <= self.high)

    def parts(self, inside: np.ndarray) -> np.ndarray:
        """Shapley values of the leaf's value for rows (patterns x features of the path) of 0 and 1."""
        m = len(self.features)
        weight = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
        out = np.empty(inside.shape)
        for i in range(m):
            # Coefficient k: sum over the sets of k other known features.
            sums = np.ones((len(inside), 1))
            for j in range(m):
                if j != i:
                    following = np.zeros((len(inside), sums.shape[1] + 1))
                    following[:, :-1] = sums * self.share[j]
                    following[:, 1:] += sums * inside[:, j:j + 1]
                    sums = following
            out[:, i] = self.value * (inside[:, i] - self.share[i]) * (sums @ weight)
        return out


def tree_nodes(spark: SparkSession, model: FittedModel) -> DataFrame:
    """One row per node of the fitted trees, as Spark stores them: small, bounded by rounds and depth."""
    path = scratch_path(spark, "trees")
    model.pipeline.stages[1].write().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node.id.alias("node"), node.prediction.alias("prediction"),
        node.impurityStats[0].alias("cover"), node.gain.alias("gain"), node.leftChild.alias("left"),
        node.rightChild.alias("right"), node.split.featureIndex.alias("feature"),
        F.get(node.split.leftCategoriesOrThreshold, F.lit(0)).alias("threshold"))


def tree_leaves(nodes: DataFrame, weights: list[float]) -> list[Leaf]:
    """The paths of all trees; ``weights`` are those of the trees, in order."""
    by_place = {(r.tree, r.node): r for r in nodes.collect()}
    out = []
    for tree, weight in enumerate(weights):
        open_ = [(0, {})]
        while open_:
            number, path = open_.pop()
            node = by_place[tree, number]
            if node.left < 0:
                names = sorted(path)
                low, high, share = (np.array([path[f][k] for f in names], float) for k in range(3))
                out.append(Leaf(weight * node.prediction, np.array(names, int), low, high, share))
                continue
            low, high, share = path.get(node.feature, (-math.inf, math.inf, 1.0))
            for child, a, b in ((node.left, low, min(high, node.threshold)), (node.right, max(low, node.threshold), high)):
                part = by_place[tree, child].cover / node.cover
                open_.append((child, {**path, node.feature: (a, b, share * part)}))
    return out


def tree_baseline(leaves: list[Leaf]) -> float:
    """The score that the parts of a row are differences from: the mean over the training weight."""
    return float(sum(leaf.value * leaf.share.prod() for leaf in leaves))


#: Cells that one table of parts has at most.
CELLS = 4096


class PartsTable:
    """The parts of some leaves for every cell between their thresholds, and where a row's cell is found.

    ``limits`` has the thresholds of all leaves by feature; a row is known by
    its place among them. The cells of these leaves only are the table's.
    """

    def __init__(self, leaves: list[Leaf], own: dict[int, np.ndarray], limits: dict[int, np.ndarray]):
        self.features = sorted(own)
        ends = [np.append(own[f], np.inf) for f in self.features]  # the interval of a cell ends at its end
        shape = tuple(map(len, ends))
        at = np.unravel_index(np.arange(math.prod(shape)), shape)
        x = np.stack([e[i] for e, i in zip(ends, at)], axis=1)
        self.parts = np.zeros((len(self.features), len(x)))
        for leaf in leaves:
            places = np.searchsorted(self.features, leaf.features)
            self.parts[places] += leaf.parts(leaf.inside(x[:, places]).astype(float)).T
        steps = [math.prod(shape[i + 1:]) for i in range(len(shape))]
        self.steps = [np.searchsorted(own[f], np.append(limits[f], np.inf)) * step for f, step in zip(self.features, steps)]

    def add(self, out: np.ndarray, places: dict[int, np.ndarray]) -> None:
        """Add the parts (features x rows) of rows with these places."""
        cell = sum(step.take(places[f]) for f, step in zip(self.features, self.steps))
        for f, parts in zip(self.features, self.parts):
            out[f] += parts.take(cell)


class Attributor:
    """The leaves as tables of at most ``cells`` cells, made once; a row then takes one look into each.

    Leaves are taken together as they come, so a table mostly holds a tree. A
    leaf that alone has more cells is worked out for the patterns of the rows.
    """

    def __init__(self, leaves: list[Leaf], cells: int = CELLS):
        leaves = [leaf for leaf in leaves if len(leaf.features)]
        self.limits = self._thresholds(leaves)
        self.tables, self.wide, open_ = [], [], []
        for leaf in leaves:
            if self._cells([leaf]) > cells:
                self.wide.append(leaf)
                continue
            if open_ and self._cells([*open_, leaf]) > cells:
                self.tables.append(PartsTable(open_, self._thresholds(open_), self.limits))
                open_ = []
            open_.append(leaf)
        if open_:
            self.tables.append(PartsTable(open_, self._thresholds(open_), self.limits))

    @staticmethod
    def _thresholds(leaves: list[Leaf]) -> dict[int, np.ndarray]:
        found: dict[int, set[float]] = {}
        for leaf in leaves:
            for f, *ends in zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist()):
                found.setdefault(f, set()).update(e for e in ends if math.isfinite(e))
        return {f: np.array(sorted(ends)) for f, ends in found.items()}

    def _cells(self, leaves: list[Leaf]) -> int:
        return math.prod(len(ends) + 1 for ends in self._thresholds(leaves).values())

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Parts (features x rows) of standardised, finite features ``x`` (features x rows)."""
        out = np.zeros(x.shape)
        places = {f: np.searchsorted(ends, x[f]) for f, ends in self.limits.items()}
        for table in self.tables:
            table.add(out, places)
        for leaf in self.wide:
            patterns, which = np.unique(leaf.inside(x[leaf.features].T), axis=0, return_inverse=True)
            out[leaf.features] += leaf.parts(patterns.astype(float))[which.reshape(-1)].T
        return out


def attribution_matrix(leaves: list[Leaf], x: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Parts (rows x features) of standardised, finite features ``x``."""
    return Attributor(leaves, cells).parts(np.ascontiguousarray(x.T, float)).T


def tree_attributions(df: DataFrame, model: FittedModel, leaves: list[Leaf], key: str = "loan_seq_num") -> DataFrame:
    """Per loan and feature ``value, attribution``; the parts of a loan add up to its score minus the baseline.

    The value of a set of features is the mean over the paths that agree with
    the loan on these, weighted by training cover elsewhere. Parts are exact
    sums over the leaves, worked out once per cell between the thresholds of a
    tree, so a loan costs a look into a table per tree. No shuffle; what a task
    gets is the tables, whose size does not grow with the rows. A missing value
    counts as the training mean, as in scoring.
    """
    attributor = Attributor(leaves)
    names = list(model.features)
    rows = standardised(df.withColumn("_key", F.col(key)), names, model.scaler).select(
        "_key", *[f"_x_{c}" for c in names],
        *[(known(c) if c in df.columns else F.lit(None).cast("double")).alias(f"_v_{c}") for c in names])
    schema = StructType([StructField(key, df.schema[key].dataType), StructField("feature", StringType()),
                         StructField("value", DoubleType()), StructField("attribution", DoubleType())])

    def explained(batches):
        n = len(names)
        for batch in batches:
            x = np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(n)])
            values = pa.concat_arrays([batch.column(1 + n + i) for i in range(n)])
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0)] * n),
                pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(n), batch.num_rows))),
                values, pa.array(attributor.parts(x).reshape(-1))], names=schema.names)

    return rows.mapInArrow(explained, schema)
