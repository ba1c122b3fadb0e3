"""Distributed model fits, scoring, intervals, attributions, scenarios."""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor, GeneralizedLinearRegression, LinearRegression,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import clip, finite, known, tail_weight, total
from lossgrain.operators.features import scaler_stats
from lossgrain.operators.macro import cross_scenarios
from lossgrain.session import pin


log = logging.getLogger(__name__)

#: Mean and scale by feature.
Scaler = Mapping[str, tuple[float, float]]


@dataclass(frozen=True)
class LinearScorer:
    """Coefficients by feature name; a score is one column expression.

    With a ``scaler`` the coefficients belong to standardised features, in
    which a missing value is 0, the training mean.
    """

    intercept: float
    coefficients: Mapping[str, float]
    link: str = "logit"
    scaler: Scaler | None = None

    @property
    def features(self) -> list[str]:
        return list(self.coefficients)

    def input(self, c: str, value: Column) -> Column:
        """What the coefficient of a feature is multiplied by."""
        if self.scaler is None:
            return value
        mean, width = self.scaler[c]
        return finite((value - F.lit(float(mean))) / F.lit(float(width)))

    def linear(self) -> Column:
        terms = [F.lit(float(b)) * self.input(c, F.col(c)) for c, b in self.coefficients.items()]
        return total([F.lit(float(self.intercept)), *terms])

    def column(self) -> Column:
        if self.link == "logit":
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.linear()))
        return self.linear()

    def unscaled(self) -> LinearScorer:
        """The same score of complete rows in raw units."""
        if self.scaler is None:
            return self
        slopes = {c: b / self.scaler[c][1] for c, b in self.coefficients.items()}
        shift = sum(b * self.scaler[c][0] for c, b in slopes.items())
        return LinearScorer(self.intercept - shift, slopes, self.link)


@dataclass(frozen=True)
class FittedModel:
    """A fitted pipeline over standardised features, and what standardises them."""

    pipeline: PipelineModel
    features: Sequence[str]
    scaler: Scaler


def fit_scaler(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Mean and scale of the training rows; one row reaches the driver."""
    known_values = train.select(*[known(c).alias(c) for c in features])
    return {r.feature: (r["mean"] or 0.0, r.scale or 1.0) for r in scaler_stats(known_values, features).collect()}


def standardised(df: DataFrame, features: Sequence[str], scaler: Scaler) -> DataFrame:
    """``df`` with ``_x_<feature>``: scaled first, made finite afterwards.

    So a missing value is the training mean; only a feature that is no column
    at all is 0 in raw units.
    """
    scaled = {}
    for c in features:
        mean, width = scaler[c]
        value = known(c) if c in df.columns else F.lit(0.0)
        scaled[f"_x_{c}"] = finite((value - F.lit(float(mean))) / F.lit(float(width)))
    return df.withColumns(scaled)


def assemble(df: DataFrame, features: Sequence[str]) -> tuple[VectorAssembler, DataFrame, Scaler]:
    scaler = fit_scaler(df, features)
    assembler = VectorAssembler(inputCols=[f"_x_{c}" for c in features], outputCol="_features")
    return assembler, assembler.transform(standardised(df, features, scaler)), scaler


def fit_ridge(
    train: DataFrame, features: Sequence[str], target: str = K.TARGET, penalty: float = 0.1
) -> FittedModel:
    assembler, data, scaler = assemble(train, features)
    ridge = LinearRegression(
        featuresCol="_features", labelCol=target, predictionCol="lgd",
        elasticNetParam=0.0, regParam=penalty, solver="normal",
    )
    return FittedModel(PipelineModel([assembler, ridge.fit(data)]), list(features), scaler)


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    target: str = K.TARGET,
    rounds: int = 20,
    depth: int = 4,
    alpha: float | None = None,
    seed: int = K.SPLIT_SEED,
) -> FittedModel:
    """Boosted trees; ``alpha`` turns on the tail weight."""
    assembler, data, scaler = assemble(train, features)
    data = data.withColumn("_w", F.lit(1.0) if alpha is None else tail_weight(target, alpha))
    trees = GBTRegressor(
        featuresCol="_features", labelCol=target, predictionCol="lgd", weightCol="_w",
        maxIter=rounds, maxDepth=depth, seed=seed,
    )
    return FittedModel(PipelineModel([assembler, trees.fit(data)]), list(features), scaler)


def tree_importance(spark: SparkSession, model: FittedModel) -> DataFrame:
    """``feature, importance`` (share of gain) of fitted trees."""
    weights = model.pipeline.stages[1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(model.features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double")


def _fit_logit(
    assembler: VectorAssembler, data: DataFrame, weight: str, target: str, iterations: int, tolerance: float
) -> PipelineModel:
    logit = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="_features", labelCol=target,
        predictionCol="lgd", weightCol=weight, maxIter=iterations, tol=tolerance,
    )
    fitted = logit.fit(data)
    if fitted.summary.numIterations >= iterations:
        log.warning("the fit stopped at its limit of %d iterations", iterations)
    return PipelineModel([assembler, fitted])


def fit_bounded_tail_weighted(
    train: DataFrame,
    features: Sequence[str],
    target: str = K.TARGET,
    alpha: float = K.TAIL_ALPHA,
    iterations: int = 100,
    tolerance: float = 1e-8,
) -> FittedModel:
    """Primary model: prediction inside (0, 1), both tails weighted up.

    A fit that reaches ``iterations`` before ``tolerance`` is reported.
    """
    assembler, data, scaler = assemble(train, features)
    data = data.withColumn("_w", tail_weight(target, alpha))
    return FittedModel(_fit_logit(assembler, data, "_w", target, iterations, tolerance), list(features), scaler)


def scorer_of(model: FittedModel) -> LinearScorer:
    """The coefficients of a fitted linear or logit model, by feature name."""
    fitted = model.pipeline.stages[1]
    coefficients = dict(zip(model.features, map(float, fitted.coefficients)))
    link = "logit" if hasattr(fitted, "getLink") else "identity"
    return LinearScorer(float(fitted.intercept), coefficients, link, model.scaler)


def scorer_table(spark: SparkSession, scorer: LinearScorer) -> DataFrame:
    """A scorer as a table, its scaler included; to be staged beside the feature table."""
    scaler = scorer.scaler or {}
    rows = [(None, scorer.intercept, None, None, scorer.link)]
    rows += [(c, b, *scaler.get(c, (None, None)), scorer.link) for c, b in scorer.coefficients.items()]
    return spark.createDataFrame(rows, "feature string, coefficient double, mean double, scale double, link string")


def scorer_from(table: DataFrame) -> LinearScorer:
    """The scorer of a table written by :func:`scorer_table` (one row per feature)."""
    rows = table.collect()
    features = [r for r in rows if r.feature is not None]
    scaler = {r.feature: (r["mean"], r.scale) for r in features if r.scale is not None}
    intercept = next(r for r in rows if r.feature is None)
    return LinearScorer(intercept.coefficient, {r.feature: r.coefficient for r in features}, intercept.link, scaler or None)


def score(df: DataFrame, model: FittedModel | LinearScorer, name: str = "lgd") -> DataFrame:
    """Portfolio of any size to predictions in [0, 1]; features go by name."""
    if isinstance(model, LinearScorer):
        inputs, scored = _inputs(df, [model])
        return inputs.withColumn(name, clip(scored[0].column(), 0.0, 1.0)).drop(*set(inputs.columns) - set(df.columns))
    kept = df.withColumn("_row", F.struct(*df.columns)).select(
        "_row", *[c for c in model.features if c in df.columns])
    scored = model.pipeline.transform(standardised(kept, model.features, model.scaler))
    return scored.select("_row.*", clip("lgd", 0.0, 1.0).alias(name))


def _inputs(df: DataFrame, scorers: Sequence[LinearScorer]) -> tuple[DataFrame, list[LinearScorer]]:
    """Clean inputs as columns beside ``df``, once per scaler, and the scorers over them."""
    columns: dict[str, Column] = {}
    scalers: list[Scaler | None] = []
    renamed = []
    for s in scorers:
        if s.scaler not in scalers:
            scalers.append(s.scaler)
        number = scalers.index(s.scaler)
        names = {c: f"_x{number}_{c}" for c in s.features}
        for c, x in names.items():
            value = F.col(c).cast("double") if c in df.columns else F.lit(0.0)
            columns[x] = finite(value) if s.scaler is None else s.input(c, value)
        renamed.append(LinearScorer(s.intercept, {names[c]: b for c, b in s.coefficients.items()}, s.link))
    return df.withColumns(columns), renamed


def poisson_weight(key: str | Column, member: int, seed: int = K.SPLIT_SEED) -> Column:
    """How often a row is drawn for one bootstrap member.

    Poisson(1) by inversion of a hash of key, seed and member: the same on
    every run and every retry of a task. The limits go on until what is left
    is finer than the hash.
    """
    text = F.concat(F.col(key) if isinstance(key, str) else key, F.lit(f":{seed}:{member}"))
    point = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    below, limits = 0.0, []
    while 1.0 - below > 16.0**-12:
        below += math.exp(-1.0) / math.factorial(len(limits))
        limits.append(below)
    return total([F.when(point >= limit, F.lit(1.0)).otherwise(F.lit(0.0)) for limit in limits])


def member_data(
    train: DataFrame, features: Sequence[str], target: str, key: str, members: int, alpha: float, seed: int
) -> tuple[DataFrame, Scaler]:
    """``x`` (1 and the standardised features), ``y``, tail weight ``w``, ``draws`` of every member; stored."""
    scaler = fit_scaler(train, features)
    name = F.col(key).cast("string")
    rows = standardised(train.where(F.col(target).isNotNull()), features, scaler).select(
        F.array(F.lit(1.0), *[f"_x_{c}" for c in features]).alias("x"),
        F.col(target).cast("double").alias("y"),
        tail_weight(target, alpha).cast("double").alias("w"),
        F.array(*[poisson_weight(name, m, seed).cast("tinyint") for m in range(members)]).alias("draws"))
    return pin(rows), scaler


def member_sums(data: DataFrame, coefficients: np.ndarray) -> np.ndarray:
    """One pass: for every member its Gram matrix, gradient and log-likelihood at its coefficients.

    A task adds up its rows in blocks and leaves one row for each number; they
    are summed before and after the shuffle, so the driver gets
    ``members * (p * p + p + 1)`` numbers, however many rows and tasks there are.
    """
    members, p = coefficients.shape
    width = p * p + p + 1

    def add_up(batches):
        total_ = np.zeros((members, width))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, p)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            weights = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, members) * w[:, None]
            linear = x @ coefficients.T
            mean = 1.0 / (1.0 + np.exp(-linear))
            pairs = (x[:, :, None] * x[:, None, :]).reshape(n, p * p)
            total_[:, :p * p] += (weights * mean * (1.0 - mean)).T @ pairs
            total_[:, p * p:-1] += (weights * (y[:, None] - mean)).T @ x
            total_[:, -1] += (weights * (y[:, None] * linear - np.logaddexp(0.0, linear))).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(members * width)), pa.array(total_.ravel())], ["at", "value"])

    sums = data.select("x", "y", "w", "draws").mapInArrow(add_up, "at bigint, value double").groupBy("at").agg(
        F.sum("value").alias("value"))
    out = np.zeros(members * width)
    for r in sums.collect():
        out[r["at"]] = r.value
    return out.reshape(members, width)


def fit_members(
    train: DataFrame,
    features: Sequence[str],
    target: str = K.TARGET,
    key: str = "loan_seq_num",
    members: int = 20,
    alpha: float = K.TAIL_ALPHA,
    seed: int = K.SPLIT_SEED,
    iterations: int = 100,
    tolerance: float = 1e-10,
) -> list[LinearScorer]:
    """Bootstrap refits of the primary model, all of them together.

    Newton steps, each of them one pass over the stored rows for all members:
    passes grow with the iterations, not with the members. A step that lowers
    a member's likelihood is halved. A feature without variance gets 0.
    """
    data, scaler = member_data(train, features, target, key, members, alpha, seed)
    p = len(features) + 1
    now = np.zeros((members, p))
    before, reached = now, np.full(members, -np.inf)
    for _ in range(iterations):
        sums = member_sums(data, now)
        worse = sums[:, -1] < reached - 1e-12 * np.abs(reached)
        gram, slope = sums[:, :p * p].reshape(members, p, p), sums[:, p * p:-1]
        steps = np.stack([np.linalg.lstsq(g, s, rcond=1e-12)[0] for g, s in zip(gram, slope)])
        following = np.where(worse[:, None], (before + now) / 2, now + steps)
        before = np.where(worse[:, None], before, now)
        reached = np.where(worse, reached, sums[:, -1])
        moved, now = np.abs(following - now).max(), following
        if moved <= tolerance:
            break
    else:
        log.warning("the members stopped at their limit of %d iterations", iterations)
    return [LinearScorer(float(b[0]), dict(zip(features, map(float, b[1:]))), "logit", scaler) for b in now]


def predict_with_interval(
    df: DataFrame, members: Sequence[LinearScorer], low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """Mean, 5 % and 95 % quantile over the members, inside each row.

    The member predictions of a loan are one sorted array, so the interval
    needs no shuffle.
    """
    clean, scorers = _inputs(df, members)
    draws = F.array_sort(F.array(*[clip(m.column(), 0.0, 1.0) for m in scorers]))
    count = len(members)

    def at(probability: float) -> Column:
        position = probability * (count - 1)
        first = math.floor(position)
        lower, upper = F.col("_draws")[first], F.col("_draws")[min(first + 1, count - 1)]
        return lower + (upper - lower) * F.lit(position - first)

    mean = F.aggregate("_draws", F.lit(0.0), lambda s, x: s + x) / F.lit(float(count))
    return (
        clean.withColumn("_draws", draws)
        .withColumn("lgd", mean)
        .withColumn("lower", at(low))
        .withColumn("upper", at(high))
        .drop("_draws", *[c for c in clean.columns if c not in df.columns])
    )


def macro_scenarios(
    loans: DataFrame,
    model: FittedModel | LinearScorer,
    scenarios: Sequence[tuple[str, int, float, float]] = tuple(K.SCENARIOS),
    recompute: bool = False,
) -> DataFrame:
    """Mean predicted loss per scenario after direct shocks to the features.

    ``recompute`` also moves the LTV at default with the shocked house price.
    """
    base = F.lit(1.0) + F.col("hpi_change")
    shocked = cross_scenarios(loans.withColumn("_base", base), scenarios)
    if recompute:
        moved = F.try_divide(F.col("ltv_at_default") * F.col("_base"), F.lit(1.0) + F.col("hpi_change"))
        shocked = shocked.withColumn("ltv_at_default", clip(moved, None, 300.0))
    return (
        score(shocked.drop("_base"), model)
        .groupBy("scenario", "severity")
        .agg(F.count("*").alias("n"), F.avg("lgd").alias("mean_lgd"))
        .orderBy("severity")
    )


def linear_attributions(
    df: DataFrame,
    scorer: LinearScorer,
    means: Mapping[str, float] | Column,
    key: str = "loan_seq_num",
) -> DataFrame:
    """Per loan and feature its exact part of the score on the link scale.

    The parts of a loan add up to its linear score minus the linear score of
    the baseline. ``means`` is a literal mapping or a map-valued subquery.
    """
    if isinstance(means, Column):
        df = df.withColumn("_means", means)

    def mean(c: str) -> Column:
        return F.try_element_at("_means", F.lit(c)) if isinstance(means, Column) else F.lit(float(means[c]))

    rows = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            (F.lit(float(b)) * (scorer.input(c, F.col(c)) - scorer.input(c, mean(c)))).alias("attribution"),
        )
        for c, b in scorer.coefficients.items()
    ])
    return df.select(key, F.inline(rows))


def feature_means(train: DataFrame, features: Sequence[str]) -> Column:
    """Map of feature to training mean as a one-value subquery."""
    row = train.agg(*[F.avg(c).alias(c) for c in features])
    pairs = [x for c in features for x in (F.lit(c), F.col(c))]
    return row.select(F.create_map(*pairs).alias("m")).scalar()


def global_importance(attributions: DataFrame, k: int | None = 5) -> DataFrame:
    """The ``k`` features with the largest mean absolute attribution; all of them for ``None``."""
    ranked = (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("attribution")).alias("mean_abs"))
        .orderBy(F.desc("mean_abs"), "feature")
    )
    return ranked if k is None else ranked.limit(k)


def explain_extremes(
    attributions: DataFrame, predictions: DataFrame, n: int, key: str = "loan_seq_num"
) -> DataFrame:
    """Attributions of the ``n`` highest and the ``n`` lowest predictions."""
    ranked = predictions.select(key, "lgd")
    high = ranked.orderBy(F.desc("lgd"), key).limit(n).withColumn("extreme", F.lit("high"))
    low = ranked.orderBy(F.asc("lgd"), key).limit(n).withColumn("extreme", F.lit("low"))
    return attributions.join(high.unionByName(low), key)
