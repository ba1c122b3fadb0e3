"""The model run: feature table to fitted models, comparison, calibration and verdict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lossgrain import constants as K
from lossgrain.operators import evaluate as ev
from lossgrain.operators import model as md
from lossgrain.operators import split as sp
from lossgrain.session import pin
from lossgrain.sources import stage as st

MODELS = ("ridge", "bounded_tail_weighted")


@dataclass(frozen=True)
class ModelRun:
    scorer: md.LinearScorer
    metrics: DataFrame
    comparison: DataFrame
    calibration: DataFrame
    scenarios: DataFrame
    criteria: DataFrame


def run(
    matrix: DataFrame,
    features: Sequence[str] = tuple(K.FEATURES),
    segment: Sequence[str] = ev.SEGMENT,
    target: str = K.TARGET,
    out: str | None = None,
) -> ModelRun:
    """Split, fit, measure all models and the segment average, and judge the primary model.

    ``matrix`` holds the features, the target, ``loan_seq_num`` and the
    segment columns. With ``out`` the primary scorer, its scaler included, is
    staged there.
    """
    parts = pin(sp.split_stratified(matrix))
    train = parts.where(F.col("split") == "train")
    ridge = md.scorer_of(md.fit_ridge(train, features, target))
    primary = md.scorer_of(md.fit_bounded_tail_weighted(train, features, target))
    benchmark = ev.segment_benchmark(train, segment, target)
    scored = ev.apply_segment_benchmark(parts, benchmark, segment, "segment_average")
    for name, scorer in zip(MODELS, (ridge, primary)):
        scored = md.score(scored, scorer, name)
    scored = pin(scored)
    # One pass for all models: a row per model, inside the row of the loan.
    long = scored.select("split", F.col(target).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("_p")) for m in ("segment_average", *MODELS)])))
    metrics = pin(ev.regression_metrics(long, "_y", "_p", ["model", "split"]))
    test = scored.where(F.col("split") == "test")
    comparison = ev.model_comparison(metrics.where(F.col("split") == "test"))
    calibration = pin(ev.calibration(test, target, MODELS[1]))
    scenarios = pin(md.macro_scenarios(test, primary))
    criteria = ev.success_criteria(comparison, MODELS[1], calibration, ev.check_monotonic(scenarios))
    if out is not None:
        st.stage(md.scorer_table(matrix.sparkSession, primary), out)
    return ModelRun(primary, metrics, comparison, calibration, scenarios, criteria)
