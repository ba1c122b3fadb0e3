"""The batch run: text files to staged, cleaned and feature tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lossgrain import constants as K
from lossgrain.operators import features as ft
from lossgrain.operators import macro
from lossgrain.operators import quality as qa
from lossgrain.operators import resolve as rv
from lossgrain.operators import transform as tr
from lossgrain.session import pin
from lossgrain.sources import stage as st
from lossgrain.sources import text as tx

log = logging.getLogger(__name__)


def _read(spark: SparkSession, directory: str, columns: Sequence[str], glob: str) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return tx.read_delimited(spark, directory, columns, glob, with_position=True, observation=seen), seen


def _report(seen: Observation, rows: DataFrame, directory: str) -> None:
    """Warn about rejected rows; counted while the stage was written."""
    if not rows.isEmpty() and seen.get["rejected"]:
        log.warning("%d rows with too many fields skipped in %s", seen.get["rejected"], directory)


def ingest_origination(
    spark: SparkSession, directory: str, out: str, low: int = K.VINTAGE_WINDOW[0], high: int = K.VINTAGE_WINDOW[1]
) -> DataFrame:
    """One row per loan of the window, first appearance wins."""
    rows, seen = _read(spark, directory, K.ORIGINATION_COLUMNS, tx.ORIGINATION_GLOB)
    rows = qa.require_columns(rows, K.REQUIRED_ORIGINATION)
    window = Observation()
    loans = rv.filter_vintage(tr.with_vintage_year(rows), low, high).observe(window, F.count("*").alias("rows"))
    first = pin(rv.dedupe_first(loans, "loan_seq_num", tx.POSITION).drop(*tx.POSITION))
    _report(seen, first, directory)
    unique = first.count()
    if unique:
        log.info("%d rows in the window, %d loans, %d repeated rows removed", window.get["rows"], unique,
                 window.get["rows"] - unique)
    # A delivery that fails the check leaves the published table as it is.
    st.stage(qa.check_null_keys(first, "loan_seq_num"), out, "vintage_year")
    return st.load_stage(spark, out, first.schema)


def ingest_performance(spark: SparkSession, directory: str, out: str) -> DataFrame:
    """One resolved row per defaulted loan, with its months of delinquency.

    The text is scanned once: the few records that are late or resolving are
    written, and both results come from them.
    """
    rows, seen = _read(spark, directory, K.PERFORMANCE_COLUMNS, tx.PERFORMANCE_GLOB)
    rows = qa.require_columns(rows, K.REQUIRED_PERFORMANCE)
    late, resolving = rv.late_or_resolving()
    history = pin(rows.where(late | resolving))
    _report(seen, history, directory)
    order = rv.period_order("monthly_reporting_period", *tx.POSITION)
    last = rv.last_per_loan(rv.filter_defaults(history), order=order, columns=K.PERFORMANCE_COLUMNS)
    ready = pin(last.join(rv.months_delinquent(history), "loan_seq_num", "left"))
    st.stage(qa.check_null_keys(ready, "loan_seq_num"), out)
    return st.load_stage(spark, out)


def preprocess(origination: DataFrame, performance: DataFrame, out: str) -> DataFrame:
    """Typed, imputed, joined loans with the loss target."""
    orig = tr.fill_median(tr.fill_zero(tr.cast_numeric(origination, K.ORIGINATION_NUMERIC)))
    perf = tr.fill_const(tr.fill_zero(tr.cast_numeric(performance, K.PERFORMANCE_NUMERIC)))
    st.stage(rv.merge_and_clean(rv.with_lgd(perf), orig), out)
    cleaned = st.load_stage(origination.sparkSession, out)
    lost = qa.dropped_rows(perf).first()
    log.info("%d resolved loans, %d without balance, %d cleaned", lost.n_rows, lost.dropped_by_upb, cleaned.count())
    for filled in tr.imputation_audit(origination).collect():
        log.info("%s: %d values filled with %s", filled["column"], filled.n_filled, filled.fill_value)
    return cleaned


def engineer(
    cleaned: DataFrame,
    out: str,
    dictionary_out: str,
    hpi: DataFrame | None = None,
    rates: DataFrame | None = None,
    balance_col: str = "zero_balance_removal_upb",
    keep: Sequence[str] = ("loan_seq_num",),
) -> DataFrame:
    """Model matrix, and the category dictionary that serving needs."""
    loans = tr.with_vintage_year(cleaned)
    if hpi is not None:
        loans = macro.join_hpi(loans, hpi)
    if rates is not None:
        loans = macro.join_unemployment(loans, rates)
    loans = ft.with_ltv_at_default(tr.with_placeholders(loans), balance_col)
    loans = ft.with_modification_numeric(ft.with_region(loans, replace_state=True))
    st.stage(ft.fit_encoder(loans), dictionary_out)
    dictionary = st.load_stage(cleaned.sparkSession, dictionary_out)
    matrix = ft.feature_matrix(ft.apply_encoder(loans, dictionary), keep=list(keep))
    st.stage(matrix, out)
    return st.load_stage(cleaned.sparkSession, out)


def run(spark: SparkSession, raw: str, out: str, low: int, high: int, **macros: DataFrame) -> DataFrame:
    """All three stages from ``raw/origination`` and ``raw/performance``."""
    orig = ingest_origination(spark, f"{raw}/origination", f"{out}/origination", low, high)
    perf = ingest_performance(spark, f"{raw}/performance", f"{out}/performance_defaults")
    cleaned = preprocess(orig, perf, f"{out}/cleaned")
    return engineer(cleaned, f"{out}/features", f"{out}/categories", **macros)
