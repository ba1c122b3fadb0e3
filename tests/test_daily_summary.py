"""Daily partial aggregates: merged equals recomputed, each append is read once, repeats change nothing."""

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrain.operators import monitor as mo
from lossgrain.sources import daily_summary as dy
from lossgrain.sources import prediction_log as pl


def entries(spark, seed, n=300, days=range(0, 120)):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x = r.choice([0.0, -3.5, 1e-9, 7.0, r.lognormvariate(3, 2), -r.random()])
        body = r.choice([f'{{"x": {x}, "flag": true, "s": "t"}}', f'{{"x": {x}}}', "no json", "[1]", None])
        rows.append((f"{seed}-{i}", r.choice(list(days)) * 86_400 + r.randrange(86_400), body,
                     r.choice([None, r.random()]), x))
    return spark.createDataFrame(rows, "prediction_id string, s bigint, features_json string, predicted_lgd double, x double").select(
        "prediction_id", F.timestamp_seconds("s").alias("ts"), "features_json", "predicted_lgd", F.lit("v").alias("model_version"))


def rounded(df, *columns):
    return sorted(str(tuple(r)) for r in df.withColumns({c: F.round(c, 9) for c in columns}).select(*sorted(df.columns)).collect())


def same_as_recomputed(spark, log_path, path):
    log, partials = pl.read_predictions(spark, log_path), dy.read_partials(spark, path)
    for unit in ("day", "month", "quarter"):
        dated = log.withColumn("period_start", mo.period_start(unit))
        assert rounded(dy.period_summary(partials, unit)) == rounded(mo.prediction_summary(dated, ["period_start"]))
        assert rounded(dy.period_means(partials, unit), "serving_mean") == rounded(
            mo.json_feature_means(dated, ["period_start"]), "serving_mean")


def test_periods_are_merged_from_days(spark, tmp_path, monkeypatch):
    log_path, path = str(tmp_path / "log"), str(tmp_path / "days")
    assert dy.refresh(spark, log_path, path) is None and dy.period_summary(dy.read_partials(spark, path)).count() == 0
    pl.append_predictions(spark, log_path, entries(spark, 1))
    assert dy.refresh(spark, log_path, path) == 1
    assert dy.refresh(spark, log_path, path) is None  # a rerun changes nothing
    pl.append_predictions(spark, log_path, entries(spark, 2, days=[40, 200]).unionByName(entries(spark, 1, 50)))
    # Only the new append is read.
    folders, upto = dy.pending(spark, log_path, path)
    assert len(folders) == 1 and upto == 2
    read = pl.appended(spark, log_path, folders)
    assert read.count() == 300 and {f.split("day=")[1][:10] for f in read.inputFiles()} == {"1970-02-10", "1970-07-20"}
    assert dy.refresh(spark, log_path, path) == 2
    same_as_recomputed(spark, log_path, path)
    assert dy.compact_summary(spark, path) == 3 and dy.refresh(spark, log_path, path) is None
    same_as_recomputed(spark, log_path, path)


def test_a_compacted_log_is_not_counted_again(spark, tmp_path):
    log_path, path = str(tmp_path / "log"), str(tmp_path / "days")
    pl.append_predictions(spark, log_path, entries(spark, 1, 100))
    dy.refresh(spark, log_path, path)
    pl.append_predictions(spark, log_path, entries(spark, 2, 100))
    pl.compact_log(spark, log_path)
    pl.append_predictions(spark, log_path, entries(spark, 3, 100))
    assert dy.refresh(spark, log_path, path) == 4
    same_as_recomputed(spark, log_path, path)
    # A table that begins after the rewrite starts with it.
    late = str(tmp_path / "late")
    assert dy.refresh(spark, log_path, late) == 4
    same_as_recomputed(spark, log_path, late)


def test_refreshes_at_once_count_once(spark, tmp_path):
    log_path, path = str(tmp_path / "log"), str(tmp_path / "days")
    pl.append_predictions(spark, log_path, entries(spark, 5, 80))
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda _: dy.refresh(spark, log_path, path), range(3)))
    assert sorted(done, key=str) == [1, None, None]
    same_as_recomputed(spark, log_path, path)


def test_quantiles_are_off_by_less_than_a_cell(spark, tmp_path):
    r = np.random.default_rng(3)
    values = np.concatenate([r.lognormal(2, 3, 4000), -r.lognormal(0, 1, 1000), np.zeros(200)])
    rows = [(f"{i}", i % 90, f'{{"x": {float(v)!r}}}') for i, v in enumerate(values)]
    log = spark.createDataFrame(rows, "prediction_id string, d bigint, features_json string").select(
        "prediction_id", F.timestamp_seconds(F.col("d") * 86_400).alias("ts"), "features_json",
        F.lit(0.25).alias("predicted_lgd"), F.lit("v").alias("model_version"))
    log_path, path = str(tmp_path / "log"), str(tmp_path / "days")
    pl.append_predictions(spark, log_path, log)
    dy.refresh(spark, log_path, path)
    points = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = {r.feature: r.q for r in dy.period_quantiles(dy.read_partials(spark, path), points, "year").collect()}
    assert found["x"] == pytest.approx(list(np.quantile(values, points, method="lower")), rel=1 / dy.CELLS, abs=1e-12)
    assert found[dy.PREDICTION] == [0.25] * len(points)
