from pyspark.sql import functions as F, types as T

import pytest

from lossgrain.operators import monitor as mo
from lossgrain.sources import prediction_log as pl
from lossgrain.streaming import log as sl

SCHEMA = "prediction_id string, ts timestamp, features_json string, predicted_lgd double, model_version string"
DAY = 86400


def write_batches(spark, path, *batches):
    """One file per micro-batch, in order of modification."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "prediction_id string, second long, x double, predicted_lgd double")
        df.select("prediction_id", F.timestamp_seconds("second").alias("ts"),
                  F.to_json(F.struct("x")).alias("features_json"), "predicted_lgd", F.lit("v").alias("model_version")
                  ).coalesce(1).write.parquet(f"{path}/b{i}")


def read(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


FIRST = [("a", 1 * DAY, 1.0, 0.1), ("b", 2 * DAY, 3.0, 0.3), ("a", 1 * DAY, 1.0, 0.1)]
SECOND = [("a", 1 * DAY + 60, 1.0, 0.1), ("c", 9 * DAY, 5.0, 0.5), ("d", 3 * DAY, 7.0, 0.7)]


def run(spark, stream, label, keys):
    path = sl.run_to_table(stream, label, "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
    return sl.latest(spark, path, keys, schema)


def test_log_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, FIRST, SECOND)
    out = sl.run_to_table(sl.stream_log(read(spark, path), "5 days"), "log")
    got = sorted(r.prediction_id for r in spark.read.schema(SCHEMA).parquet(out).collect())
    assert got == ["a", "b", "c", "d"]


def test_windows_equal_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, FIRST, SECOND)
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    for window, slide in (("7 days", None), ("4 days", "2 days")):
        got = run(spark, sl.stream_summary(read(spark, path), window, slide, "30 days"), "sum", ["start", "end"])
        span = F.window("ts", window, slide) if slide else F.window("ts", window)
        want = batch.groupBy(span.alias("w")).agg(F.count("*").alias("n"), F.avg("predicted_lgd").alias("m"))
        assert {(r.start, r.n_predictions, round(r.mean_predicted_lgd, 9)) for r in got.collect()} == {
            (r.w.start, r.n, round(r.m, 9)) for r in want.collect()}


def test_drift_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, FIRST, SECOND)
    baseline = spark.createDataFrame([("x", 2.0), ("y", 1.0), ("z", 0.0)], "feature string, train_mean double")
    got = run(spark, sl.stream_drift(read(spark, path), baseline, "30 days", "30 days"), "drift", ["start", "end", "feature"])
    row = got.collect()
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    want = mo.mean_shift(mo.json_feature_means(batch), baseline).first()
    assert [(r.feature, r.n, r.mean_shift) for r in row] == [("x", want.n, want.mean_shift)]


LATE = [("e", 2 * DAY, 9.0, 0.9), ("c", 9 * DAY, 5.0, 0.5), ("f", 10 * DAY, 1.0, 0.2)]


def test_a_restart_keeps_state_and_watermark(spark, tmp_path):
    """Each batch is a query of its own; repeats of earlier batches and rows behind the watermark do not come through."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate((FIRST, SECOND, LATE)):
        write_batches(spark, f"{path}/{n}", rows)
        sl.run_to_table(sl.stream_log(read(spark, path), "5 days"), "log", place=out)
    assert sorted(r.prediction_id for r in spark.read.schema(SCHEMA).parquet(out).collect()) == ["a", "b", "c", "d", "f"]
    assert spark.conf.get(sl.STATE_STORE, None) != sl.ROCKSDB  # only while the query starts


def test_late_rows_are_counted_and_kept_apart(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate((FIRST, SECOND, LATE)):
        write_batches(spark, f"{path}/{n}", rows)
        sl.write_log(read(spark, path), out, "5 days")
    sl.write_log(read(spark, path), out, "5 days")  # nothing new
    assert sorted(r.prediction_id for r in pl.read_predictions(spark, f"{out}/log").collect()) == ["a", "b", "c", "d", "f"]
    assert [r.prediction_id for r in sl.late_rows(spark, out).collect()] == ["e"]
    seen = sl.seen_batches(spark, out).orderBy("batch").collect()
    assert [(r.arrived, r.late) for r in seen] == [(3, 0), (3, 0), (3, 1)]


def test_a_batch_that_failed_half_way_is_repeated_whole(spark, tmp_path, monkeypatch):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(spark, f"{path}/0", FIRST)
    sl.write_log(read(spark, path), out, "5 days")
    write_batches(spark, f"{path}/1", SECOND)
    plain = pl.append_predictions

    def broken(*args, **kwargs):
        plain(*args, **kwargs)
        raise OSError("lost after the commit")

    with monkeypatch.context() as m:
        m.setattr(pl, "append_predictions", broken)
        with pytest.raises(Exception, match="lost after the commit"):
            sl.write_log(read(spark, path), out, "5 days")
    sl.write_log(read(spark, path), out, "5 days")
    rows = [r.prediction_id for r in pl.read_predictions(spark, f"{out}/log").collect()]
    assert sorted(rows) == ["a", "b", "c", "d"] and sl.seen_batches(spark, out).count() == 2


def test_no_batches(spark, tmp_path):
    assert sl.late_rows(spark, str(tmp_path / "none")).count() == sl.seen_batches(spark, str(tmp_path / "none")).count() == 0
