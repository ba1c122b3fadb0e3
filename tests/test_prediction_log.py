"""The partitioned log: pruned comparison, several writers, named batches, compaction."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrain.sources import commits as cm
from lossgrain.sources import prediction_log as pl


def entries(spark, ids, day=1, lgd=0.5):
    rows = [(i, day * 86_400, lgd) for i in ids]
    return spark.createDataFrame(rows, "prediction_id string, second bigint, predicted_lgd double").select(
        "prediction_id", F.timestamp_seconds("second").alias("ts"), F.lit("{}").alias("features_json"),
        "predicted_lgd", F.lit("v").alias("model_version"))


def logged(spark, path):
    return sorted((r.prediction_id, r.predicted_lgd) for r in pl.read_predictions(spark, path).collect())


def test_an_append_compares_only_with_partitions_that_may_hold_its_ids(spark, tmp_path):
    path = str(tmp_path / "log")
    for day in range(1, 7):
        pl.append_predictions(spark, path, entries(spark, [f"id-{day}-{n}" for n in range(200)], day))
    found = cm.commits(spark, path)
    new = entries(spark, ["id-3-7", "id-3-8", "id-5-1", "other"], 9)
    places = pl.partitions_for(spark, path, new, found)
    assert [p.split("day=")[1] for p in places] == ["1970-01-04", "1970-01-06"] or len(places) == 2
    scanned = pl._rows(spark, places).inputFiles()
    assert {f.split("day=")[1][:10] for f in scanned} == {"1970-01-04", "1970-01-06"}
    # Outside every range no filter is read; nothing may hold these.
    assert pl.partitions_for(spark, path, entries(spark, ["zzz"]), found) == []
    pl.append_predictions(spark, path, new)
    assert len(logged(spark, path)) == 1201


def test_many_ids_skip_the_filters_and_give_the_same_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    pl.append_predictions(spark, path, entries(spark, "abc"))
    monkeypatch.setattr(pl, "ASKED_IDS", 1)
    pl.append_predictions(spark, path, entries(spark, "bcde", 2, 0.1))
    assert logged(spark, path) == [("a", 0.5), ("b", 0.5), ("c", 0.5), ("d", 0.1), ("e", 0.1)]


def test_several_filters_a_day(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pl, "FILTER_IDS", 64)
    path, ids = str(tmp_path / "log"), [f"n{i}" for i in range(500)]
    pl.append_predictions(spark, path, entries(spark, ids))
    listed = pl.manifest(spark, path, cm.commits(spark, path)).collect()
    assert len(listed) == 8 and sum(r.n_slice for r in listed) == 500 and {r.slices for r in listed} == {8}
    assert pl.append_predictions(spark, path, entries(spark, ids[::7], 4)) is None


@pytest.mark.parametrize("writers", [2, 5])
def test_writers_at_once_leave_one_row_per_id(spark, tmp_path, writers):
    path = str(tmp_path / "log")
    pl.append_predictions(spark, path, entries(spark, ["old"]))
    ids = [f"x{i}" for i in range(40)]
    with ThreadPoolExecutor(writers) as pool:
        done = list(pool.map(
            lambda w: pl.append_predictions(spark, path, entries(spark, ["old", f"own {w}", *ids], w + 2, w / 10)), range(writers)))
    assert sorted(done) == list(range(2, 2 + writers))
    rows = logged(spark, path)
    assert sorted(r[0] for r in rows) == sorted([*ids, "old", *[f"own {w}" for w in range(writers)]])
    # The writer that committed first has all the shared ids.
    first = done.index(2) / 10
    assert {v for i, v in rows if i.startswith("x")} == {first} and dict(rows)["old"] == 0.5


def test_a_claim_is_given_once(spark, tmp_path):
    path = str(tmp_path / "table")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: cm.claim(spark, path, 1, f"token{i}"), range(8)))
    assert won.count(True) == 1
    commit, = cm.commits(spark, path)
    assert commit.token == f"token{won.index(True)}" and commit.version == 1
    assert cm.versions(spark, path) == [1]


def test_what_a_failed_writer_leaves_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    pl.append_predictions(spark, path, entries(spark, "ab"))

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(cm, "claim", fail)
        with pytest.raises(OSError):
            pl.append_predictions(spark, path, entries(spark, "bc"))
    assert [r[0] for r in logged(spark, path)] == ["a", "b"]
    pl.append_predictions(spark, path, entries(spark, "bcd"))
    assert [r[0] for r in logged(spark, path)] == ["a", "b", "c", "d"]


def test_named_batches_and_compaction(spark, tmp_path):
    path = str(tmp_path / "log")
    assert pl.compact_log(spark, path) is None
    for n in range(4):
        pl.append_predictions(spark, path, entries(spark, [f"{n}", "same"], n), batch=f"batch {n}")
    assert pl.append_predictions(spark, path, entries(spark, ["late"]), batch="batch 2") is None
    before = logged(spark, path)
    open_reader = pl.read_predictions(spark, path)
    assert pl.compact_log(spark, path) == 5
    assert logged(spark, path) == before and len(cm.commits(spark, path)) == 1
    assert open_reader.count() == len(before)
    assert pl.append_predictions(spark, path, entries(spark, ["late"]), batch="batch 2") is None
    pl.append_predictions(spark, path, entries(spark, ["same", "new"], 8), batch="batch 9")
    assert len(logged(spark, path)) == len(before) + 1


def test_days_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    both = entries(spark, "ab", 1).unionByName(entries(spark, "cd", 2)).unionByName(
        entries(spark, "e").withColumn("ts", F.lit(None).cast("timestamp")))
    pl.append_predictions(spark, path, both)
    one = pl.read_predictions(spark, path, days=("1970-01-03", "1970-01-03"))
    assert sorted(r.prediction_id for r in one.collect()) == ["c", "d"]
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    assert pl.read_predictions(spark, path).where("ts is null").count() == 1


def test_filters_hold_every_id():
    r = np.random.default_rng(1)
    own, other = (r.integers(-2**63, 2**63 - 1, 5000) for _ in range(2))
    data = pl._filter_of(own)
    assert all(pl._may_hold(data, own[i:i + 1]) for i in range(0, 5000, 50))
    assert sum(pl._may_hold(data, other[i:i + 1]) for i in range(2000)) <= 3
    assert not pl._may_hold(data, own[:0])
