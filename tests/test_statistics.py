import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lossgrain.operators import describe as ds
from lossgrain.operators import lookup as lk
from lossgrain.operators import monitor as mo
from lossgrain.operators import order_stats as os_
from lossgrain.operators import split as sp


@pytest.fixture(scope="module")
def sample(spark):
    """Two groups, one of them with half of its rows on a single value."""
    rng = np.random.default_rng(7)
    values = {
        "hot": np.concatenate([np.zeros(500), rng.lognormal(3, 4, 300), -rng.lognormal(0, 2, 201)]),
        "cold": rng.normal(0.5, 1e-6, 40),
        "one": np.array([3.25]),
    }
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("empty", None), ("hot", None)]
    return values, spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_group_quantiles_match_numpy(sample, bound, monkeypatch):
    monkeypatch.setattr(os_, "measured", lambda t, _: lk.measured(t, bound))
    values, df = sample
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in os_.quantiles(df, "v", points, ["g"]).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        assert got[g].n == len(vs)
        assert got[g].q == pytest.approx(list(np.quantile(vs, points)), rel=1e-12, abs=1e-15)


def test_overall_and_column_quantiles(sample):
    values, df = sample
    everything = np.concatenate(list(values.values()))
    assert os_.quantiles(df, "v", [0.3]).first().q[0] == pytest.approx(np.quantile(everything, 0.3))
    two = df.select(F.col("v").alias("a"), (F.col("v") * -2).alias("b"))
    got = {r.feature: r.q[0] for r in os_.column_quantiles(two, ["a", "b"], [0.5]).collect()}
    assert got == pytest.approx({"a": np.median(everything), "b": np.median(everything * -2)})


def test_cells_keep_the_order(spark):
    values = [0.0, 5e-324, 1e-300, 1e-9, 0.1, 0.5, 0.7, 1.0, 3.0, 8.0, 1e6, 1.7e308, float("inf")]
    values += [math.nextafter(2.0 ** k, d) for k in range(-60, 60, 3) for d in (-math.inf, math.inf)]
    values += [2.0 ** k for k in range(-60, 60, 3)] + [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", os_.number_cell("v").alias("c"))
    cells = [r.c for r in sorted(df.collect(), key=lambda r: r.v)]
    assert cells == sorted(cells)


def test_ecdf_counts_every_row(sample):
    values, df = sample
    everything = np.sort(np.concatenate(list(values.values())))
    rows = sorted(ds.ecdf(df, "v").collect(), key=lambda r: r.value)
    assert sum(r.n for r in rows) == len(everything) and rows[-1].last_step == 1.0
    for r in rows[::37]:
        assert r.last_step == pytest.approx(np.searchsorted(everything, r.value, "right") / len(everything))
        assert r.first_step == pytest.approx((np.searchsorted(everything, r.value, "left") + 1) / len(everything))


def test_ks_matches_definition(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 300), np.round(rng.normal(0.4, 1, 500), 1)
    frame = lambda x: spark.createDataFrame([(float(v),) for v in x], "x double")
    grid = np.concatenate([a, b])
    distance = np.abs(np.searchsorted(np.sort(a), grid, "right") / 300 - np.searchsorted(np.sort(b), grid, "right") / 500)
    row = mo.ks_statistic(frame(a), frame(b), ["x"]).first()
    assert row.ks == pytest.approx(distance.max()) and row.alert
    assert mo.ks_statistic(frame(a), frame(a), ["x"]).first().ks == 0.0


def test_describe_and_summary(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (0.4,), (None,)], "loss_given_default double")
    row = ds.lgd_summary(df).first()
    assert (row.n, row.mean_lgd, row.median_lgd) == (4, pytest.approx(0.35), pytest.approx(0.2))
    d = ds.describe(df, ["loss_given_default"]).first()
    assert (d.n, d.min, d.q25, d.q50, d.max) == (4, 0.0, 0.0, pytest.approx(0.2), 1.0)
    assert d.q75 == pytest.approx(0.55) and d.std == pytest.approx(np.std([0, 0, 1, 0.4], ddof=1))
    approximate = ds.describe(df, ["loss_given_default"], approximate=True).first()
    assert approximate.q50 in (0.0, 0.4)


def test_histogram_and_bins_match_numpy(spark):
    rng = np.random.default_rng(5)
    x, y = rng.uniform(-20, 260, 400), rng.uniform(0, 1, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    counts, edges = np.histogram(x, 30)
    got = ds.histogram(df, "x", 30).collect()
    assert {r.bin: r.n for r in got} == {i + 1: c for i, c in enumerate(counts) if c}
    bins = {r.bin: (r.mean_y, r.n) for r in ds.binned_mean(df, "x", "y").collect()}
    number = pd.cut(np.clip(x, 0, 200), 10, labels=False) + 1
    assert set(bins) == set(np.unique(number))
    for b, (mean, n) in bins.items():
        assert n == (number == b).sum() and mean == pytest.approx(y[number == b].mean())


@pytest.mark.parametrize("low, high, bins", [(0, 100, 50), (10, 110, 10), (0, 30, 30), (7, 93, 13), (5, 5, 10)])
def test_values_on_edges_fall_as_in_numpy_and_pandas(spark, low, high, bins):
    x = np.repeat(np.arange(low, high + 1) / 100, 3)
    df = spark.createDataFrame([(float(v), 0.5) for v in x] + [(None, 0.5), (float("nan"), 0.5)], "x double, y double")
    counts, edges = np.histogram(x, bins)
    rows = ds.histogram(df, "x", bins).collect()
    assert {r.bin: r.n for r in rows} == {i + 1: c for i, c in enumerate(counts) if c}
    assert [r.bin_low for r in rows] == pytest.approx([edges[r.bin - 1] for r in rows])
    number = pd.cut(x, bins, labels=False) + 1
    got = {r.bin: r.n for r in ds.binned_mean(df, "x", "y", bins).collect()}
    assert got == {b: (number == b).sum() for b in np.unique(number)}


def test_correlation_of_constant_is_null(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=50), rng.normal(size=50)
    rows = [(float(a), float(b), 7.5, None if i % 5 else float(a)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, c double, gap double").repartition(4)
    got = {r.feature: r["corr"] for r in ds.corr_with_target(df, ["x", "c", "gap"], "y").collect()}
    assert got["c"] is None
    assert got["x"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got["gap"] == pytest.approx(np.corrcoef(x[::5], y[::5])[0, 1])
    matrix = {(r.row, r.col): r["corr"] for r in ds.corr_matrix(df, ["x", "y", "c"]).collect()}
    assert set(matrix) == {("y", "x"), ("c", "x"), ("c", "y")} and matrix[("c", "x")] is None


@pytest.mark.parametrize("small", [True, False])
def test_lookup_paths_agree(spark, small):
    big = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), "id")
    table = spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = lk.lookup_join(big, table, ["k"], bound=1 << 20 if small else 0)
    assert joined.count() == 300
    assert joined.where("k < 30 and v <> k * 2").count() == 0
    assert joined.where("v is null").count() == joined.where("k >= 30").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) != small


def test_only_heavy_keys_are_salted(spark):
    """One key with a third of all rows is dealt over all salts; of the table only its row is repeated."""
    n, salts = 30_000, 8
    big = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000).cast("int").alias("k"), "id")
    big = big.unionByName(spark.range(900).select(F.lit(None).cast("int").alias("k"), (F.col("id") + n).alias("id")))
    table = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))  # a wider type
    rows, spread = lk.salted_sides(big, table, ["k"], salts)
    assert spread.count() == 2000 + salts - 1
    most = rows.groupBy("k", "_salt").count().agg(F.max("count")).first()[0]
    assert most < n // 3 // salts * 1.3
    joined = lk.attach(big, table, ["k"], salts=salts)
    assert joined.count() == n + 900
    assert joined.where("k is not null and (v is null or v <> k * 2)").count() == 0
    assert lk.attach(big, table, ["k"], how="inner", salts=salts).count() == n
    assert lk.heavy_keys(big.where("false"), ["k"], salts) == []


def test_running_counts_of_values_that_share_their_leading_bits(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = 1.0 + rng.integers(0, 3000, 20_000) * 1e-9
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert df.select(os_.number_cell("x")).distinct().count() == 1
    stored, real = [], os_.pin
    monkeypatch.setattr(os_, "pin", lambda t: stored.append(real(t)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        steps = ds.ecdf(df, "x").orderBy("value").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = stored[0].groupBy("_cell").count().collect()
    assert len(ranges) >= 3 and max(r["count"] for r in ranges) < 0.6 * sum(r["count"] for r in ranges)
    values, counts = np.unique(x, return_counts=True)
    assert [r.value for r in steps] == values.tolist() and [r.n for r in steps] == counts.tolist()
    assert [r.last_step for r in steps] == pytest.approx(np.cumsum(counts) / len(x), abs=1e-15)


def test_many_columns_correlate_in_one_scan(spark, tmp_path):
    rng = np.random.default_rng(4)
    n, p = 400, 300
    x = rng.normal(size=(n, p)) * np.exp(rng.normal(size=p) * 3) + rng.normal(size=p) * 1000
    x[:, 1] = x[:, 0] * -2
    x[rng.random((n, p)) < 0.1] = np.nan
    x[:, 5], x[:, 6] = 0.1, np.nan
    path, names = str(tmp_path / "wide"), [f"v{j}" for j in range(p)]
    spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    matrix = ds.corr_matrix(df, names)
    assert matrix._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    got = np.full((p, p), np.nan)
    for r in matrix.collect():
        got[int(r.row[1:]), int(r.col[1:])] = np.nan if r["corr"] is None else r["corr"]
    wanted = pd.DataFrame(x).corr().to_numpy()
    wanted[[5, 6], :] = wanted[:, [5, 6]] = np.nan
    below = np.tril_indices(p, -1)
    assert np.isnan(got[below]).tolist() == np.isnan(wanted[below]).tolist()
    assert np.nanmax(np.abs(got[below] - wanted[below])) < 1e-9


def rule(keys_by_stratum, seed=42, test=0.15, val=0.15):
    import hashlib
    out = {}
    for keys in keys_by_stratum.values():
        ordered = sorted(keys, key=lambda k: hashlib.md5(f"{k}:{seed}".encode()).hexdigest())
        half_up = lambda x: math.floor(x + 0.5)
        t, v = half_up(len(keys) * test), half_up(len(keys) * val)
        out |= {k: "test" if i < t else "validation" if i < t + v else "train" for i, k in enumerate(ordered)}
    return out


def test_split_follows_the_rule(spark):
    strata = {2010: [f"a{i}" for i in range(333)], 2011: [f"b{i}" for i in range(20)], 2012: ["c"], None: ["n1", "n2", "n3"]}
    rows = [(k, y) for y, keys in strata.items() for k in keys]
    df = spark.createDataFrame(rows, "loan_seq_num string, vintage_year int")
    expected = rule(strata)
    for frame in (df.coalesce(1), df.repartition(9)):
        got = {r.loan_seq_num: r.split for r in sp.split_stratified(frame).collect()}
        assert got == expected
    loose = sp.split_stratified(df, exact=False)
    assert loose.count() == len(rows) and "Exchange" not in loose._jdf.queryExecution().executedPlan().toString()


def test_split_by_vintage(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("loan_seq_num"), (2010 + F.col("id") % 6).cast("int").alias("vintage_year"))
    parts = {(r.vintage_year, r.split) for r in sp.split_by_vintage(df, 2013).collect()}
    assert {s for y, s in parts if y > 2013} == {"test"}
    assert {s for y, s in parts if y <= 2013} == {"train", "validation"}
