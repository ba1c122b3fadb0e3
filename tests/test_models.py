import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import tail_weight
from lossgrain.operators import evaluate as ev
from lossgrain.operators import model as md
from lossgrain.operators import monitor as mo
from lossgrain.operators import trees as tr
from lossgrain.plans import scoring

X = ["x0", "x1"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 2))
    y = np.clip(0.3 + 0.2 * x[:, 0] - 0.1 * x[:, 1] + 0.1 * rng.normal(size=500), 0, 1)
    rows = [(f"k{i}", float(a), float(b), float(t), i < 400) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"loan_seq_num string, x0 double, x1 double, {K.TARGET} double, train boolean").cache()


def mae(df):
    return ev.regression_metrics(df, K.TARGET, "lgd").first().mae


def test_ridge_matches_closed_form(spark, data):
    train = data.where("train").toPandas()
    model = md.fit_ridge(data.where("train"), X, penalty=0.0)
    design = np.column_stack([np.ones(len(train)), train[X]])
    exact = np.linalg.lstsq(design, train[K.TARGET], rcond=None)[0]
    scorer = md.scorer_of(model).unscaled()
    assert [scorer.intercept, *scorer.coefficients.values()] == pytest.approx(list(exact), abs=1e-6)
    assert scorer.link == "identity"
    stronger = md.scorer_of(md.fit_ridge(data.where("train"), X, penalty=1.0)).unscaled()
    assert abs(stronger.coefficients["x0"]) < abs(scorer.coefficients["x0"])


def test_models_learn_and_stay_bounded(spark, data):
    train, test = data.where("train"), data.where("not train")
    guess = np.mean(np.abs(test.toPandas()[K.TARGET] - np.random.default_rng(0).uniform(size=100)))
    for fit in (md.fit_ridge, md.fit_bounded_tail_weighted):
        scored = md.score(test, fit(train, X))
        assert mae(scored) < guess and scored.where("lgd < 0 or lgd > 1").count() == 0
    trees = md.fit_boosted_trees(train, X, rounds=3)
    assert mae(md.score(test, trees)) < guess
    importance = {r.feature: r.importance for r in md.tree_importance(spark, trees).collect()}
    assert sum(importance.values()) == pytest.approx(1.0) and importance["x0"] > importance["x1"]


def test_scorer_equals_fitted_model_whatever_the_column_order(spark, data):
    model = md.fit_bounded_tail_weighted(data.where("train"), X)
    shuffled = data.select("x1", K.TARGET, "loan_seq_num", "x0")
    a = {r.loan_seq_num: r.lgd for r in md.score(shuffled, model).collect()}
    b = {r.loan_seq_num: r.lgd for r in md.score(shuffled, md.scorer_of(model)).collect()}
    assert a == pytest.approx(b, abs=1e-12)


def test_missing_value_scores_as_the_training_mean(spark, data):
    model = md.fit_bounded_tail_weighted(data.where("train"), X)
    means = data.where("train").agg(F.avg("x0"), F.avg("x1")).first()
    rows = spark.createDataFrame([("gap", None, 0.5), ("nan", float("nan"), 0.5), ("mean", float(means[0]), 0.5)],
                                 "loan_seq_num string, x0 double, x1 double")
    scorer = md.scorer_of(model)
    for fitted in (model, scorer, md.scorer_from(md.scorer_table(spark, scorer))):
        got = {r.loan_seq_num: r.lgd for r in md.score(rows, fitted).collect()}
        assert got["gap"] == pytest.approx(got["mean"], abs=1e-12) == got["nan"]
    parts = md.linear_attributions(rows, scorer, dict(zip(X, means))).where("feature = 'x0'").collect()
    assert [r.attribution for r in parts] == pytest.approx([0.0] * 3, abs=1e-12)


def test_a_fit_cut_short_is_reported(data, caplog):
    md.fit_bounded_tail_weighted(data.where("train"), X, iterations=1)
    assert "limit of 1 iterations" in caplog.text


def test_draws_are_not_capped(spark):
    top = spark.range(1).select(md.poisson_weight(F.lit("k"), 0)).columns[0]
    assert top.count("CASE WHEN") >= 15 or top.count(">=") >= 15


def test_bootstrap_intervals(spark, data):
    members = md.fit_members(data.where("train"), X, members=4)
    scored = md.predict_with_interval(data.where("not train"), members).collect()
    assert all(0 <= r.lower <= r.upper <= 1 for r in scored)
    assert np.mean([r.upper - r.lower for r in scored]) > 0
    weights = data.select(md.poisson_weight("loan_seq_num", 0).alias("w"), md.poisson_weight("loan_seq_num", 1).alias("v"))
    row = weights.agg(F.avg("w").alias("m"), F.var_pop("w").alias("s"), F.corr("w", "v").alias("c")).first()
    assert abs(row.m - 1) < 0.15 and abs(row.s - 1) < 0.3 and abs(row.c) < 0.2


def test_members_equal_single_fits(spark, data):
    """The coefficients of a fit of its own for every member, at any partitioning."""
    train = data.where("train")
    together = md.fit_members(train.repartition(7), X, members=5)
    alone = md.fit_members(train.coalesce(1), X, members=5)
    assembler, rows, scaler = md.assemble(train, X)
    for m, scorer in enumerate(together):
        weight = md.poisson_weight(F.col("loan_seq_num").cast("string"), m) * tail_weight(K.TARGET)
        single = md._fit_logit(assembler, rows.withColumn("_w", weight).where("_w > 0"), "_w", K.TARGET, 100, 1e-14)
        wanted = md.scorer_of(md.FittedModel(single, X, scaler))
        for got in (scorer, alone[m]):
            assert got.intercept == pytest.approx(wanted.intercept, abs=1e-8)
            assert [got.coefficients[c] for c in X] == pytest.approx([wanted.coefficients[c] for c in X], abs=1e-8)


def test_passes_grow_with_iterations_only(data, monkeypatch):
    passes, real = [], md.member_sums
    monkeypatch.setattr(md, "member_sums", lambda *a: passes.append(1) or real(*a))
    counts = []
    for members in (1, 12):
        passes.clear()
        md.fit_members(data.where("train"), X, members=members)
        counts.append(len(passes))
    assert max(counts) <= min(counts) + 2 and max(counts) < 15


def test_members_of_odd_training_sets(spark, caplog):
    """A constant feature gets 0; a target beyond reach of the limit of iterations is reported; no rows give zeros."""
    rows = [(str(i), 0.3 + 0.4 * (i % 2), float(i % 2), 5.0) for i in range(200)]
    train = spark.createDataFrame(rows, f"loan_seq_num string, {K.TARGET} double, x0 double, x1 double")
    fitted = md.fit_members(train, X, members=3)
    assert all(s.coefficients["x1"] == pytest.approx(0.0, abs=1e-12) and s.coefficients["x0"] > 0.5 for s in fitted)
    md.fit_members(train, X, members=2, iterations=1)
    assert "limit of 1 iterations" in caplog.text
    none = md.fit_members(train.limit(0), X, members=2)
    assert all(s.intercept == 0.0 and set(s.coefficients.values()) == {0.0} for s in none)


def test_interval_of_known_members(spark):
    members = [md.LinearScorer(v, {"x": 0.0}, "identity") for v in (0.1, 0.5, 0.2, 0.4, 0.3)]
    row = md.predict_with_interval(spark.createDataFrame([(1.0,)], "x double"), members).first()
    assert (row.lgd, row.lower, row.upper) == pytest.approx((0.3, 0.12, 0.48))


def test_attributions_add_up(spark, data):
    scorer = md.LinearScorer(0.2, {"x0": 0.5, "x1": -1.5})
    parts = md.linear_attributions(data, scorer, md.feature_means(data.where("train"), X))
    base = data.where("train").select(scorer.linear().alias("l")).agg(F.avg("l")).first()[0]
    gap = parts.groupBy("loan_seq_num").agg(F.sum("attribution").alias("s")).join(data, "loan_seq_num").select(
        F.max(F.abs(scorer.linear() - F.lit(base) - F.col("s"))))
    assert gap.first()[0] < 1e-12
    assert [r.feature for r in md.global_importance(parts, 1).collect()] == ["x1"]
    scored = md.score(data, scorer)
    extreme = md.explain_extremes(parts, scored, 3)
    assert extreme.count() == 12
    top = scored.orderBy(F.desc("lgd")).first().loan_seq_num
    assert extreme.where((F.col("loan_seq_num") == top) & (F.col("extreme") == "high")).count() == 2


def test_scenarios_and_monotonic(spark):
    loans = spark.createDataFrame([(90.0, 0.0, 7.5), (120.0, -0.1, 9.0)], "ltv_at_default double, hpi_change double, unemployment_rate_at_default double")
    rising = md.LinearScorer(-2.0, {"ltv_at_default": 0.01, "hpi_change": -1.0, "unemployment_rate_at_default": 0.05})
    results = md.macro_scenarios(loans, rising)
    assert [r.scenario for r in results.collect()] == ["base", "mild", "moderate", "severe"]
    assert ev.check_monotonic(results).first().monotonic
    falling = md.LinearScorer(0.0, {"hpi_change": 1.0, "unemployment_rate_at_default": 0.0})
    assert not ev.check_monotonic(md.macro_scenarios(loans, falling)).first().monotonic
    moved = md.macro_scenarios(loans, rising, recompute=True).collect()
    fixed = results.collect()
    assert moved[0].mean_lgd == pytest.approx(fixed[0].mean_lgd) and moved[3].mean_lgd > fixed[3].mean_lgd


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "p double, y double")


def test_weighted_loss(spark):
    loss = lambda alpha, *rows: ev.weighted_mse(pairs(spark, *rows), "y", "p", alpha).first()[0]
    assert loss(2.0, (0.5, 0.6)) == pytest.approx(0.0108)
    assert loss(2.0, (0.0, 0.1)) == pytest.approx(0.0228)
    assert loss(2.0, *[(v, v) for v in (0.0, 0.25, 0.5, 0.75, 1.0)]) == 0.0
    assert loss(0.0, *zip((0.2, 0.5, 0.8, 0.1, 0.9), (0.3, 0.4, 0.9, 0.2, 0.8))) == pytest.approx(0.01)


def test_metrics_comparison_criteria(spark):
    row = ev.regression_metrics(pairs(spark, (0.0, 0.0), (1.0, 0.5), (0.5, 1.0)), "y", "p").first()
    assert (row.n, row.mae, row.rmse) == (3, pytest.approx(1 / 3), pytest.approx(np.sqrt(0.5 / 3)))
    assert row.r2 == pytest.approx(1 - 0.5 / 0.5)
    assert ev.regression_metrics(pairs(spark, (0.1, 0.5), (0.2, 0.5)), "y", "p").first().r2 is None
    metrics = spark.createDataFrame([("segment_average", 0.2, 0.3, 0.1), ("m", 0.16, 0.28, 0.35)],
                                    "model string, mae double, rmse double, r2 double")
    table = ev.model_comparison(metrics)
    got = {r.model: r.mae_improvement for r in table.collect()}
    assert got == {"segment_average": None, "m": 20.0}
    calibrated = spark.createDataFrame([(True,), (False,)], "within_tolerance boolean")
    monotonic = spark.createDataFrame([(True,)], "monotonic boolean")
    verdict = {r.criterion: r.passed for r in ev.success_criteria(table, "m", calibrated, monotonic).collect()}
    assert verdict == {"mae_improvement": True, "rmse_improvement": False, "r2": True,
                       "calibration": False, "macro_monotonic": True}


def test_calibration_bins_are_equal(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("p"), (F.col("id") / 1000 + 0.04).alias("y"))
    rows = ev.calibration(df, "y", "p").collect()
    assert [r.n for r in rows] == [100] * 10 and all(r.within_tolerance for r in rows)
    assert rows[0].gap == pytest.approx(-0.04)


def test_unseen_segment_takes_overall_mean(spark):
    schema = f"property_type string, occupancy_status string, vintage_year int, {K.TARGET} double"
    train = spark.createDataFrame([("SF", "P", 2010, 0.2), ("SF", "P", 2010, 0.4), ("CO", "P", 2010, 0.9)], schema)
    test = spark.createDataFrame([("SF", "P", 2010, 0.0), ("MH", "P", 2010, 0.0), (None, "P", 2010, 0.0)], schema)
    for bound in (1 << 20, 0):
        scored = ev.apply_segment_benchmark(test, ev.segment_benchmark(train), bound=bound).collect()
        assert sorted(r.prediction for r in scored) == pytest.approx([0.3, 0.5, 0.5])


LOG = "prediction_id string, second int, features_json string, predicted_lgd double, model_version string"


def log(spark, *rows):
    df = spark.createDataFrame(rows, LOG)
    return df.withColumn("ts", F.timestamp_seconds("second")).drop("second")


def test_json_means(spark):
    entries = log(spark, ("a", 0, '{"x": 1, "flag": true, "name": "n", "gap": null}', 0.2, "v"),
                  ("b", 86400, '{"x": 2.5, "flag": false, "x2": 1e2}', 0.4, "v"),
                  ("c", 0, "[1, 2]", 0.3, "v"), ("d", 0, "{broken", 0.3, "v"), ("e", 0, "7", 0.3, "v"), ("f", 0, None, 0.3, "v"))
    means = {r.feature: (r.serving_mean, r.n) for r in mo.json_feature_means(entries).collect()}
    assert means == {"x": (1.75, 2), "flag": (0.5, 2), "x2": (100.0, 1)}
    row = mo.prediction_summary(entries).first()
    assert (row.n_predictions, row.mean_predicted_lgd, row.period) == (6, 0.3, "1970-01-01 00:00:00 to 1970-01-02 00:00:00")
    empty = mo.prediction_summary(entries.limit(0)).first()
    assert (empty.n_predictions, empty.mean_predicted_lgd, empty.period) == (0, None, None)


def test_score_log_and_monitor(spark, tmp_path):
    good = dict(loan_seq_num="1", orig_ltv=85.0, orig_upb=250000.0, orig_interest_rate=4.5, orig_term=360,
                ltv_at_default=105.0, months_delinquent_at_default=6, hpi_change=-0.15,
                unemployment_rate_at_default=8.5, property_type="SF", occupancy_status="P", channel="R", state="CA")
    schema = ("loan_seq_num string, orig_ltv double, orig_upb double, orig_interest_rate double, orig_term int, "
              "ltv_at_default double, months_delinquent_at_default int, hpi_change double, "
              "unemployment_rate_at_default double, property_type string, occupancy_status string, channel string, state string")
    loans = spark.createDataFrame([tuple(good.values()), tuple({**good, "loan_seq_num": "2", "state": "CAL"}.values())], schema)
    members = [md.LinearScorer(v, {"ltv_at_default": 0.01, "state": 0.1}) for v in (-1.0, -0.9, -1.1)]
    path = str(tmp_path / "log")
    for _ in range(2):  # the retry logs nothing new
        answer, rejected = scoring.score_portfolio(loans, members, ["loan_seq_num"], "run", "v1", path)
    row = answer.first()
    assert row.confidence_interval_90.lower <= row.lgd <= row.confidence_interval_90.upper
    assert [r.violations for r in rejected.collect()] == [["state"]]
    baseline = spark.createDataFrame(list(K.TRAINING_MEANS.items()), "feature string, train_mean double")
    summary, means, drift = scoring.monitoring_summary(spark, path, baseline)
    assert summary.first().n_predictions == 1
    shifts = {r.feature: r.mean_shift for r in drift.collect()}
    assert shifts == {"orig_ltv": 0.0828, "orig_upb": 0.1364, "orig_interest_rate": 0.0, "orig_term": 0.0619,
                      "ltv_at_default": 0.1053, "months_delinquent_at_default": 0.3333, "hpi_change": 2.0,
                      "unemployment_rate_at_default": 0.1333}
    assert {r.feature for r in drift.where("alert").collect()} == {f for f, s in shifts.items() if s > 0.1}


def test_rank_stability(spark):
    frame = lambda **v: spark.createDataFrame(list(v.items()), "feature string, importance double")
    old, new = frame(a=5.0, b=4.0, c=3.0, d=2.0, e=1.0), frame(a=1.0, b=5.0, c=4.0, d=3.0, f=2.0)
    got = {r.feature: (r.previous_rank, r.current_rank, r.alert) for r in mo.rank_stability(old, new).collect()}
    assert got == {"a": (1, 5, True), "b": (2, 1, False), "c": (3, 2, False), "d": (4, 3, False)}


def known_value(nodes, weights, x, known):
    """Mean of the trees where features outside ``known`` are weighted by cover."""
    place = {(r.tree, r.node): r for r in nodes}

    def walk(tree, number):
        r = place[tree, number]
        if r.left < 0:
            return r.prediction
        if r.feature in known:
            return walk(tree, r.left if x[r.feature] <= r.threshold else r.right)
        return sum(place[tree, c].cover / r.cover * walk(tree, c) for c in (r.left, r.right))

    return sum(w * walk(t, 0) for t, w in enumerate(weights))


def test_tree_attributions_equal_all_subsets(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = np.clip(0.4 + 0.2 * x[:, 0] * x[:, 1] + 0.1 * np.sin(3 * x[:, 2]), 0, 1)
    names = ["a", "b", "c"]
    rows = [(f"k{i}", *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    rows.append(("gap", None, float("nan"), 0.5, None))
    schema = f"loan_seq_num string, a double, b double, c double, {K.TARGET} double"
    df = spark.createDataFrame(rows, schema)
    model = md.fit_boosted_trees(df.where(f"{K.TARGET} is not null"), names, rounds=4, depth=4, alpha=2.0)
    table, weights = tr.tree_nodes(spark, model), model.pipeline.stages[1].treeWeights
    leaves, nodes = tr.tree_leaves(table, weights), table.collect()
    got = {}
    for r in tr.tree_attributions(df, model, leaves).collect():
        got.setdefault(r.loan_seq_num, {})[r.feature] = r.attribution
    inputs = {r.loan_seq_num: [r[f"_x_{c}"] for c in names] for r in md.standardised(df, names, model.scaler).collect()}
    raw = {r.loan_seq_num: r.lgd for r in model.pipeline.transform(md.standardised(df, names, model.scaler)).collect()}
    assert len(got) == 301 and tr.tree_baseline(leaves) == pytest.approx(known_value(nodes, weights, [], ()))
    for k, parts in got.items():
        assert tr.tree_baseline(leaves) + sum(parts.values()) == pytest.approx(raw[k], abs=1e-12)
    for k in ["gap", *[f"k{i}" for i in range(0, 300, 23)]]:
        for i, c in enumerate(names):
            others = [j for j in range(3) if j != i]
            wanted = sum(
                math.factorial(n) * math.factorial(2 - n) / 6
                * (known_value(nodes, weights, inputs[k], {*s, i}) - known_value(nodes, weights, inputs[k], set(s)))
                for n in range(3) for s in itertools.combinations(others, n))
            assert got[k][c] == pytest.approx(wanted, abs=1e-12)
    gains = np.zeros(3)
    for r in nodes:
        if r.left >= 0:
            gains[r.feature] += r.gain * r.cover
    shares = [r.importance for r in md.tree_importance(spark, model).collect()]
    assert shares == pytest.approx(list(gains / gains.sum()), abs=1e-9)


def test_tree_attributions_of_stumps_and_no_rows(spark, data):
    flat = data.where("train").withColumn(K.TARGET, F.lit(0.5))
    model = md.fit_boosted_trees(flat, X, rounds=2)
    leaves = tr.tree_leaves(tr.tree_nodes(spark, model), model.pipeline.stages[1].treeWeights)
    assert {r.attribution for r in tr.tree_attributions(flat, model, leaves).collect()} == {0.0}
    assert tr.tree_baseline(leaves) == pytest.approx(0.5)
    assert tr.tree_attributions(flat.limit(0), model, leaves).count() == 0


def grown_leaves(rng, trees, depth, limits):
    """Leaves of random trees that split at ``limits`` (features x thresholds)."""
    out = []

    def grow(left, path):
        f = int(rng.integers(len(limits)))
        low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
        inner = [v for v in limits[f] if low < v < high]
        if not left or not inner:
            names = sorted(path)
            ends = (np.array([path[n][k] for n in names], float) for k in range(3))
            out.append(tr.Leaf(rng.normal(), np.array(names, int), *ends))
            return
        at, part = inner[rng.integers(len(inner))], rng.uniform(0.1, 0.9)
        grow(left - 1, {**path, f: (low, at, share * part)})
        grow(left - 1, {**path, f: (at, high, share * (1 - part))})

    for _ in range(trees):
        grow(depth, {})
    return out


def parts_by_leaf(leaves, x):
    """Every leaf on its own, for every row."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        own = x[:, leaf.features]
        out[:, leaf.features] += leaf.parts(((own > leaf.low) & (own <= leaf.high)).astype(float))
    return out


@pytest.mark.parametrize("depth", [1, 4, 6])
@pytest.mark.parametrize("cells", [1, 30, tr.CELLS])
def test_tables_of_parts_equal_the_leaves(depth, cells):
    rng = np.random.default_rng(21)
    limits = np.sort(rng.normal(size=(6, 9)), axis=1)
    leaves = grown_leaves(rng, 3, depth, limits)
    x = rng.normal(size=(400, 6))
    x[::3] = limits[:, rng.integers(9, size=134)].T  # on the thresholds themselves
    x[1], x[2] = 1.7976931348623157e308, -1.7976931348623157e308
    attributor = tr.Attributor(leaves, cells)
    assert attributor.parts(np.ascontiguousarray(x.T)).T == pytest.approx(parts_by_leaf(leaves, x), abs=1e-12)
    assert (cells > 1) == bool(attributor.tables) and all(t.parts.shape[1] <= cells for t in attributor.tables)


def test_attributions_take_a_look_per_tree_and_row():
    rng = np.random.default_rng(22)
    leaves = grown_leaves(rng, 20, 4, np.sort(rng.normal(size=(12, 31)), axis=1))
    x = rng.normal(size=(50_000, 12))
    began = time.process_time()
    parts = tr.attribution_matrix(leaves, x)
    assert time.process_time() - began < 6
    assert parts[:200] == pytest.approx(parts_by_leaf(leaves, x[:200]), abs=1e-12)
