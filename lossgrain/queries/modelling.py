"""Queries of splits, benchmarks, models and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import clip, tail_weight
from lossgrain.operators import evaluate as ev
from lossgrain.operators import features as ft
from lossgrain.operators import model as md
from lossgrain.operators import split as sp
from lossgrain.operators import trees as tr
from lossgrain.queries.describing import histogram_sql
from lossgrain.queries.features import encoded
from lossgrain.queries.registry import query, r, rounded, rs
from lossgrain.queries.testbed import cleaned, features, sql
from lossgrain.session import pin

Y = K.TARGET

# --- splits and the segment benchmark -------------------------------------

SPLIT = """parts AS (
  SELECT * EXCLUDE (place, n), CASE WHEN place <= round(n * 0.15) THEN 'test'
    WHEN place <= 2 * round(n * 0.15) THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY vintage_year ORDER BY md5(loan_seq_num || ':42')) AS place,
    count(*) OVER (PARTITION BY vintage_year) AS n FROM cleaned))"""


def parts(spark, d):
    return sp.split_stratified(pin(cleaned(spark, d)))


@query("m1_split_stratified", sql("SELECT loan_seq_num, vintage_year, split FROM parts", "cleaned", extra=SPLIT))
def m1(spark, d):
    return parts(spark, d).select("loan_seq_num", "vintage_year", "split")


@query("m1_split_by_hash", sql("""SELECT loan_seq_num, CASE WHEN h < '26666666' THEN 'test'
  WHEN h <= '4ccccccc' THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT loan_seq_num, substr(md5(loan_seq_num || ':42'), 1, 8) AS h FROM cleaned)""", "cleaned"))
def m1_hash(spark, d):
    return sp.split_stratified(cleaned(spark, d), exact=False).select("loan_seq_num", "split")


@query("m2_split_by_vintage", sql("""SELECT loan_seq_num, CASE WHEN vintage_year > 1998 THEN 'test'
  WHEN row_number() OVER (PARTITION BY vintage_year ORDER BY md5(loan_seq_num || ':42'))
    <= round(count(*) OVER (PARTITION BY vintage_year) * 0.15) THEN 'validation' ELSE 'train' END AS split
  FROM cleaned""", "cleaned"))
def m2(spark, d):
    return sp.split_by_vintage(pin(cleaned(spark, d)), 1998).select("loan_seq_num", "split")


SEGMENTS = SPLIT + f""",
segments AS (SELECT property_type, occupancy_status, vintage_year, avg({Y}) AS segment_mean, count(*) AS n
  FROM parts WHERE split = 'train' GROUP BY ALL)"""
PREDICTED = SEGMENTS + f""",
predicted AS (SELECT p.*, coalesce(s.segment_mean, (SELECT sum(segment_mean * n) / sum(n) FROM segments)) AS prediction
  FROM parts p LEFT JOIN segments s ON p.property_type = s.property_type
    AND p.occupancy_status = s.occupancy_status AND p.vintage_year = s.vintage_year),
tests AS (SELECT * FROM predicted WHERE split = 'test')"""


def segments(spark, d, split):
    return ev.segment_benchmark(split.where(F.col("split") == "train"))


def predicted(spark, d):
    split = parts(spark, d)
    return ev.apply_segment_benchmark(split, segments(spark, d, split))


def tests(spark, d):
    return predicted(spark, d).where(F.col("split") == "test")


@query("a8_segment_benchmark", sql(f"""SELECT property_type, occupancy_status, vintage_year,
  {rs('segment_mean')} AS segment_mean, n FROM segments""", "cleaned", extra=SEGMENTS))
def a8(spark, d):
    return rounded(segments(spark, d, parts(spark, d)), ["segment_mean"])


@query("j5_apply_segment_benchmark", sql(f"SELECT loan_seq_num, {rs('prediction')} AS prediction FROM tests",
                                         "cleaned", extra=PREDICTED))
def j5(spark, d):
    return rounded(tests(spark, d), ["prediction"]).select("loan_seq_num", "prediction")


# --- evaluation of the benchmark ------------------------------------------

def metrics_sql(p: str, source: str) -> str:
    return f"""count(*) AS n, avg(abs({p} - {Y})) AS mae, sqrt(avg(({p} - {Y}) * ({p} - {Y}))) AS rmse,
    1 - avg(({p} - {Y}) * ({p} - {Y})) / var_pop({Y}) AS r2 FROM {source}"""


M9_ROUND = f"n, {rs('mae')} AS mae, {rs('rmse')} AS rmse, {rs('r2')} AS r2"


@query("m9_regression_metrics", sql(f"""SELECT split, {M9_ROUND} FROM (
  SELECT split, {metrics_sql('prediction', 'predicted')} GROUP BY split)""", "cleaned", extra=PREDICTED))
def m9(spark, d):
    return rounded(ev.regression_metrics(predicted(spark, d), Y, "prediction", ["split"]), ["mae", "rmse", "r2"])


@query("m10_weighted_mse", sql(f"""SELECT {rs(f'''avg((1 + CAST(2 AS DOUBLE) * pow(2 * abs({Y} - CAST(0.5 AS DOUBLE)), 2))
  * pow(prediction - {Y}, 2))''')} AS weighted_mse FROM tests""", "cleaned", extra=PREDICTED))
def m10(spark, d):
    return rounded(ev.weighted_mse(tests(spark, d), Y, "prediction"), ["weighted_mse"])


SHRUNK = "(prediction * CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * loss_given_default)"
M11 = PREDICTED + f""",
measured AS (SELECT 'segment_average' AS model, {metrics_sql('prediction', 'tests')}
  UNION ALL SELECT 'half_known' AS model, {metrics_sql(SHRUNK, 'tests')}),
compared AS (SELECT model, {rs('mae')} AS mae, {rs('rmse')} AS rmse, {rs('r2')} AS r2,
  CASE WHEN model <> 'segment_average' THEN {rs('(b_mae - mae) / b_mae * 100', 1)} END AS mae_improvement,
  CASE WHEN model <> 'segment_average' THEN {rs('(b_rmse - rmse) / b_rmse * 100', 1)} END AS rmse_improvement
  FROM measured, (SELECT mae AS b_mae, rmse AS b_rmse FROM measured WHERE model = 'segment_average'))"""


def comparison(scored):
    """The benchmark beside a forecast that knows half of the outcome."""
    scored = scored.withColumn("half_known", F.col("prediction") * 0.5 + F.lit(0.5) * F.col(Y))
    measured = [
        ev.regression_metrics(scored, Y, p).withColumn("model", F.lit(name))
        for name, p in [("segment_average", "prediction"), ("half_known", "half_known")]
    ]
    return ev.model_comparison(pin(measured[0].unionByName(measured[1])))


@query("m11_model_comparison", sql("SELECT * FROM compared", "cleaned", extra=M11))
def m11(spark, d):
    table = comparison(tests(spark, d))
    table = rounded(table, ["mae", "rmse", "r2"])
    return rounded(table, ["mae_improvement", "rmse_improvement"], 1)


M12 = PREDICTED + f""",
cuts AS (SELECT quantile_cont(prediction, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM predicted),
deciles AS (SELECT bin, count(*) AS n, avg(prediction) AS mean_predicted, avg({Y}) AS mean_actual FROM (
  SELECT prediction, {Y}, CAST(1 + len(list_filter(q, lambda c: prediction > c)) AS INTEGER) AS bin FROM predicted, cuts)
  GROUP BY bin),
calibrated AS (SELECT *, mean_predicted - mean_actual AS gap, abs(mean_predicted - mean_actual) <= 0.05 AS within_tolerance
  FROM deciles)"""


@query("m12_calibration", sql(f"""SELECT bin, n, {rs('mean_predicted')} AS mean_predicted, {rs('mean_actual')} AS mean_actual,
  {rs('gap')} AS gap, within_tolerance FROM calibrated""", "cleaned", extra=M12))
def m12(spark, d):
    return rounded(ev.calibration(predicted(spark, d), Y, "prediction"), ["mean_predicted", "mean_actual", "gap"])


@query("m13_residual_summary", sql(f"""SELECT count(*) AS n, {rs('avg(e)')} AS mean_residual, {rs('stddev_pop(e)')} AS std_residual,
  count(*) FILTER (WHERE abs(e) > 0.3) AS n_large,
  {rs('100.0 * count(*) FILTER (WHERE abs(e) > 0.3) / count(*)')} AS pct_large
  FROM (SELECT prediction - {Y} AS e FROM predicted)""", "cleaned", extra=PREDICTED))
def m13(spark, d):
    summary = ev.residual_summary(predicted(spark, d), Y, "prediction")
    return rounded(summary, ["mean_residual", "std_residual", "pct_large"])


M14 = ["property_type", "channel", "state"]


@query("m14_residuals_by_segment", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS segment, {c} AS value, {rs(f'avg(prediction - {Y})')} AS mean_error,
    {rs(f'avg(abs(prediction - {Y}))')} AS mae, count(*) AS n FROM predicted WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in M14), "cleaned", extra=PREDICTED))
def m14(spark, d):
    table = ev.residuals_by_segment(predicted(spark, d), Y, "prediction", M14)
    return rounded(table, ["mean_error", "mae"])


# --- scoring with given coefficients --------------------------------------

SCORER = md.LinearScorer(-1.5, {
    "ltv_at_default": 0.012,
    "hpi_change": -0.8,
    "unemployment_rate_at_default": 0.05,
    "months_delinquent_at_default": 0.02,
    "orig_interest_rate": 0.03,
    "orig_ltv": 0.004,
    "orig_term": -0.0005,
})
MEANS = {"ltv_at_default": 80.0, "hpi_change": 0.01, "unemployment_rate_at_default": 5.0,
         "months_delinquent_at_default": 3.2, "orig_interest_rate": 5.5, "orig_ltv": 85.0, "orig_term": 315.0}


def score_sql(scorer: md.LinearScorer) -> str:
    terms = " + ".join(f"CAST({b!r} AS DOUBLE) * {c}" for c, b in scorer.coefficients.items())
    return f"1 / (1 + exp(-(CAST({scorer.intercept!r} AS DOUBLE) + {terms})))"


SCORED = f"scored AS (SELECT *, {score_sql(SCORER)} AS lgd FROM features)"


@query("m6_score", sql(f"SELECT loan_seq_num, {rs('lgd')} AS lgd FROM scored", "features", extra=SCORED))
def m6(spark, d):
    return rounded(md.score(features(spark, d), SCORER), ["lgd"]).select("loan_seq_num", "lgd")


MEMBERS = [
    md.LinearScorer(SCORER.intercept + 0.1 * (k % 3), {
        c: b * (1.0 + 0.05 * ((k * 7 + i) % 5 - 2)) for i, (c, b) in enumerate(SCORER.coefficients.items())
    })
    for k in range(7)
]
INTERVALS = "drawn AS (" + " UNION ALL ".join(
    f"SELECT loan_seq_num, {score_sql(m)} AS p FROM features" for m in MEMBERS) + """),
intervals AS (SELECT loan_seq_num, avg(p) AS lgd, quantile_cont(p, 0.05) AS lower, quantile_cont(p, 0.95) AS upper
  FROM drawn GROUP BY loan_seq_num)"""


@query("m7_interval_of_members", sql(f"""SELECT loan_seq_num, {rs('lgd')} AS lgd, {rs('lower')} AS lower,
  {rs('upper')} AS upper FROM intervals""", "features", extra=INTERVALS))
def m7_given(spark, d):
    scored = md.predict_with_interval(features(spark, d), MEMBERS)
    return rounded(scored, ["lgd", "lower", "upper"]).select("loan_seq_num", "lgd", "lower", "upper")


@query("m8_interval_width", sql(f"SELECT loan_seq_num, {rs('upper - lower')} AS interval_width FROM intervals",
                                "features", extra=INTERVALS))
def m8(spark, d):
    scored = ev.interval_width(md.predict_with_interval(features(spark, d), MEMBERS))
    return rounded(scored, ["interval_width"]).select("loan_seq_num", "interval_width")


@query("m8_interval_summary", sql(f"SELECT count(*) AS n, {rs('avg(upper - lower)')} AS mean_width FROM intervals",
                                  "features", extra=INTERVALS))
def m8_summary(spark, d):
    scored = md.predict_with_interval(features(spark, d), MEMBERS)
    return rounded(ev.interval_summary(scored), ["mean_width"])


STRESSED = "stressed AS (SELECT * REPLACE (hpi_change + d_hpi AS hpi_change, " \
           "unemployment_rate_at_default + d_unemployment AS unemployment_rate_at_default), scenario, severity " \
           "FROM features CROSS JOIN (SELECT * FROM (VALUES " + ", ".join(
               f"('{n}', {s}, CAST({u} AS DOUBLE), CAST({h} AS DOUBLE))" for n, s, u, h in K.SCENARIOS
           ) + f""") AS s(scenario, severity, d_unemployment, d_hpi))),
outcomes AS (SELECT scenario, severity, count(*) AS n, avg({score_sql(SCORER)}) AS mean_lgd FROM stressed
  GROUP BY scenario, severity)"""


@query("m15_macro_scenarios", sql(f"SELECT scenario, severity, n, {rs('mean_lgd')} AS mean_lgd FROM outcomes",
                                  "features", extra=STRESSED))
def m15(spark, d):
    return rounded(md.macro_scenarios(features(spark, d), SCORER), ["mean_lgd"])


@query("m16_check_monotonic", sql("""SELECT bool_and(ok) AS monotonic FROM (
  SELECT coalesce(mean_lgd >= lag(mean_lgd) OVER (ORDER BY severity), true) AS ok FROM outcomes)""",
    "features", extra=STRESSED))
def m16(spark, d):
    return ev.check_monotonic(md.macro_scenarios(features(spark, d), SCORER))


ATTRIBUTED = "attributed AS (" + " UNION ALL ".join(
    f"""SELECT loan_seq_num, '{c}' AS feature, CAST({c} AS DOUBLE) AS value,
    CAST({b!r} AS DOUBLE) * ({c} - CAST({MEANS[c]!r} AS DOUBLE)) AS attribution FROM features"""
    for c, b in SCORER.coefficients.items()) + ")"


def attributions(loans):
    return md.linear_attributions(loans, SCORER, MEANS)


@query("m17_linear_attributions", sql(f"""SELECT loan_seq_num, feature, {rs('value')} AS value,
  {rs('attribution')} AS attribution FROM attributed""", "features", extra=ATTRIBUTED))
def m17(spark, d):
    return rounded(attributions(features(spark, d)), ["value", "attribution"])


@query("m18_global_importance", sql(f"""SELECT feature, {rs('avg(abs(attribution))')} AS mean_abs FROM attributed
  GROUP BY feature ORDER BY avg(abs(attribution)) DESC, feature LIMIT 5""", "features", extra=ATTRIBUTED))
def m18(spark, d):
    return rounded(md.global_importance(attributions(features(spark, d))), ["mean_abs"])


@query("m19_explain_extremes", sql(f"""SELECT a.loan_seq_num, a.feature, {rs('a.attribution')} AS attribution, e.extreme
  FROM attributed a JOIN (
    (SELECT loan_seq_num, 'high' AS extreme FROM scored ORDER BY round(lgd, 6) DESC, loan_seq_num LIMIT 5)
    UNION ALL (SELECT loan_seq_num, 'low' FROM scored ORDER BY round(lgd, 6), loan_seq_num LIMIT 5)) e
  ON a.loan_seq_num = e.loan_seq_num""", "features", extra=SCORED + ",\n" + ATTRIBUTED))
def m19(spark, d):
    loans = pin(features(spark, d))
    scored = md.score(loans, SCORER).withColumn("lgd", F.round("lgd", 6))
    extremes = md.explain_extremes(attributions(loans), scored, 5)
    return rounded(extremes, ["attribution"]).select("loan_seq_num", "feature", "attribution", "extreme")


M20 = M11 + M12[len(PREDICTED):] + ",\n" + STRESSED


@query("m20_success_criteria", sql("""SELECT criterion, actual, target, passed FROM (
  SELECT 'mae_improvement' AS criterion, mae_improvement AS actual, CAST(15 AS DOUBLE) AS target,
    mae_improvement >= 15 AS passed FROM compared WHERE model = 'half_known'
  UNION ALL SELECT 'rmse_improvement', rmse_improvement, CAST(10 AS DOUBLE), rmse_improvement >= 10 FROM compared
    WHERE model = 'half_known'
  UNION ALL SELECT 'r2', r2, CAST(0.3 AS DOUBLE), r2 > 0.3 FROM compared WHERE model = 'half_known'
  UNION ALL SELECT 'calibration', NULL, NULL, bool_and(within_tolerance) FROM calibrated
  UNION ALL SELECT 'macro_monotonic', NULL, NULL, bool_and(ok) FROM (
    SELECT coalesce(mean_lgd >= lag(mean_lgd) OVER (ORDER BY severity), true) AS ok FROM outcomes))""",
    "features", extra=M20))
def m20(spark, d):
    scored = predicted(spark, d)
    table = comparison(scored.where(F.col("split") == "test"))
    calibrated = pin(ev.calibration(scored, Y, "prediction"))
    monotonic = ev.check_monotonic(pin(md.macro_scenarios(features(spark, d), SCORER)))
    criteria = ev.success_criteria(table, "half_known", calibrated, monotonic)
    return rounded(criteria, ["actual"])


# --- fits ------------------------------------------------------------------

def matrix(spark, d):
    """Encoded model matrix with its split, computed once for the fits."""
    table = ft.feature_matrix(encoded(spark, d), keep=["loan_seq_num"])
    return pin(sp.split_stratified(pin(table)))


def train_of(table):
    return table.where(F.col("split") == "train")


def facts_sql(*flags: str) -> str:
    """Rows per split, and facts that hold for every right fit."""
    return sql("SELECT split, count(*) AS n" + "".join(f", true AS {f}" for f in flags) + " FROM parts GROUP BY split",
               "cleaned", extra=SPLIT)


def facts(scored, **flags):
    """Rows per split beside flags that were computed over all rows."""
    within = F.bool_and(F.col("lgd").between(0.0, 1.0)).alias("within_bounds")
    return scored.groupBy("split").agg(F.count("lgd").alias("n"), within).withColumns(flags)


def largest_score(train, model, weight, penalty=0.0):
    """Largest component of the mean score equations of a fitted linear or logit model."""
    scorer = md.scorer_of(model)
    error = F.lit(1.0) * weight * (F.col(Y) - scorer.column())
    rows = train.where(F.col(Y).isNotNull()).agg(F.avg(error).alias("intercept"), *[
        (F.avg(error * scorer.input(c, F.col(c))) - F.lit(penalty * b)).alias(c) for c, b in scorer.coefficients.items()])
    return max(abs(v) for v in rows.first())


@query("m3_fit_ridge", facts_sql("within_bounds", "solved"))
def m3(spark, d):
    table = matrix(spark, d)
    model = md.fit_ridge(train_of(table), K.FEATURES, penalty=0.1)
    # The fit standardises the loss, too, and penalises in these units.
    spread = train_of(table).agg(F.stddev_pop(Y)).first()[0]
    solved = largest_score(train_of(table), model, F.lit(1.0), 0.1 / spread) < 1e-8
    return facts(md.score(table, model), solved=F.lit(solved))


@query("m4_fit_boosted_trees", facts_sql("within_bounds", "shares_add_up", "better_than_mean"))
def m4(spark, d):
    table = matrix(spark, d)
    model = md.fit_boosted_trees(train_of(table), K.FEATURES)
    scored = pin(md.score(table, model))
    error = lambda p: F.avg((F.col(Y) - p) * (F.col(Y) - p))
    mean = train_of(scored).agg(F.avg(Y)).first()[0]
    row = train_of(scored).agg(error(F.col("lgd")).alias("model"), error(F.lit(mean)).alias("mean")).first()
    shares = md.tree_importance(spark, model).agg(F.sum("importance")).first()[0]
    return facts(scored, shares_add_up=F.lit(abs(shares - 1) < 1e-9), better_than_mean=F.lit(row.model < row["mean"]))


@query("m4_gain_importance", "SELECT " + f"{len(K.FEATURES)} AS n_features, true AS all_known, true AS not_negative")
def m4_importance(spark, d):
    table = md.tree_importance(spark, md.fit_boosted_trees(train_of(matrix(spark, d)), K.FEATURES))
    return table.agg(F.count("*").cast("int").alias("n_features"),
                     F.bool_and(F.col("feature").isin(list(K.FEATURES))).alias("all_known"),
                     F.bool_and(F.col("importance") >= 0).alias("not_negative"))


@query("m4_tree_attributions", facts_sql("adds_up", "differs", "gains_agree"))
def m4_attributions(spark, d):
    """Parts of every loan beside its score; gains of the nodes beside the shares that the fit reports."""
    table = matrix(spark, d)
    model = md.fit_boosted_trees(train_of(table), K.FEATURES)
    nodes = pin(tr.tree_nodes(spark, model))
    leaves = tr.tree_leaves(nodes, model.pipeline.stages[1].treeWeights)
    parts = tr.tree_attributions(table, model, leaves).groupBy("loan_seq_num").agg(
        F.sum("attribution").alias("moved"))
    gains = nodes.where("left >= 0").groupBy(
        F.element_at(F.array(*map(F.lit, model.features)), F.col("feature") + 1).alias("feature")).agg(
            F.sum(F.col("gain") * F.col("cover")).alias("gain"))
    whole = gains.agg(F.sum("gain")).first()[0]
    shares = gains.join(md.tree_importance(spark, model), "feature", "right")
    apart = shares.agg(F.max(F.abs(F.coalesce(F.col("gain") / whole, F.lit(0.0)) - F.col("importance")))).first()[0]
    scored = md.score(table, model).join(parts, "loan_seq_num")
    explained = clip(F.lit(tr.tree_baseline(leaves)) + F.col("moved"), 0.0, 1.0)
    return scored.groupBy("split").agg(
        F.count("lgd").alias("n"), (F.max(F.abs(explained - F.col("lgd"))) < 1e-9).alias("adds_up"),
        (F.stddev_pop("moved") > 0).alias("differs")).withColumn("gains_agree", F.lit(apart < 1e-9))


@query("m5_fit_bounded_tail_weighted", facts_sql("within_bounds", "solved"))
def m5(spark, d):
    table = matrix(spark, d)
    model = md.fit_bounded_tail_weighted(train_of(table), K.FEATURES)
    solved = largest_score(train_of(table), model, tail_weight(Y, K.TAIL_ALPHA)) < 1e-6
    return facts(md.score(table, model), solved=F.lit(solved))


@query("m7_predict_with_interval", facts_sql("within_bounds", "ordered", "wide"))
def m7(spark, d):
    table = matrix(spark, d)
    scored = md.predict_with_interval(table, md.fit_members(train_of(table), K.FEATURES))
    ordered = F.bool_and((F.col("lower") >= 0) & (F.col("lower") <= F.col("upper")) & (F.col("upper") <= 1))
    return scored.groupBy("split").agg(
        F.count("lgd").alias("n"), F.bool_and(F.col("lgd").between(0.0, 1.0)).alias("within_bounds"),
        ordered.alias("ordered"), (F.avg(F.col("upper") - F.col("lower")) > 0).alias("wide"))


@query("m8_interval_histogram", sql(
    f"SELECT * FROM ({histogram_sql('SELECT round(upper - lower, 6) AS x FROM intervals', 30)})", "features", extra=INTERVALS))
def m8_histogram(spark, d):
    scored = md.predict_with_interval(features(spark, d), MEMBERS)
    # Rounded, so that both engines put a width on the same side of an edge.
    scored = scored.select(F.round(F.col("upper") - F.col("lower"), 6).alias("upper"), F.lit(0.0).alias("lower"))
    return rounded(ev.interval_histogram(pin(scored)), ["bin_low"])


@query("m13_residual_histogram", sql(
    f"SELECT * FROM ({histogram_sql(f'SELECT round(prediction - {Y}, 6) AS x FROM predicted', 50)})", "cleaned",
    extra=PREDICTED))
def m13_histogram(spark, d):
    scored = predicted(spark, d).select(F.round(F.col("prediction") - F.col(Y), 6).alias("p"), F.lit(0.0).alias("y"))
    return rounded(ev.residual_histogram(pin(scored), "y", "p"), ["bin_low"])
