import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lossgrain import constants as K
from lossgrain.functions.columns import tail_weight
from lossgrain.operators import features as ft
from lossgrain.operators import macro
from lossgrain.operators import resolve as rv
from lossgrain.operators import transform as tr

ORIG = [("K-1", 72.0, 131000.0, 3.9, 360, "OR", "MH", "P", "T", "200907"),
        ("K-2", 101.0, 77500.0, 6.3, 240, "OH", "PU", "S", "C", "201002"),
        ("K-3", 88.0, 410000.0, 5.2, 300, "GA", "SF", "I", "R", "201410"),
        ("K-4", 64.0, 96000.0, 4.1, 180, "MA", "CO", "P", "B", "201511")]
ORIG_SCHEMA = ("loan_seq_num string, orig_ltv double, orig_upb double, orig_interest_rate double, "
               "orig_loan_term int, property_state string, property_type string, occupancy_status string, "
               "channel string, first_payment_date string")
# (key, balance, proceeds, expenses, insurance, expected loss)
PERF = [("part", 64000.0, 40000.0, 4000.0, 12000.0, 16 / 64), ("quarter", 120000.0, 100000.0, 15000.0, 5000.0, 30 / 120),
        ("gain", 90000.0, 99000.0, 1000.0, 0.0, 0.0), ("even", 50000.0, 50000.0, 0.0, 0.0, 0.0),
        ("capped", 70000.0, 10000.0, 30000.0, 0.0, 1.0), ("nothing known", 30000.0, None, None, None, 1.0),
        ("no balance", 0.0, 1000.0, 0.0, 0.0, None), ("negative", -1.0, 0.0, 0.0, 0.0, None),
        ("null balance", None, 0.0, 0.0, 0.0, None), ("NaN loss", 1000.0, float("nan"), 0.0, 0.0, None),
        ("no end", float("inf"), 0.0, 0.0, 0.0, None)]


@pytest.fixture(scope="module")
def orig(spark):
    return spark.createDataFrame(ORIG, ORIG_SCHEMA)


def test_target(spark):
    perf = spark.createDataFrame([p[:5] for p in PERF], "loan_seq_num string, zero_balance_removal_upb double, "
                                 "net_sale_proceeds double, expenses double, mi_recoveries double")
    got = {r.loan_seq_num: r[K.TARGET] for r in rv.drop_null_target(rv.with_lgd(perf)).collect()}
    assert got == pytest.approx({p[0]: p[5] for p in PERF if p[5] is not None})
    fallback = rv.with_lgd(perf.drop("expenses").withColumn("actual_loss", F.col("net_sale_proceeds") / 2))
    assert {r.loan_seq_num: r[K.TARGET] for r in fallback.collect()}["nothing known"] == 0.0


def ltv(spark, orig_ltv, upb, balance, hpi):
    df = spark.createDataFrame([(orig_ltv, upb, balance, hpi)],
                               "orig_ltv double, orig_upb double, current_upb double, hpi_change double")
    return ft.with_ltv_at_default(df, "current_upb").first().ltv_at_default


def test_ltv_at_default(spark, orig):
    df = orig.withColumns({"current_upb": F.col("orig_upb") * 0.95, "hpi_change": F.lit(-0.10)})
    got = [r.ltv_at_default for r in ft.with_ltv_at_default(df, "current_upb").orderBy("loan_seq_num").collect()]
    assert got == pytest.approx([0.95 * r[1] / 0.9 for r in ORIG])
    assert ltv(spark, 80.0, 200000.0, 200000.0, -0.99) == 300.0
    assert ltv(spark, 80.0, 200000.0, 195000.0, 0.0) == pytest.approx(78.0)
    assert ltv(spark, 80.0, 200000.0, 195000.0, -0.2) == pytest.approx(97.5)
    assert ltv(spark, 80.0, 200000.0, 195000.0, None) == pytest.approx(78.0)
    assert ltv(spark, 80.0, 200000.0, 195000.0, float("nan")) == pytest.approx(78.0)
    for unknown in ((float("nan"), 1.0, 1.0, 0.0), (80.0, 1.0, float("nan"), 0.0), (0.0, 1.0, 1.0, 0.0), (80.0, 0.0, 1.0, 0.0), (80.0, 1.0, 1.0, -1.0), (80.0, 1.0, None, 0.0)):
        assert ltv(spark, *unknown) is None
    assert ft.with_ltv_at_default(orig.drop("orig_ltv")).first().ltv_at_default == 80.0
    assert ft.with_ltv_at_default(orig.drop("orig_upb")).first().ltv_at_default == ORIG[0][1]


def test_placeholders_do_not_overwrite(spark, orig):
    row = tr.with_placeholders(orig).first()
    assert (row.hpi_change, row.unemployment_rate_at_default, row.months_delinquent_at_default) == (0.0, 7.5, 3)
    assert tr.with_placeholders(orig.withColumn("hpi_change", F.lit(-0.15))).first().hpi_change == -0.15


def test_region_and_flag(spark):
    assert sum(map(len, K.REGION_STATES.values())) == 51
    df = spark.createDataFrame([("CA", "Y"), ("XX", "N"), (None, None), ("DC", "y")], "state string, modification_flag string")
    rows = ft.with_modification_numeric(ft.with_region(df)).collect()
    assert [r.region for r in rows] == ["West", "Other", "Other", "West"]
    assert [r.modification_flag_numeric for r in rows] == [1, 0, 0, 0]
    assert {r[-1] for r in ft.with_modification_numeric(df.drop("modification_flag")).collect()} == {0}


def test_encoder(spark, orig):
    dictionary = ft.fit_encoder(orig, ["property_type", "channel", "absent"])
    codes = {(r.column, r.value): r.code for r in dictionary.collect()}
    assert codes == {("property_type", "CO"): 0, ("property_type", "MH"): 1, ("property_type", "PU"): 2,
                     ("property_type", "SF"): 3, ("channel", "B"): 0, ("channel", "C"): 1, ("channel", "R"): 2,
                     ("channel", "T"): 3}
    new = spark.createDataFrame([("SF", "R"), ("ZZ", None)], "property_type string, channel string")
    cols = ["property_type", "channel"]
    for bound in (1 << 20, 0):  # broadcast and shuffled lookup
        got = ft.apply_encoder(new, dictionary, cols, "next", bound).collect()
        assert sorted(tuple(r) for r in got) == [(3, 2), (4, 4)]
    with pytest.raises(PySparkException, match="not fitted"):
        ft.apply_encoder(new, dictionary, cols).collect()


def test_serving_codes(spark):
    df = spark.createDataFrame([("SF", "P", "R", "CA"), ("??", None, "Z", None)],
                               "property_type string, occupancy_status string, channel string, state string")
    assert [tuple(r) for r in ft.encode_serving(df).collect()] == [(4, 1, 2, 5), (5, 3, 4, 2)]


def test_matrix_sanitize_scale(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (3.0, float("inf")), (None, float("-inf"))], "a double, b double")
    clean = ft.sanitize(df, ["a", "b", "c"]).collect()
    largest = 1.7976931348623157e308
    assert [tuple(r) for r in clean] == [(1.0, 0.0, 0.0), (3.0, largest, 0.0), (0.0, -largest, 0.0)]
    assert ft.feature_matrix(df, ["b", "z", "a"]).columns == ["b", "z", "a"]
    train = spark.createDataFrame([(1.0, 7.5), (3.0, 7.5)], "a double, b double")
    stats = ft.scaler_stats(train, ["a", "b"])
    assert {r.feature: (r.mean, r.scale) for r in stats.collect()} == {"a": (2.0, 1.0), "b": (7.5, 1.0)}
    assert [tuple(r) for r in ft.scale(train, stats, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_tail_weight(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (0.75,)], "y double")
    assert [r[0] for r in df.select(tail_weight("y")).collect()] == [3.0, 1.0, 3.0, 1.5]


def test_prediction_id_is_repeatable(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    one = {r.k: r.prediction_id for r in ft.with_prediction_id(df, ["k"], "r1").collect()}
    two = {r.k: r.prediction_id for r in ft.with_prediction_id(df.repartition(7), ["k"], "r1").collect()}
    assert one == two and len(set(one.values())) == 50
    assert one != {r.k: r.prediction_id for r in ft.with_prediction_id(df, ["k"], "r2").collect()}


LOANS = [("1", "CA", "201001", "201206"), ("2", "CA", "201001", "201301"), ("3", "ZZ", "201001", "201206"),
         ("4", "TX", "201001", "201206"), ("5", "CA", None, "201206"), ("6", "CA", "201001", "200901")]


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_macro_joins(spark, bound):
    loans = spark.createDataFrame(LOANS, "loan_seq_num string, state string, first_payment_date string, "
                                  "zero_balance_effective_date string").withColumn("monthly_reporting_period", F.lit(None).cast("string"))
    hpi = spark.createDataFrame([("CA", 2010, 1, 100.0), ("CA", 2012, 2, 80.0), ("TX", 2010, 1, 0.0), ("TX", 2012, 2, 90.0)],
                                "state string, year int, quarter int, hpi double")
    got = {r.loan_seq_num: r.hpi_change for r in macro.join_hpi(loans, hpi, bound=bound).collect()}
    assert got == pytest.approx({"1": -0.2, "2": 0.0, "3": 0.0, "4": 0.0, "5": 0.0, "6": 0.0})
    rates = spark.createDataFrame([("CA", "2012-06-01", 9.5), ("CA", "2012-09-01", 8.5)], "state string, m string, rate double"
                                  ).select("state", F.to_date("m").alias("month"), "rate")
    got = {r.loan_seq_num: r.unemployment_rate_at_default for r in macro.join_unemployment(loans, rates, bound=bound).collect()}
    assert got == {"1": 9.5, "2": 7.5, "3": 7.5, "4": 7.5, "5": 9.5, "6": 7.5}
    asof = macro.asof_macro(loans, rates, ["state"], macro.default_month(), bound=bound)
    got = {r.loan_seq_num: r.rate_asof for r in asof.collect()}
    assert got == {"1": 9.5, "2": 8.5, "3": None, "4": None, "5": 9.5, "6": None}
    assert asof.count() == len(LOANS)


def test_asof_holds_between_observations(spark):
    series = spark.createDataFrame([("s", "2010-01-01", 1.0), ("s", "2010-05-01", 2.0)], "state string, m string, rate double"
                                   ).select("state", F.to_date("m").alias("month"), "rate")
    loans = spark.createDataFrame([(str(y * 100 + m),) for y in (2009, 2010) for m in range(1, 13)], "p string").withColumn("state", F.lit("s"))
    from lossgrain.functions.columns import month_of_period
    got = {r.p: r.rate_asof for r in macro.asof_macro(loans, series, ["state"], month_of_period("p")).collect()}
    for p, rate in got.items():
        assert rate == (None if p < "201001" else 1.0 if p < "201005" else 2.0)


def test_scenarios_repeat_each_loan(spark):
    loans = spark.createDataFrame([("a", 5.0, 0.1)], "k string, unemployment_rate_at_default double, hpi_change double")
    rows = macro.cross_scenarios(loans).orderBy("severity").collect()
    assert [r.unemployment_rate_at_default for r in rows] == [5.0, 7.0, 9.0, 11.0]
    assert [r.hpi_change for r in rows] == pytest.approx([0.1, 0.0, -0.1, -0.2])


def test_asof_looks_at_days_and_never_ahead(spark):
    from pyspark.sql.functions import to_date
    series = spark.createDataFrame(
        [("s", "2012-02-10", 1.0), ("s", "2012-03-04", 2.0), ("s", "2012-03-20", 3.0), ("s", "2012-03-20", 2.5),
         ("s", "2012-07-01", 4.0), ("s", None, 9.0), ("s", "2012-04-01", None), ("t", "2012-03-31", 7.0)],
        "state string, d string, rate double").select("state", to_date("d").alias("d"), "rate")
    days = {"2012-02-09": None, "2012-02-10": 1.0, "2012-03-03": 1.0, "2012-03-05": 2.0, "2012-03-19": 2.0,
            "2012-03-20": 3.0, "2012-06-30": 3.0, "2012-07-01": 4.0, "2030-01-01": 4.0, None: None}
    loans = spark.createDataFrame([("s", d) for d in days] + [("t", "2012-03-30"), ("u", "2012-03-30")], "state string, e string")
    for bound in (1 << 20, 0):
        got = {(r.state, r.e): r.rate_asof for r in macro.asof_macro(loans, series, ["state"], to_date("e"), "d", bound=bound).collect()}
        assert got == {**{("s", d): v for d, v in days.items()}, ("t", "2012-03-30"): None, ("u", "2012-03-30"): None}
