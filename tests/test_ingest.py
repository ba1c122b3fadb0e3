import pytest
from pyspark.sql import functions as F

from lossgrain import constants as K
from lossgrain.operators import quality as qa
from lossgrain.operators import resolve as rv
from lossgrain.operators import transform as tr
from lossgrain.plans import batch
from lossgrain.sources import prediction_log as pl
from lossgrain.sources import stage as st
from lossgrain.sources import text as tx


def line(columns, **values):
    return "|".join(str(values.get(c, "")) for c in columns)


def orig_line(key, date="201002", **more):
    base = dict(loan_seq_num=key, first_payment_date=date, orig_upb="200000", orig_ltv="80", orig_cltv="80",
                orig_interest_rate="4.5", orig_loan_term="360", property_type="SF", occupancy_status="P",
                channel="R", property_state="CA", credit_score="700", orig_dti="30")
    return line(K.ORIGINATION_COLUMNS, **{**base, **more})


def perf_line(key, period, **more):
    return line(K.PERFORMANCE_COLUMNS, loan_seq_num=key, monthly_reporting_period=period, **more)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    orig, perf = base / "origination", base / "performance"
    orig.mkdir(), perf.mkdir()
    short = "|".join(orig_line("SHORT").split("|")[:22])
    long = orig_line("LONG") + "|extra"
    (orig / "historical_data_2010Q1.txt").write_text("\n".join([
        orig_line("A", orig_upb="100", credit_score="NA", postal_code="01234"), orig_line("B"), short, long,
        orig_line("OLD", date="200912"), orig_line("BAD", date="unknown")]) + "\n")
    (orig / "historical_data_2010Q2.txt").write_text("\n".join([
        orig_line("A", orig_upb="999", date="201005"), orig_line("C", channel="", orig_dti="")]) + "\n")
    default = dict(zero_balance_code="09", zero_balance_removal_upb="100000", net_sale_proceeds="60000",
                   expenses="5000", mi_recoveries="0", current_upb="0", zero_balance_effective_date="201206")
    (perf / "historical_data_time_2010Q1.txt").write_text("\n".join([
        *[perf_line("A", f"20120{i + 1}", current_delinquency_status=s)
          for i, s in enumerate(["0", "1", "2", "3", "4", "XX"])],
        perf_line("A", "201207", **{**default, "expenses": "7000"}),
        perf_line("A", "201208", **{**default, "expenses": "", "mi_recoveries": "1000"}),
        perf_line("B", "201203", zero_balance_code="01"),
        perf_line("C", "201301", **default),
        perf_line("C", "", **{**default, "net_sale_proceeds": "90000"}),
        perf_line("SHORT", "201301", **{**default, "zero_balance_removal_upb": "0"}),
        perf_line("NOWHERE", "201301", **default)]) + "\n")
    return str(base)


def test_reader_keeps_text_and_nulls_tokens(spark, raw):
    rows = tx.read_delimited(spark, f"{raw}/origination", K.ORIGINATION_COLUMNS, tx.ORIGINATION_GLOB)
    a = rows.where("loan_seq_num = 'A' and orig_upb = '100'").first()
    assert a.credit_score is None and a.postal_code == "01234"
    assert set(dict(rows.dtypes).values()) == {"string"}


def test_long_rows_are_rejected_and_short_rows_kept(spark, raw):
    rows = tx.read_lines(spark, f"{raw}/origination", K.ORIGINATION_COLUMNS, tx.ORIGINATION_GLOB)
    good, bad = tx.split_rejects(rows, len(K.ORIGINATION_COLUMNS))
    assert {r.loan_seq_num for r in good.collect()} == {"A", "B", "C", "SHORT", "OLD", "BAD"}
    short = good.where("loan_seq_num = 'SHORT'").first()
    assert short.orig_loan_term == "360" and short.mi_cancellation_indicator is None
    assert [r.line for r in bad.select("line").collect()] == [orig_line("LONG") + "|extra"]


def test_discover_sorts_and_tolerates_absence(spark, raw, tmp_path):
    found = tx.discover(spark, f"{raw}/origination", tx.ORIGINATION_GLOB).collect()
    assert [r.file_name for r in found] == ["historical_data_2010Q1.txt", "historical_data_2010Q2.txt"]
    for path in (str(tmp_path), str(tmp_path / "absent")):
        rows = tx.read_delimited(spark, path, K.ORIGINATION_COLUMNS, tx.ORIGINATION_GLOB)
        assert rows.columns == K.ORIGINATION_COLUMNS and rows.count() == 0


def test_first_file_wins_with_any_partitioning(spark, raw):
    rows = tx.read_delimited(spark, f"{raw}/origination", K.ORIGINATION_COLUMNS, tx.ORIGINATION_GLOB, True)
    for df in (rows.coalesce(1), rows.repartition(7)):
        first = rv.dedupe_first(df, "loan_seq_num", tx.POSITION)
        assert first.where("loan_seq_num = 'A'").first().orig_upb == "100"
        assert first.count() == 6


def test_last_value_per_column(spark, raw):
    rows = tx.read_delimited(spark, f"{raw}/performance", K.PERFORMANCE_COLUMNS, tx.PERFORMANCE_GLOB, True)
    order = rv.period_order("monthly_reporting_period", *tx.POSITION)
    for df in (rows.coalesce(1), rows.repartition(5)):
        last = rv.last_per_loan(rv.filter_defaults(df), order=order, columns=K.PERFORMANCE_COLUMNS)
        got = {r.loan_seq_num: r for r in last.collect()}
        assert set(got) == {"A", "C", "SHORT", "NOWHERE"}
        # The later record has no expenses, so the earlier value stays.
        assert (got["A"].monthly_reporting_period, got["A"].expenses, got["A"].mi_recoveries) == (
            "201208", "7000", "1000")
        # A record without a period counts as the latest one.
        assert got["C"].net_sale_proceeds == "90000" and got["C"].monthly_reporting_period == "201301"


def test_months_delinquent(spark, raw):
    rows = tx.read_delimited(spark, f"{raw}/performance", K.PERFORMANCE_COLUMNS, tx.PERFORMANCE_GLOB)
    months = lambda **k: {r[0]: r[1] for r in rv.months_delinquent(rows, **k).collect()}
    assert months() == {"A": 3, "C": 3, "SHORT": 3, "NOWHERE": 3}
    assert months(minimum=0)["A"] == 2
    assert months(minimum=0, non_numeric=["XX"])["A"] == 3


def test_batch_run_end_to_end(spark, raw, tmp_path, caplog):
    out = str(tmp_path)
    features = batch.run(spark, raw, out, 2010, 2015)
    assert "1 rows with too many fields skipped" in caplog.text
    rows = {r.loan_seq_num: r for r in features.collect()}
    assert set(rows) == {"A", "C"}
    assert features.columns == ["loan_seq_num", *K.FEATURES, K.TARGET, "vintage_year"]
    assert rows["A"][K.TARGET] == pytest.approx((100000 - 60000 + 7000 - 1000) / 100000)
    assert rows["C"][K.TARGET] == pytest.approx(0.15)
    assert rows["A"].channel == 0 and rows["C"].channel == 1  # R, Unknown
    assert rows["C"].unemployment_rate_at_default == 7.5
    assert rows["A"].ltv_at_default == 300.0  # 100000 over 125
    dictionary = st.load_stage(spark, f"{out}/categories")
    assert {(r.column, r.value) for r in dictionary.collect()} >= {("channel", "R"), ("channel", "Unknown")}


def test_nothing_to_ingest_gives_empty_stages(spark, tmp_path):
    orig = batch.ingest_origination(spark, str(tmp_path / "no"), str(tmp_path / "o"))
    perf = batch.ingest_performance(spark, str(tmp_path / "no"), str(tmp_path / "p"))
    assert orig.count() == perf.count() == 0
    assert {*K.ORIGINATION_COLUMNS, "vintage_year"} == set(orig.columns)


def test_stage_replaces_and_missing_names_path(spark, tmp_path):
    path = str(tmp_path / "t")
    st.stage(spark.range(5), path)
    st.stage(spark.range(3), path)
    assert st.load_stage(spark, path).count() == 3
    with pytest.raises(FileNotFoundError, match="nothing-here"):
        st.load_stage(spark, str(tmp_path / "nothing-here"))


def test_a_failed_stage_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert st.stage(spark.range(5), path) == 1
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half-way"):
        st.stage(broken.repartition(4), path)
    assert st.load_stage(spark, path).count() == 5


def test_stage_snapshots(spark, tmp_path):
    """A table may be made from itself; readers keep their snapshot; old ones go; plain folders are read as they are."""
    path = str(tmp_path / "t")
    st.stage(spark.range(4).withColumn("part", F.col("id") % 2), path, "part")
    reader = st.load_stage(spark, path)
    st.stage(reader.where("id > 0"), path, "part")
    assert reader.count() == 4 and st.load_stage(spark, path).count() == 3
    assert "PartitionFilters: [isnotnull(part" in st.load_stage(
        spark, path).where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert st.load_stage(spark, path, version=1).count() == 4
    for n in (7, 8):
        st.stage(spark.range(n), path)
    assert st.load_stage(spark, path).count() == 8 and st.load_stage(spark, path, version=2).count() == 3
    with pytest.raises(FileNotFoundError, match="snapshot 9"):
        st.load_stage(spark, path, version=9)
    spark.range(6).write.parquet(str(tmp_path / "plain"))
    assert st.load_stage(spark, str(tmp_path / "plain")).count() == 6


def test_key_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert qa.count_duplicate_keys(df, "k").first()[0] == 1
    assert tuple(qa.key_profile(df, "k").first()) == (4, 2)
    with pytest.raises(ValueError, match="1 rows"):
        qa.check_null_keys(df, "k")
    with pytest.raises(ValueError, match="x, y"):
        qa.require_columns(df, ["k", "y", "x"])


def test_numbers_from_text(spark):
    texts = ["12", " 12.5 ", "1e3", ".5", "5.", "-3", "12d", "abc", "", " ", "nan", "0x10", "1,000", None]
    df = spark.createDataFrame([(t,) for t in texts], "orig_upb string")
    got = [r[0] for r in tr.cast_numeric(df, K.ORIGINATION_NUMERIC).collect()]
    assert got == [12.0, 12.5, 1000.0, 0.5, 5.0, -3.0] + [None] * 8


def test_vintage_and_sentinels(spark):
    df = spark.createDataFrame([("201001", 9999.0), ("201103", 700.0), ("x", None), (None, 650.0)],
                               "first_payment_date string, credit_score double")
    assert [r.vintage_year for r in tr.with_vintage_year(df).collect()] == [2010, 2011, None, None]
    kept = tr.with_vintage_year(df.withColumn("vintage_year", F.lit(1)))
    assert {r.vintage_year for r in kept.collect()} == {1}
    assert [r.credit_score for r in tr.null_sentinels(df).collect()] == [None, 700.0, None, 650.0]


def test_imputation(spark):
    df = spark.createDataFrame(
        [(None, 1.0, None), (5.0, 2.0, "Y"), (7.0, None, "N"), (None, 10.0, None)],
        "mip double, orig_dti double, modification_flag string")
    rows = tr.fill_const(tr.fill_median(tr.fill_zero(df))).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.0, "N"), (5.0, 2.0, "Y"), (7.0, 2.0, "N"), (0.0, 10.0, "N")]
    audit = {r.column: (r.n_filled, r.fill_value) for r in tr.imputation_audit(df).collect()}
    assert audit == {"mip": (2, "0.0"), "orig_dti": (1, "2.0"), "modification_flag": (2, "N")}


def test_sample_keeps_histories_together(spark):
    df = spark.range(2000).select((F.col("id") % 400).cast("string").alias("k"))
    kept = rv.sample_fraction(df, "k", 0.25).groupBy("k").count().collect()
    assert {r["count"] for r in kept} == {5} and 60 < len(kept) < 140
    assert rv.sample_fraction(df, "k", 1.0).count() == 2000
    assert rv.sample_fraction(df, "k", 0.0).count() == 0


GOOD = dict(orig_ltv=85.0, orig_upb=250000.0, orig_interest_rate=4.5, orig_term=360, ltv_at_default=105.0,
            months_delinquent_at_default=6, hpi_change=-0.15, unemployment_rate_at_default=8.5,
            property_type="SF", occupancy_status="P", channel="R", state="CA")
REQUEST = ("batch string, orig_ltv double, orig_upb double, orig_interest_rate double, orig_term int, "
           "ltv_at_default double, months_delinquent_at_default int, hpi_change double, "
           "unemployment_rate_at_default double, property_type string, occupancy_status string, "
           "channel string, state string")


def requests(spark, *changes):
    return spark.createDataFrame([tuple({"batch": "b", **GOOD, **c}.values()) for c in changes], REQUEST)


def test_request_rules(spark):
    bad = [dict(orig_ltv=None), dict(property_type="XX"), dict(occupancy_status="Z"), dict(orig_ltv=250.0),
           dict(orig_upb=-100.0), dict(orig_upb=0.0), dict(channel="Z"), dict(state="CAL"),
           dict(months_delinquent_at_default=0)]
    _, rejected = qa.validate_rows(requests(spark, {}, *bad))
    assert sorted(r.violations[0] for r in rejected.collect()) == sorted(next(iter(b)) for b in bad)
    edge = [dict(orig_ltv=0.0), dict(orig_ltv=200.0), dict(orig_term=60), dict(orig_term=480),
            dict(hpi_change=-1.0), dict(months_delinquent_at_default=120)]
    valid, _ = qa.validate_rows(requests(spark, *edge))
    assert valid.count() == len(edge)


def test_batches_are_accepted_whole(spark):
    rows = requests(spark, dict(batch="two"), dict(batch="two"), dict(batch="one"),
                    dict(batch="mixed"), dict(batch="mixed", state="CAL"))
    huge = requests(spark, {}).crossJoin(spark.range(1001)).drop("id").withColumn("batch", F.lit("huge"))
    kept = qa.validate_batches(rows.unionByName(huge), "batch").groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in kept} == {"two": 2, "one": 1}


def test_fixed_orders_give_the_rows_of_struct_orders(spark):
    from lossgrain.operators import resolve as rv

    r = __import__("random").Random(4)
    rows = [(str(r.randrange(30)), r.choice([None, "200001", "199912", "201511"]), i, r.choice([None, 1.5, 2.5, 3.0]),
             r.choice([None, "a", "bb"])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, p string, at bigint, x double, y string")
    wanted = None
    for parts in (1, 7):
        some = df.repartition(parts)
        for order in ([rv.fixed_order("p", F.col("at"))], rv.period_order("p", "at")):
            got = sorted(map(str, rv.last_per_loan(some, "k", order, ["x", "y"]).collect()))
            first = sorted(map(str, rv.dedupe_first(some.select("k", "x", "at"), "k", ["at"]).collect()))
            wide = sorted(map(str, rv.dedupe_first(some.select("k", "x", "at", "y"), "k", ["at"]).drop("y").collect()))
            assert first == wide and (wanted is None or (got, first) == wanted)
            wanted = got, first
    for period, at in (("20001", 1), ("200001x", 1), ("200001", 1 << 43), ("200001", -1)):
        with pytest.raises(Exception, match="order does not fit"):
            spark.createDataFrame([(period, at)], "p string, at bigint").select(rv.fixed_order("p", F.col("at"))).collect()


def test_log_first_write_wins(spark, tmp_path):
    path = str(tmp_path / "log")
    make = lambda rows: spark.createDataFrame(rows, "prediction_id string, second int, predicted_lgd double").select(  # noqa: E731,E501
        "prediction_id", F.timestamp_seconds("second").alias("ts"), F.lit("{}").alias("features_json"),
        "predicted_lgd", F.lit("v").alias("model_version"))
    assert pl.read_predictions(spark, path).count() == 0
    pl.append_predictions(spark, path, make([("a", 1, 0.1), ("b", 1, 0.2)]))
    pl.append_predictions(spark, path, make([("a", 0, 0.9), ("c", 5, 0.5), ("c", 3, 0.3)]))
    pl.append_predictions(spark, path, make([("c", 3, 0.3)]))
    got = {r.prediction_id: r.predicted_lgd for r in pl.read_predictions(spark, path).collect()}
    assert got == {"a": 0.1, "b": 0.2, "c": 0.3} and pl.read_predictions(spark, path).count() == 3
    assert pl.append_predictions(spark, path, make([("c", 3, 0.3)])) is None


def test_model_run_from_feature_table_to_verdict(spark, tmp_path):
    import random

    from lossgrain import constants as K
    from lossgrain.operators import model as md
    from lossgrain.plans import modelling

    r = random.Random(3)
    rows = []
    for i in range(900):
        x = {c: float(r.randint(0, 4)) for c in K.FEATURES}
        x.update(hpi_change=r.uniform(-0.3, 0.2), ltv_at_default=r.uniform(40, 160), unemployment_rate_at_default=r.uniform(3, 11))
        loss = 0.2 + 0.004 * (x["ltv_at_default"] - 80) - 0.4 * x["hpi_change"] + r.gauss(0, 0.03)
        rows.append((f"k{i}", 2010 + i % 4, min(max(loss, 0.0), 1.0), *x.values()))
    schema = f"loan_seq_num string, vintage_year int, {K.TARGET} double, " + ", ".join(f"`{c}` double" for c in K.FEATURES)
    out = f"{tmp_path}/scorer"
    run = modelling.run(spark.createDataFrame(rows, schema), out=out)
    assert {(x.model, x.split) for x in run.metrics.collect()} == {
        (m, s) for m in ("segment_average", *modelling.MODELS) for s in ("train", "validation", "test")}
    gains = {x.model: x.mae_improvement for x in run.comparison.collect()}
    assert gains["segment_average"] is None and gains["bounded_tail_weighted"] > 30
    assert run.calibration.count() == 10 and run.scenarios.count() == len(K.SCENARIOS)
    assert {x.criterion: x.passed for x in run.criteria.collect()}["mae_improvement"]
    again = md.scorer_from(spark.read.parquet(out))
    assert again.coefficients == run.scorer.coefficients and again.scaler == run.scorer.scaler


def test_failed_check_leaves_the_published_table(spark, tmp_path):
    from pyspark.errors import PySparkException

    from lossgrain import constants as K
    from lossgrain.plans import batch

    def deliver(name, key):
        fields = dict.fromkeys(K.ORIGINATION_COLUMNS, "")
        fields.update(loan_seq_num=key, first_payment_date="201001", orig_upb="1000", credit_score="700")
        (tmp_path / "raw" / f"historical_data_{name}.txt").write_text("|".join(fields.values()) + "\n")

    (tmp_path / "raw").mkdir()
    deliver("2010Q1", "A1")
    out = f"{tmp_path}/orig"
    assert batch.ingest_origination(spark, f"{tmp_path}/raw", out, 2009, 2011).count() == 1
    deliver("2010Q2", "")
    with pytest.raises((ValueError, PySparkException)):
        batch.ingest_origination(spark, f"{tmp_path}/raw", out, 2009, 2011)
    assert [r.loan_seq_num for r in spark.read.parquet(out).collect()] == ["A1"]


def test_quoted_separators_are_no_fields(spark, tmp_path):
    from lossgrain.sources import text as tx

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text('a|"x|y|z"\na|b|c|d\n"p|q"|r|"s""|t"\n1|2|3\n')
    kept, rejects = tx.split_rejects(tx.read_lines(spark, f"{tmp_path}/t", ["f", "g", "h"], "*.txt"), 3)
    assert [r.line for r in rejects.collect()] == ["a|b|c|d"]
    assert sorted((r.f, r.g) for r in kept.collect()) == [("1", "2"), ("a", "x|y|z"), ("p|q", "r")]


def test_odd_requests_and_batches_are_rejected_not_lost(spark):
    from lossgrain.operators import quality as qa
    from lossgrain.operators import split as sp

    rows = spark.createDataFrame([("1", "abc", "b"), ("2", "85", None)], "loan_seq_num string, orig_ltv string, batch string")
    valid, rejected = qa.validate_rows(rows)
    broken = {r.loan_seq_num: "orig_ltv" in r.violations for r in rejected.collect()}
    assert valid.count() == 0 and broken == {"1": True, "2": False}
    rules = {"low": F.col("orig_ltv") == "abc"}
    accepted, others = qa.split_batches(rows, "batch", rules)
    assert [r.loan_seq_num for r in accepted.collect()] == ["2"] and [r.loan_seq_num for r in others.collect()] == ["1"]
    loans = spark.createDataFrame([(str(i), 2010 + i % 3 if i % 5 else None) for i in range(60)], "loan_seq_num string, vintage_year int")
    split = sp.split_by_vintage(loans, 2011)
    assert split.count() == 60 and split.where("vintage_year is null and split = 'test'").count() == 0
