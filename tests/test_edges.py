"""Edge values: missing, NaN, infinite, band edges, ties and empty inputs."""

import math

import pytest
from pyspark.sql import functions as F
from riskloom import constants as K
from riskloom.functions import bands as B
from riskloom.functions import masking as M
from riskloom.functions import numeric as N
from riskloom.operators import evaluation as E
from riskloom.operators import explain as X
from riskloom.operators import features as feat
from riskloom.operators import load as L
from riskloom.operators import portfolio as A
from riskloom.operators import privacy as V
from riskloom.operators import rules, scoring
from riskloom.operators.joins import with_active_model

INF, NAN = float("inf"), float("nan")


def column(spark, values, expr, dtype="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clip(spark):
    got = column(spark, [None, NAN, INF, -INF, -1.0, 0.0, 100.0, 101.0], lambda c: N.clip(c, 0, 100))
    assert got == [None, None, 100.0, 0.0, 0.0, 0.0, 100.0, 100.0]


def test_rounding(spark):
    assert column(spark, [0.5, 1.5, 2.5, None], lambda c: N.round_even(c)) == [0.0, 2.0, 2.0, None]
    assert column(spark, [5.0, 15.0], lambda c: N.round_even(c, -1)) == [0.0, 20.0]
    assert column(spark, [0.125, -0.125, 2.5], lambda c: N.round_up(c, 2)) == [0.13, -0.12, 2.5]


def test_inf_and_safe_float(spark):
    assert column(spark, [INF, -INF, NAN, None, 1.0], N.inf_to_null) == [None, None, None, None, 1.0]
    texts = ["5", " 2.5 ", "", None, "5 → Çok iyi", "NaN", "Infinity"]
    assert column(spark, texts, N.safe_float, "string") == [5.0, 2.5, 0.0, 0.0, 0.0, 0.0, 0.0]
    assert column(spark, ["Infinity"], lambda c: N.safe_float(c, allow_inf=True), "string") == [INF]


def test_scales(spark):
    assert column(spark, [None, 50.0, 100.0, 250.0, -3.0], N.percent_to_unit) == [0.0, 0.5, 1.0, 0.025, 0.0]
    assert column(spark, [None, 0.5, 1.0, 50.0, INF], N.unit_if_above_one) == [None, 0.5, 1.0, 0.5, None]


def test_value_status(spark):
    got = column(spark, [None, "", "x", "0", "Infinity"], N.value_and_status, "string")
    assert [r.status for r in got] == ["missing", "missing", "invalid", "valid", "invalid"]
    assert got[3].value == 0.0


def test_bands_differ_at_edges(spark):
    scores = [0.0, 0.33, 0.3300001, 0.66, 1.0, None, 1.2]
    assert [r.band for r in column(spark, scores, B.band_api)] == ["Low", "Medium", "Medium", "High", "High", "High", "High"]
    assert column(spark, scores, B.band_cut) == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "nan", "nan"]
    assert column(spark, [39.99, 40.0, 70.0, 70.01, None], B.risk_category) == [
        "Low Risk", "Medium Risk", "Medium Risk", "High Risk", "High Risk",
    ]
    assert column(spark, [0.5, 0.8, 0.80001, None], B.spending_segment) == [
        "Moderate Spender", "Moderate Spender", "High Spender", "Low Spender",
    ]
    assert column(spark, [33.0, 33.1, 66.0, 100.0, 101.0], B.band_cut_synth) == ["Low", "Medium", "Medium", "High", None]
    assert column(spark, [" low ", "x", None], B.band_normalise, "string") == ["LOW", "MEDIUM", "MEDIUM"]


def test_masks(spark):
    assert column(spark, ["a@b.c", "plain", None], M.mask_email, "string") == ["a***@b.c", "plain", None]
    assert column(spark, ["1234", "12345", None], M.mask_phone, "string") == ["****", "12****345", None]
    assert column(spark, [17, 20, None], M.generalise_age, "int") == ["15-20", "20-25", None]
    assert column(spark, ["40000-50000", None], M.coarser_income, "string") == ["40000", None]


def test_rebuild_normalise(spark):
    assert column(spark, [NAN, None, -0.2, 1.7, 0.4], L.rebuild_normalise) == [1.0, 0.0, 0.0, 1.0, 0.4]


def attributes(spark, **values):
    row = {"customer_id": 1, **{c: None for c in K.RAW_ATTRIBUTES}, **values}
    types = ", ".join(f"{c} {'bigint' if c == 'customer_id' else 'double'}" for c in row)
    return spark.createDataFrame([tuple(row.values())], types)


@pytest.mark.parametrize(
    "values, names, score",
    [
        ({}, ["Low savings behavior"], 0.1),
        ({"savings_rate": 0.1}, [K.RULE_FALLBACK[0]], 0.0),
        ({"savings_rate": 0.2, "bill_payment_delay_avg": 3.0, "missed_payments_6m": 2.0, "employment_duration_months": 60.0}, [K.RULE_FALLBACK[0]], 0.0),
        ({"savings_rate": 0.3, "employment_duration_months": 61.0}, ["Strong savings behavior", "Stable employment"], -0.25),
        ({"savings_rate": 0.15, "spending_ratio": 0.9, "missed_payments_6m": 3.0}, ["High spending ratio", "Multiple missed payments"], 0.4),
    ],
)
def test_rules(spark, values, names, score):
    row = attributes(spark, **values).select(
        rules.rule_names(rules.rule_hits()).alias("n"), rules.rule_score().alias("a"), rules.scorecard(rules.rule_hits()).alias("b")
    ).first()
    assert row.n == names and row.a == score and row.b == score


def response(spark, rules_on="raw", **values):
    base = attributes(spark, **{c: v for c, v in values.items() if c in K.RAW_ATTRIBUTES})
    features = {c: F.lit(values.get(c)).cast("double") for c in [*K.FEATURES, "original_score"]}
    return scoring.risk_response(base.withColumns(features), rules_on).first()


def test_response_without_resilience(spark):
    r = response(spark, payment_discipline_score=90.0, income_stability_index=80.0, spending_ratio=0.9)
    assert (r.risk_band, r.risk_label, r.predicted_risk_score, r.model_confidence) == ("UNKNOWN", "Veri Yok", None, 0.0)
    assert r.rule_explanations == [] and r.warnings == [K.WARN_MISSING, K.WARN_RESILIENCE_NULL]
    assert r.risk_color == K.BAND_LOW[1] and r.financial_resilience_score == 0.0


def test_response_blends_and_falls_back(spark):
    r = response(
        spark, payment_discipline_score=100.0, income_stability_index=100.0, financial_resilience_score=0.0, savings_rate=0.15
    )
    assert r.ml_score == pytest.approx(0.3) and r.rule_score == 0.0 and r.final_score == pytest.approx(0.21)
    assert r.original_risk_score == 0.0 and r.label_comparison.agreement
    assert r.warnings == [K.WARN_RESILIENCE_ZERO]
    only_features = response(spark, "engineered", financial_resilience_score=50.0)
    assert only_features.rule_score == pytest.approx(0.1)


def test_summary_texts(spark):
    df = spark.createDataFrame([(50.0, 50.0, 50.0), (10.0, 90.0, 90.0)], ", ".join(f"{c} double" for c in K.FEATURES))
    rows = df.withColumn("e", X.feature_explanations()).select(X.explanation_summary(F.col("e")).alias("s")).collect()
    assert {r.s for r in rows} == {
        K.SUMMARY_BALANCED,
        "Payment discipline score riski artırmaktadır ve income stability index, financial resilience score riski azaltmaktadır.",
    }


def test_upsert(spark):
    target = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b")], "k int, v double, keep string")
    source = spark.createDataFrame([(2, None), (3, 3.0)], "k int, v double")
    got = {r.k: (r.v, r.keep) for r in L.upsert_do_update(target, source, "k").collect()}
    assert got == {1: (1.0, "a"), 2: (None, "b"), 3: (3.0, None)}
    empty = target.limit(0)
    assert L.upsert_do_update(empty, source, "k").count() == 2
    assert L.upsert_do_update(target, source.limit(0), "k").count() == 2
    twice = source.unionByName(source)
    with pytest.raises(Exception, match="occurs twice"):
        L.upsert_do_update(target, twice, "k").collect()


def test_staging_gate(spark):
    schema = "customer_id int, " + ", ".join(f"{c} double" for c in K.FEATURES) + ", risk_score double, risk_band string"
    bad = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 0.1, "Low")], schema)
    with pytest.raises(ValueError, match="1 rows"):
        L.validate_staging(bad)
    with pytest.raises(ValueError, match="empty"):
        L.validate_staging(bad.limit(0))


def test_feature_store_without_backup(spark):
    empty = L.rebuild_features(spark, "/tmp/riskloom-no-such-backup")
    assert empty.count() == 0 and empty.schema["risk_score"].dataType.simpleString() == "double"


def test_no_active_model(spark):
    rows = spark.createDataFrame([(1,)], "customer_id int")
    registry = spark.createDataFrame([("v1.0", False)], "model_version string, is_active boolean")
    assert with_active_model(rows, registry).first().model_version == K.UNKNOWN_MODEL
    with pytest.raises(Exception, match="no active model"):
        with_active_model(rows, registry, fallback=None).collect()


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.2, 0.3), (0, 0, 0.2, 0.1)], "true_label int, pred_label int, truth double, predicted double")
    m = E.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1.0, 0.0, 0.0, 0.0)
    assert E.regression_metrics(df, "truth", "predicted").first().r2 is None
    assert {r.n for r in E.confusion_matrix(df).collect()} == {0, 2}
    best = E.best_threshold(E.threshold_sweep(df, "true_label", "predicted")).first()
    assert (best.threshold, best.f1) == (E.DEFAULT_THRESHOLD, 0.0)


def test_calibration_bins_collapse(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(10)] + [(10, None)], "customer_id int, x double")
    got = {r.b for r in scoring.calibration_bin(df, "x", 5, "b").collect()}
    assert got == {0, None}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    assert [(r.bin, r.n) for r in A.histogram(df, "x", 30).collect()] == [(0, 2)]


def test_null_identifiers_survive(spark):
    rows = [("a", None, 1.0)] + [("a", "x", float(i)) for i in range(3)] + [("b", "x", 1.0)]
    df = spark.createDataFrame(rows, "p string, q string, risk_score double")
    bad = V.k_violations(df, ["p", "q"], 3)
    assert {(r.p, r.q) for r in bad.collect()} == {("a", "UNKNOWN"), ("b", "x")}
    assert V.suppress(df, bad, ["p", "q"]).count() == 4
    assert V.suppress(df, bad, ["p", "q"], null_too=True).count() == 3


def test_zero_as_missing_and_impute(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (4.0,), (None,)], "x double")
    assert sorted(r.x for r in feat.zero_as_missing(df, ["x"]).collect()) == [2.0, 3.0, 3.0, 4.0]


def test_engineer_leaves_nothing_missing(spark):
    rows = [(1, 100.0, 0.1, 1.0, 0.0, 0.5, None, 10.0, 10.0), (2, None, 0.1, 1.0, 0.0, 0.5, 0.2, 10.0, 10.0)]
    df = spark.createDataFrame(rows, "customer_id int, " + ", ".join(f"{c} double" for c in K.RAW_ATTRIBUTES))
    assert all(v is not None for r in feat.engineer(df).collect() for v in r)
    with pytest.raises(ValueError, match="savings_rate"):
        feat.require_columns(df.drop("savings_rate"), K.RAW_ATTRIBUTES)


def test_poisson_mean(spark):
    df = spark.range(20000).select(feat.poisson(N.uniform(F.col("id"), 0, 1), 0.8).alias("n"))
    assert math.isclose(df.agg(F.avg("n")).first()[0], 0.8, abs_tol=0.03)
