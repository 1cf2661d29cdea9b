"""Operators for large data against brute force on small data with hot values, and plan shapes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskloom import constants as K
from riskloom.operators import explain as X
from riskloom.operators import history as H
from riskloom.operators import quantiles as R
from riskloom.operators import scoring
from riskloom.operators.changes import change_log
from riskloom.plans import QUERIES
from riskloom.sources import proxies as P


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; some have none."""
    rng = random.Random(5)
    values = [0.25] * 400 + [rng.uniform(0, 1) for _ in range(700)] + [round(rng.uniform(0, 1), 1) for _ in range(100)] + [None] * 20
    rng.shuffle(values)
    return values, spark.createDataFrame(list(enumerate(values)), "customer_id int, x double").repartition(5)


def test_quantiles(skewed):
    values, df = skewed
    probs = {"a": 0.0, "b": 0.05, "c": 0.37, "d": 0.5, "e": 0.95, "f": 1.0}
    q = R.exact_quantiles(df, {n: ("x", p) for n, p in probs.items()})
    got = df.limit(1).select(*[v.alias(n) for n, v in q.items()]).first()
    want = np.quantile([v for v in values if v is not None], list(probs.values()))
    assert [got[n] for n in probs] == pytest.approx(list(want), abs=1e-12)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    q = R.exact_quantiles(df, {"m": ("x", 0.5)})
    assert df.select(q["m"].alias("m")).first().m is None


def test_percent_rank(skewed):
    import pandas as pd

    values, df = skewed
    want = pd.Series(values, dtype=float).rank(pct=True)
    got = {r.customer_id: r.p for r in R.with_percent_rank(df, "x", "p").collect()}
    assert len(got) == len(values)
    for i, w in want.items():
        assert got[i] is None if np.isnan(w) else got[i] == pytest.approx(w)


@pytest.mark.parametrize("tiles", [5, 7, 2000])
def test_ntile(skewed, tiles):
    from pyspark.sql import Window

    _, df = skewed
    order = [F.desc_nulls_first("x"), F.asc("customer_id")]
    placed, total = R.with_global_position(df, order)
    got = placed.select("customer_id", R.ntile_of(F.col("position"), total, tiles).alias("t")).collect()
    want = df.select("customer_id", F.ntile(tiles).over(Window.orderBy(*order)).alias("t")).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


@pytest.fixture(scope="module")
def updates(spark):
    """Customer 1 holds most of the updates."""
    from datetime import datetime, timedelta

    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = [
        (1 if rng.random() < 0.6 else rng.randint(2, 6), i, start + timedelta(minutes=7 * i), rng.choice([None, 1.0, 2.0]))
        for i in range(600)
    ]
    return rows, spark.createDataFrame(rows, "customer_id long, event_id long, event_time timestamp, risk_score double")


def expected_changes(rows):
    last, out = {}, set()
    for c, e, _, s in sorted(rows, key=lambda r: (r[2], r[1])):
        if c not in last:
            out.add((c, e, "INSERT"))
        elif last[c] != s:
            out.add((c, e, "UPDATE"))
        last[c] = s
    return out


@pytest.mark.parametrize("parts", [2, 7])
def test_change_log(updates, parts):
    rows, df = updates
    got = {(r.customer_id, r.event_id, r.change) for r in change_log(df, parts=parts).collect()}
    assert got == expected_changes(rows)


def test_newest_rows_are_limited_before_the_shuffle(spark, sf):
    df = H.newest_per_customer(P.raw_events(spark, sf), "event_time", "event_id", 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    rows = P.raw_events(spark, sf).collect()
    newest = {}
    for r in sorted(rows, key=lambda r: (r.event_time, r.event_id), reverse=True):
        newest.setdefault(r.customer_id, []).append(r.event_id)
    want = {e for ids in newest.values() for e in ids[:3]}
    assert {r.event_id for r in df.collect()} == want


def test_local_surrogate_finds_a_linear_model(spark):
    rng = np.random.default_rng(1)
    data = rng.uniform(0, 100, (30, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "customer_id int, " + ", ".join(f"{c} double" for c in K.FEATURES))
    weights = [0.2, -0.5, 1.5]

    def score(frame):
        return sum((F.col(c) * w for c, w in zip(K.FEATURES, weights)), F.lit(7.0))

    out = X.local_surrogate(df, score, samples=32, ridge=0.0).toPandas()
    for i, (c, w) in enumerate(zip(K.FEATURES, weights)):
        assert out[f"{c}_weight"].to_numpy() == pytest.approx(np.full(30, w * data[:, i].std()), rel=1e-6)


def test_more_draws_change_the_surrogate_little(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.uniform(0, 100, (40, 3)))], "customer_id int, " + ", ".join(f"{c} double" for c in K.FEATURES))
    few, many = (X.local_surrogate(df, scoring.linear_model, samples=n).orderBy("customer_id").toPandas() for n in (5000, 20000))
    for c in K.FEATURES:
        a, b = few[f"{c}_weight"].to_numpy(), many[f"{c}_weight"].to_numpy()
        assert abs(a.mean() / b.mean() - 1) < 0.01
    plan = plan_of(X.local_surrogate(df, scoring.linear_model))
    assert "md5" not in plan and plan.split("== Physical")[-1].count("Exchange hashpartitioning") <= 2


ODD = [(None, 50.0, 50.0), (0.0, 0.0, 0.0), (100.0, 100.0, 100.0), (-300.0, 20.0, 1.0), (400.0, 90.0, 99.0), (float("nan"), 10.0, 70.0)]


@pytest.mark.parametrize("rest", [[], [(float("inf"), 3.0, 4.0)], [(5.0, float("nan"), 4.0)]])
def test_a_bounded_line_needs_no_copies(spark, rest):
    """The sums of a bounded line are those of its scored copies: clipped rows, missing values, a constant and an infinite feature."""
    rng = np.random.default_rng(3)
    rows = [*map(tuple, rng.uniform(-20, 120, (40, 3)).tolist()), *(r for r in ODD if r[0] == r[0]), *rest]
    schema = "customer_id int, " + ", ".join(f"{c} double" for c in K.FEATURES)
    for made in (rows, [(a, 7.0, c) for a, _, c in rows], rows[:1], [], ODD):
        df = spark.createDataFrame([(i % 30, *r) for i, r in enumerate(made)], schema)
        line = X.local_surrogate(df, scoring.linear_model, samples=300)
        assert "Generate" not in plan_of(line) and "Exchange" not in plan_of(line)
        copies = X.local_surrogate(df, lambda frame: scoring.linear_model(frame), samples=300)
        got, want = (np.array(sorted(tuple(map(str, r[:1])) + tuple(-1e99 if x is None or x != x else round(x, 7) + 0.0 for x in r[1:]) for r in f.collect()), dtype=object) for f in (line, copies))
        assert len(got) == len(want) == len(made)
        if len(got):
            assert got[:, 1:].astype(float) == pytest.approx(want[:, 1:].astype(float), abs=1e-6)


def test_tasks_that_make_copies_are_not_merged_by_size(spark):
    rows = spark.createDataFrame([(i, i / 10, 50.0, i / 20) for i in range(1000)], "customer_id int, " + ", ".join(f"{c} double" for c in K.FEATURES))
    plan = plan_of(X.local_surrogate(rows, lambda frame: scoring.linear_model(frame), samples=50)).split("== Physical")[-1]
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") <= 2


def test_percent_rank_with_constant_ends(skewed):
    values, df = skewed
    plain = {r.customer_id: r.p for r in R.with_percent_rank(df, "x", "p").collect()}
    ends = {r.customer_id: r.p for r in R.with_percent_rank(df, "x", "p", ends=(0.25, 7.0)).collect()}
    assert plain == ends


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["risk_distribution", "risk_response", "prediction_table", "threshold_sweep", "anonymize_pipeline", "range_rule_lookup", "drift_psi"]
)
def test_plans_stay_in_the_engine(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "BroadcastNestedLoopJoin", "Join Cross"):
        assert bad not in plan


def test_only_needed_columns_are_read(spark, sf):
    plan = plan_of(QUERIES["spending_segments"](spark, sf))
    assert "lineitem" not in plan and "l_returnflag" not in plan
    assert "o_orderstatus" not in plan.split("== Physical")[-1].split("ReadSchema")[-1]


def test_window_filter_reaches_the_scan(spark, sf):
    plan = plan_of(P.feature_snapshot(spark, sf, P.NEW_WINDOW))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan
