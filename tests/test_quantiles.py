"""Quantiles by selection against sorting: ties, repeats, missing values, missed and crowded brackets."""

import math
import random

import pytest
from riskloom.operators import quantiles as Q

NAN, INF = float("nan"), float("inf")
MARKS = [0.0, 0.05, 0.25, 0.5, 0.7, 0.95, 1.0]


def linear(values, p):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    if not values:
        return None
    at = (len(values) - 1) * p
    return Q.interpolated(values[math.floor(at)], values[math.ceil(at)], at)


def columns(seed, n):
    rng = random.Random(seed)
    return {
        "plain": [rng.gauss(0, 1) for _ in range(n)],
        "ties": [rng.choice([0.0, -0.0, 1.0, 1.0, 1.0, 7.5]) for _ in range(n)],
        "one": [3.25] * n,
        "holes": [rng.choice([None, NAN, rng.random()]) for _ in range(n)],
        "ends": [rng.choice([INF, -INF, 0.0, rng.random()]) for _ in range(n)],
        "none": [None] * n,
        "steps": [float(i // 3) for i in range(n)],
    }


def check(spark, data, few):
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(5)
    wanted = {f"{c}:{p}": (c, p) for c in data for p in MARKS}
    got = Q.selected_quantiles(df, wanted, few)
    for name, (c, p) in wanted.items():
        assert got[name] == linear(data[c], p), name


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3001])
@pytest.mark.parametrize("few", [1, 10_000])
def test_against_sorting(spark, n, few):
    check(spark, columns(n, n), few)


def test_crude_sketches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(Q, "ACCURACY", 8)
    check(spark, columns(9, 2000), 5)


def test_missed_brackets_are_widened(spark):
    values = [float(v) for v in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    brackets = [Q._Bracket("x", k, low, high) for k in (0, 500, 999) for low, high in ((600.0, 650.0), (100.0, 100.0), (-9.0, -8.0), (2000.0, 2001.0))]
    Q.select_places(df, brackets, few=20)
    assert [b.found for b in brackets] == [float(b.place) for b in brackets]


def test_no_value_table_is_shuffled_or_written(spark):
    df = spark.range(5000).selectExpr("id * 1.0D as x", "id % 7 * 1.0D as y")
    sketches = df.agg(Q._sketched(df.x, [0.5]))._jdf.queryExecution().executedPlan().toString()
    assert sketches.count("Exchange SinglePartition") == 1
    known = df.where("x > 10")
    before = set(spark.sparkContext.statusTracker().getActiveJobsIds())
    assert Q.selected_quantiles(known, {"m": ("x", 0.5), "n": ("y", 0.5)}) == {"m": 2505.0, "n": 3.0}
    assert set(spark.sparkContext.statusTracker().getActiveJobsIds()) == before
    empty = Q.exact_quantiles(df.where("x < 0"), {"m": ("x", 0.5)})
    assert df.limit(1).select(empty["m"]).first()[0] is None
