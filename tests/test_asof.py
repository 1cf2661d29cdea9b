"""As-of joins against plain loops, with hot keys cut over many parts."""

import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from riskloom.operators.asof import activation_periods, active_at, asof_join

LEFT, RIGHT = "id int, k string, t int", "k string, at int, tie int, v int"


def brute(left, right, keyed):
    out = Counter()
    for i, k, t in left:
        rows = [r for r in right if r[1] is not None and t is not None and r[1] <= t and (not keyed or (k is not None and r[0] == k))]
        if not keyed:
            rows = [r for r in rows if r[1] is not None]
        best = max(rows, key=lambda r: (r[1], r[2]), default=None)
        out[i, k, t, best[3] if best else None] += 1
    return out


def data(seed, n=300):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", "z", None])
    time = lambda: rng.choice([None] + [7] * 5 + list(range(40)))
    left = [(i, key(), time()) for i in range(n)]
    # One value per key, time and tie, as equal ones leave the choice open.
    right = {(k, t, tie): (k, t, tie, rng.choice([None, 1, 2, 3])) for k, t, tie in ((key(), time(), rng.randrange(5)) for _ in range(n // 3))}
    return left + left[:20], list(right.values())


@pytest.mark.parametrize("parts", [1, 4, 40])
@pytest.mark.parametrize("keyed", [True, False])
def test_against_plain_loops(spark, parts, keyed):
    left, right = data(parts)
    if not keyed:
        right = list({(t, tie): (k, t, tie, v) for k, t, tie, v in right}.values())
    by = ["k"] if keyed else []
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "t", "at", ["v"], by, "tie", parts)
    assert Counter(map(tuple, got.collect())) == brute(left, right, keyed)


def test_a_hot_key_is_cut_and_the_carry_reaches_far(spark):
    left = [(i, "hot", 10 + i) for i in range(2000)]
    right = [("hot", 5, 0, 42), ("cold", 3000, 0, 1)]
    joined = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "t", "at", ["v"], ["k"], "tie", 16)
    assert {r.v for r in joined.collect()} == {42} and joined.count() == 2000
    one_moment = [(i, "hot", 9) for i in range(2000)]
    rows = asof_join(spark.createDataFrame(one_moment, LEFT), spark.createDataFrame(right, RIGHT), "t", "at", ["v"], ["k"], "tie", 16)
    written = spark.read.parquet(rows.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in written.groupBy("_slot").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 600 and {r.v for r in rows.collect()} == {42}


def test_clashes_and_empty_sides(spark):
    left, right = spark.createDataFrame([(1, "a", 1)], LEFT), spark.createDataFrame([], RIGHT)
    assert [tuple(r) for r in asof_join(left, right, "t", "at", ["v"], ["k"], "tie").collect()] == [(1, "a", 1, None)]
    assert asof_join(left.limit(0), right, "t", "at", ["v"]).collect() == []
    with pytest.raises(ValueError):
        asof_join(left.withColumnRenamed("id", "v"), right, "t", "at", ["v"])


def test_stamps_of_their_own_time(spark):
    log = spark.createDataFrame([("v1", 10), ("v2", 20), ("v1", 30), ("v3", 30)], "model_version string, activated_at int")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([9, 10, 19, 20, 29, 30, 99])], "id int, t int")
    stamps = [r.model_version for r in active_at(rows, log, "t", "none").orderBy("id").collect()]
    assert stamps == ["none", "v1", "v1", "v2", "v2", "v3", "v3"]
    with pytest.raises(PySparkException, match="no active model"):
        active_at(rows, log, "t", None).collect()
    assert [r.model_version for r in active_at(rows.where("t >= 10"), log, "t", None).orderBy("id").collect()] == stamps[1:]
    ends = [tuple(r) for r in activation_periods(log).orderBy("activated_at", "model_version").collect()]
    assert ends == [("v1", 10, 20), ("v2", 20, 30), ("v1", 30, 30), ("v3", 30, None)]
