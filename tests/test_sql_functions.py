"""SQL functions and bucketed tables: results and plans."""

import uuid

import pytest
from pyspark.sql import functions as F
from riskloom.sources.bucketed import write_bucketed
from riskloom.sources.sqlfunctions import NOT_FOUND, register_functions

FEATURES = "customer_id bigint, risk_score double, risk_band string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def features(spark):
    name = f"features_{uuid.uuid4().hex}"
    spark.createDataFrame([(1, 0.5, "Medium"), (2, None, "Low"), (3, 0.9, None)], FEATURES).createOrReplaceTempView(name)
    register_functions(spark, name)
    return name


def test_lookups(spark, features):
    rows = spark.sql("SELECT id, calculate_risk_score(id) AS a, risk_score_of(id) AS b, explain_customer(id) AS c FROM range(1, 5)").collect()
    assert [(r.id, r.a, r.b) for r in rows] == [(1, 0.5, 0.5), (2, 0.0, 0.0), (3, 0.9, 0.9), (4, 0.0, 0.0)]
    assert [r.c for r in rows] == ['{"customer_id":1,"risk_score":0.5,"risk_band":"Medium"}', '{"customer_id":2,"risk_band":"Low"}', '{"customer_id":3,"risk_score":0.9}', NOT_FOUND]
    assert spark.sql("SELECT risk_score_of(NULL) AS s, explain_customer(NULL) AS e").first() == (0.0, NOT_FOUND)


def test_calls_are_joins_and_can_filter(spark, features):
    df = spark.sql("SELECT id FROM range(1, 5) WHERE risk_score_of(id) > 0.4")
    assert sorted(r.id for r in df.collect()) == [1, 3] and "Join" in plan_of(df)
    assert [tuple(r) for r in spark.sql("SELECT * FROM customers_in_band('Medium')").collect()] == [(1, 0.5)]
    both = spark.sql("SELECT b, t.customer_id FROM VALUES ('Medium'), ('Low'), ('none') AS x(b), LATERAL customers_in_band(b) t")
    assert sorted(map(tuple, both.collect())) == [("Low", 2), ("Medium", 1)]


def test_other_views_replace_and_odd_names_are_refused(spark, features):
    other = f"other_{uuid.uuid4().hex}"
    spark.createDataFrame([(1, 0.25, "Low")], FEATURES).createOrReplaceTempView(other)
    register_functions(spark, other)
    assert spark.sql("SELECT risk_score_of(1)").first()[0] == 0.25
    with pytest.raises(ValueError):
        register_functions(spark, "x; DROP TABLE y")


def test_buckets_join_without_an_exchange(spark):
    left = spark.range(500).select((F.col("id") % 97).alias("k"), "id")
    right = spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    a, b = (write_bucketed(df, n, "k", 4) for df, n in zip((left, right), names))
    joined = a.join(b.hint("merge"), "k")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in plan_of(left.join(right.hint("merge"), "k"))
    counted = plan_of(a.groupBy("k").count())
    assert "Exchange" not in counted
    for n in names:
        spark.sql(f"DROP TABLE {n}")
