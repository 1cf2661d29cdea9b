"""Queries on joins and lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.operators import asof
from riskloom.operators import joins as J
from riskloom.operators.rules import rule_score
from riskloom.plans.registry import query
from riskloom.plans.scoring import RUN_TS, RULE_SUM
from riskloom.plans.sqltext import HISTORY, activations_cte, registry_cte, snapshot_cte, wide_cte, with_
from riskloom.sources import proxies as P
from riskloom.sources.bucketed import write_bucketed
from riskloom.sources.sqlfunctions import register_functions
from riskloom.sources.tables import read

PAY, INC, RES = K.FEATURES
CUR = snapshot_cte("cur", P.NEW_WINDOW)
ALL = snapshot_cte("cur")
_FEATURE_LIST = f"{PAY}, {INC}, {RES}"


def customers(spark, sf):
    return read(spark, sf, "customer", "c_custkey").select(
        F.col("c_custkey").alias("customer_id"), F.lit(RUN_TS).cast("timestamp_ntz").alias("created_at")
    )


def feature_store(spark, sf):
    return P.feature_snapshot(spark, sf).withColumn("created_at", F.lit(RUN_TS).cast("timestamp_ntz"))


_VIEW = with_(ALL) + f"""SELECT c_custkey AS customer_id, TIMESTAMP '{RUN_TS}' AS created_at, {_FEATURE_LIST}, risk_score, risk_band,
  TIMESTAMP '{RUN_TS}' AS feature_created_at FROM customer JOIN cur ON cur.customer_id = c_custkey"""


@query("customer_feature_view", _VIEW)
def customer_feature_view(spark, sf):
    return J.customer_feature_view(customers(spark, sf), feature_store(spark, sf))


@query("dataset_view", _VIEW)
def dataset_view(spark, sf):
    return J.dataset_view(customer_feature_view(spark, sf), f"engineered_customers_dataset_{uuid.uuid4().hex}")


@query("active_model_lookup", with_(ALL, registry_cte()) + "SELECT customer_id, (SELECT min(model_version) FROM mr WHERE is_active) AS model_version FROM cur")
def active_model_lookup(spark, sf):
    ids = P.feature_snapshot(spark, sf).select("customer_id")
    return J.with_active_model(ids, P.model_registry(spark, sf))


@query("active_model_fallback", with_(ALL) + f"SELECT customer_id, '{K.UNKNOWN_MODEL}' AS model_version FROM cur")
def active_model_fallback(spark, sf):
    ids = P.feature_snapshot(spark, sf).select("customer_id")
    return J.with_active_model(ids, P.model_registry(spark, sf, active=None))


@query(
    "active_model_as_of",
    with_(activations_cte()) + f"""SELECT prediction_id, customer_id, prediction_time, coalesce(act.model_version, '{K.UNKNOWN_MODEL}') AS model_version
FROM ph ASOF LEFT JOIN act ON ph.prediction_time >= act.activated_at""",
)
def active_model_as_of(spark, sf):
    """Stored predictions with the model that was active when each was made."""
    rows = P.prediction_history(spark, sf).select("prediction_id", "customer_id", "prediction_time")
    return asof.active_at(rows, P.model_activations(spark, sf), "prediction_time")


@query(
    "activation_periods",
    with_(activations_cte()) + "SELECT model_version, activated_at, lead(activated_at) OVER (ORDER BY activated_at, model_version) AS ended_at FROM act",
)
def activation_periods(spark, sf):
    return asof.activation_periods(P.model_activations(spark, sf))


@query(
    "score_as_of",
    with_(HISTORY, """
newest AS (SELECT customer_id, prediction_time, arg_max(risk_score, prediction_id) AS risk_score FROM ph GROUP BY ALL),
e AS (SELECT event_id, user_id AS customer_id, ts AS event_time FROM events)""")
    + """SELECT e.event_id, e.customer_id, e.event_time, newest.risk_score
FROM e ASOF LEFT JOIN newest ON e.customer_id = newest.customer_id AND e.event_time >= newest.prediction_time""",
)
def score_as_of(spark, sf):
    """Behaviour events with the customer's risk score as it was known at the time, nothing from later."""
    events = P.raw_events(spark, sf).select("event_id", "customer_id", "event_time")
    scores = P.prediction_history(spark, sf).select("customer_id", "prediction_id", "prediction_time", "risk_score")
    return asof.asof_join(events, scores, "event_time", "prediction_time", ["risk_score"], ["customer_id"], "prediction_id")


@query(
    "risk_score_lookup",
    with_(CUR) + "SELECT c_custkey AS customer_id, coalesce(risk_score, 0) AS risk_score FROM customer LEFT JOIN cur ON cur.customer_id = c_custkey",
)
def risk_score_lookup(spark, sf):
    return J.score_lookup(customers(spark, sf).select("customer_id"), P.feature_snapshot(spark, sf, P.NEW_WINDOW))


_LOOKUP = with_(CUR) + "SELECT c_custkey AS customer_id, coalesce(risk_score, 0) AS risk_score FROM customer LEFT JOIN cur ON cur.customer_id = c_custkey"


def _with_functions(spark, sf):
    """Views of the customers and of the features, and the SQL functions over them; the name of the first."""
    mark = uuid.uuid4().hex
    P.feature_snapshot(spark, sf, P.NEW_WINDOW).createOrReplaceTempView(f"features_{mark}")
    customers(spark, sf).createOrReplaceTempView(f"customers_{mark}")
    register_functions(spark, f"features_{mark}")
    return f"customers_{mark}"


@query("sql_risk_score_function", _LOOKUP)
def sql_risk_score_function(spark, sf):
    return spark.sql(f"SELECT customer_id, risk_score_of(customer_id) AS risk_score FROM {_with_functions(spark, sf)}")


@query(
    "sql_explain_function",
    with_(CUR) + """SELECT c_custkey AS customer_id, CASE WHEN cur.customer_id IS NULL THEN 'customer_not_found' END AS error, cur.risk_score, risk_band
FROM customer LEFT JOIN cur ON cur.customer_id = c_custkey""",
)
def sql_explain_function(spark, sf):
    """The JSON text of every customer, its fields read back."""
    known = spark.sql(f"SELECT customer_id, explain_customer(customer_id) AS said FROM {_with_functions(spark, sf)}")
    said = F.from_json("said", "customer_id bigint, risk_score double, risk_band string, error string")
    return known.select("customer_id", said.alias("said")).select("customer_id", "said.error", "said.risk_score", "said.risk_band")


@query("sql_customers_in_band", with_(CUR) + "SELECT customer_id, risk_score FROM cur WHERE risk_band = 'Low' AND risk_score > 0.1")
def sql_customers_in_band(spark, sf):
    _with_functions(spark, sf)
    return spark.sql("SELECT customer_id, risk_score FROM customers_in_band('Low') WHERE calculate_risk_score(customer_id) > 0.1")


BUCKETS = 8


@query("customer_feature_view_bucketed", _VIEW)
def customer_feature_view_bucketed(spark, sf):
    """The view over tables that are kept in buckets of the customer: the join shuffles nothing."""
    mark = uuid.uuid4().hex
    people = write_bucketed(customers(spark, sf), f"bucketed_customers_{mark}", "customer_id", BUCKETS)
    features = write_bucketed(feature_store(spark, sf), f"bucketed_features_{mark}", "customer_id", BUCKETS)
    return J.customer_feature_view(people, features)


@query(
    "fk_orphans",
    with_(CUR) + """SELECT o_orderkey AS prediction_id, o_custkey AS customer_id FROM orders
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.customer_id = o_custkey)""",
)
def fk_orphans(spark, sf):
    child = P.prediction_history(spark, sf).select("prediction_id", "customer_id")
    return J.fk_orphans(child, P.feature_snapshot(spark, sf, P.NEW_WINDOW), "customer_id")


@query(
    "explain_factors_join",
    with_(ALL, wide_cte()) + f"""SELECT cur.customer_id, cur.risk_score, cur.risk_band, spending_ratio, bill_payment_delay_avg, savings_rate,
  employment_duration_months FROM cur JOIN ec ON ec.customer_id = cur.customer_id""",
)
def explain_factors_join(spark, sf):
    scored = P.feature_snapshot(spark, sf).select("customer_id", "risk_score", "risk_band")
    attributes = P.customer_attributes(
        spark, sf, ["spending_ratio", "bill_payment_delay_avg", "savings_rate", "employment_duration_months"]
    )
    return scored.join(attributes, "customer_id")


@query(
    "score_vs_rules_join",
    with_(ALL, f"{wide_cte()}, rl AS (SELECT customer_id, {RULE_SUM} AS rule_score FROM ec)") + f"""SELECT cur.customer_id, {PAY}, {INC}, {RES}, rule_score
FROM cur JOIN rl ON rl.customer_id = cur.customer_id""",
)
def score_vs_rules_join(spark, sf):
    features = P.feature_snapshot(spark, sf).select("customer_id", *K.FEATURES)
    joined = J.features_with_attributes(features, P.customer_attributes(spark, sf))
    return joined.select("customer_id", *K.FEATURES, rule_score().alias("rule_score"))
