"""Queries on ranks, tiles, top rows and latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import round_up
from riskloom.operators import history as H
from riskloom.operators import portfolio as A
from riskloom.operators.quantiles import ntile_of, with_global_position, with_percent_rank
from riskloom.operators.scoring import calibration_bin, intersectional_bias, latest_prediction, median_split_bias
from riskloom.plans.bands import band_sql
from riskloom.plans.registry import query
from riskloom.plans.scoring import SCALED_CTE, _bias_group, _scaled, bin_sql
from riskloom.plans.sqltext import HISTORY, WIDE, d, r, with_
from riskloom.sources import proxies as P
from riskloom.sources.store import materialise

PAY, INC, RES = K.FEATURES


@query(
    "risk_quintiles",
    WIDE + """SELECT customer_id, risk_score, CAST(ntile(5) OVER (ORDER BY risk_score DESC NULLS FIRST, customer_id) AS INTEGER) AS risk_percentile_group FROM ec""",
)
def risk_quintiles(spark, sf):
    scores = P.wide_customers(spark, sf, "customer_id", "risk_score")
    placed, total = with_global_position(scores, [F.desc_nulls_first("risk_score"), F.asc("customer_id")])
    return placed.select("customer_id", "risk_score", ntile_of(F.col("position"), total, 5).alias("risk_percentile_group"))


@query("band_share", WIDE + f"SELECT risk_band, {r('count(*) * 100.0 / sum(count(*)) OVER ()', 9)} AS percentage FROM ec GROUP BY 1")
def band_share(spark, sf):
    out = A.band_share(P.wide_customers(spark, sf, "risk_band"))
    return out.select("risk_band", round_up(F.col("percentage"), 9).alias("percentage"))


_TOP = ["customer_id", "risk_score", "missed_payments_6m", "spending_ratio", "savings_rate"]


@query("top_risk", WIDE + f"SELECT {', '.join(_TOP)} FROM ec ORDER BY risk_score DESC NULLS FIRST, customer_id LIMIT 10")
def top_risk(spark, sf):
    return A.top_rows(P.wide_customers(spark, sf, *_TOP), "risk_score", _TOP)


@query("top_resilience", WIDE + f"SELECT customer_id, {RES} FROM ec ORDER BY {RES} DESC NULLS FIRST, customer_id LIMIT 10")
def top_resilience(spark, sf):
    return A.top_rows(P.wide_customers(spark, sf, "customer_id", RES), RES, ["customer_id", RES])


@query(
    "latest_prediction",
    with_(HISTORY) + """SELECT customer_id, prediction_id, prediction_time, risk_score, model_version, dataset_version, created_by, original_band, feature_version
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY prediction_time DESC, prediction_id DESC) AS rn FROM ph) WHERE rn = 1""",
)
def latest_prediction_query(spark, sf):
    return latest_prediction(P.prediction_history(spark, sf))


@query(
    "prediction_history_50",
    with_(HISTORY) + f""", k AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY prediction_time DESC, prediction_id DESC) AS rn FROM ph)
SELECT customer_id, prediction_id, risk_score AS predicted_risk_score, original_band, {band_sql('risk_score')} AS predicted_band, model_version, feature_version, dataset_version,
  prediction_time, created_by, count(*) OVER (PARTITION BY customer_id) AS total_records FROM (SELECT * FROM k WHERE rn <= 50)""",
)
def prediction_history_50(spark, sf):
    return H.prediction_history(P.prediction_history(spark, sf))


@query(
    "latest_events",
    """SELECT event_id, user_id AS customer_id, event_type, value AS event_value, ts AS event_time, CAST(rn AS INTEGER) AS place
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 20""",
)
def latest_events(spark, sf):
    return H.newest_per_customer(P.raw_events(spark, sf), "event_time", "event_id", 20)


@query(
    "risk_percentile",
    WIDE + SCALED_CTE + f"""SELECT customer_id, {r(f'(rank() OVER (ORDER BY predicted) + (count(*) OVER (PARTITION BY predicted) - 1) / {d(2)}) / (SELECT count(predicted) FROM sc)', 9)} AS risk_percentile FROM sc""",
)
def risk_percentile(spark, sf):
    scored = _scaled(spark, sf).select("customer_id", "predicted_risk_score")
    out = with_percent_rank(scored, "predicted_risk_score", "risk_percentile")
    return out.select("customer_id", round_up(F.col("risk_percentile"), 9).alias("risk_percentile"))


@query(
    "income_percentile",
    WIDE + f"""SELECT customer_id, CASE WHEN monthly_income IS NOT NULL THEN {r(f'(rank() OVER (ORDER BY monthly_income NULLS LAST) + (count(*) OVER (PARTITION BY monthly_income) - 1) / {d(2)}) / (SELECT count(monthly_income) FROM ec)', 9)} END AS income_percentile FROM ec""",
)
def income_percentile(spark, sf):
    stored = materialise(P.customer_attributes(spark, sf, ["monthly_income"]))
    out = with_percent_rank(stored, "monthly_income", "income_percentile")
    return out.select("customer_id", round_up(F.col("income_percentile"), 9).alias("income_percentile"))


@query("calibration_bin", WIDE + SCALED_CTE + f"SELECT customer_id, {bin_sql('predicted', 'sc')} AS calibration_bin FROM sc")
def calibration_bin_query(spark, sf):
    scored = _scaled(spark, sf).select("customer_id", "predicted_risk_score")
    return calibration_bin(scored, "predicted_risk_score", 5, "calibration_bin").select("customer_id", "calibration_bin")


@query(
    "group_bias",
    WIDE + SCALED_CTE + f"""SELECT customer_id, {r('predicted - (SELECT avg(predicted) FROM sc)', 9)} AS bias_delta, """ + ", ".join(
        f"{r(f'predicted - avg(predicted) OVER (PARTITION BY {_bias_group(c)})', 9)} AS {c}_bias" for c in K.FEATURES
    ) + " FROM sc",
)
def group_bias_query(spark, sf):
    scored = _scaled(spark, sf)
    biases = median_split_bias(scored, "predicted_risk_score", K.FEATURES)
    mean = scored.agg(F.avg("predicted_risk_score")).scalar()
    return scored.select(
        "customer_id",
        round_up(F.col("predicted_risk_score") - mean, 9).alias("bias_delta"),
        *[round_up(bias, 9).alias(name) for name, bias in biases.items()],
    )


@query(
    "intersectional_bias",
    WIDE + SCALED_CTE + f"""SELECT customer_id, {r(f'predicted - avg(predicted) OVER (PARTITION BY round_even({INC} * {d(10)}, 0), round_even({PAY} * {d(10)}, 0))', 9)} AS intersectional_bias FROM sc""",
)
def intersectional_bias_query(spark, sf):
    scored = _scaled(spark, sf)
    out = intersectional_bias(scored, "predicted_risk_score", [INC, PAY])
    return out.select("customer_id", round_up(F.col("intersectional_bias"), 9).alias("intersectional_bias"))


@query("random_sample", with_(HISTORY) + "SELECT * FROM ph ORDER BY md5(CAST(prediction_id AS VARCHAR) || ':7') LIMIT 1")
def random_sample(spark, sf):
    return H.random_row(P.prediction_history(spark, sf), "prediction_id", 7)


@query("recent_audit", with_(HISTORY) + "SELECT * FROM ph ORDER BY prediction_time DESC, prediction_id DESC LIMIT 5")
def recent_audit(spark, sf):
    return H.recent_audit(P.prediction_history(spark, sf))
