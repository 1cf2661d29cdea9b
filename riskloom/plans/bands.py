"""Queries on bands and levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import bands as B
from riskloom.functions.numeric import unit_if_above_one
from riskloom.operators.range_rules import apply_range_rules
from riskloom.operators.scoring import behaviour_score
from riskloom.plans.registry import query
from riskloom.plans.sqltext import HISTORY, WIDE, d, with_
from riskloom.sources import proxies as P
from riskloom.sources.tables import read

BEHAVIOUR = f"({d(0.4)} * payment_discipline_score + {d(0.3)} * income_stability_index + {d(0.3)} * financial_resilience_score)"
BAND_API = """CASE WHEN {0} < CAST(0.33 AS DOUBLE) THEN '{1}' WHEN {0} < CAST(0.66 AS DOUBLE) THEN '{2}' ELSE '{3}' END"""


def band_sql(e: str, part: int = 0) -> str:
    return BAND_API.format(e, K.BAND_LOW[part], K.BAND_MEDIUM[part], K.BAND_HIGH[part])


def cut_sql(e: str, labels=("LOW", "MEDIUM", "HIGH"), outside="'nan'") -> str:
    return (
        f"CASE WHEN {e} >= 0 AND {e} <= {d(0.33)} THEN '{labels[0]}' WHEN {e} > {d(0.33)} AND {e} <= {d(0.66)} THEN '{labels[1]}'"
        f" WHEN {e} > {d(0.66)} AND {e} <= 1 THEN '{labels[2]}' ELSE {outside} END"
    )


@query(
    "band_api",
    with_(HISTORY) + f"""SELECT prediction_id, {band_sql('risk_score')} AS band, {band_sql('risk_score', 1)} AS color,
  {band_sql('risk_score', 2)} AS label FROM ph""",
)
def band_api(spark, sf):
    return P.prediction_history(spark, sf).select("prediction_id", B.band_api(F.col("risk_score")).alias("b")).select(
        "prediction_id", "b.band", "b.color", "b.label"
    )


@query("band_cut_predictions", with_(HISTORY) + f"SELECT prediction_id, {cut_sql('risk_score')} AS predicted_band FROM ph")
def band_cut_predictions(spark, sf):
    return P.prediction_history(spark, sf).select("prediction_id", B.band_cut(F.col("risk_score")).alias("predicted_band"))


@query(
    "band_cut_localised",
    WIDE + f", s AS (SELECT customer_id, least({d(1)}, greatest({d(0)}, risk_score / {d(25)})) AS x, risk_score FROM ec)"
    f"SELECT customer_id, CASE WHEN risk_score IS NULL THEN NULL ELSE {cut_sql('x', ('DÜŞÜK', 'ORTA', 'YÜKSEK'), 'NULL')} END AS predicted_band FROM s",
)
def band_cut_localised(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", "risk_score").select(
        "customer_id", B.band_cut_localised(F.col("risk_score")).alias("predicted_band")
    )


@query("band_cut_synth", WIDE + "SELECT customer_id, risk_band FROM ec")
def band_cut_synth(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", "risk_band")


@query(
    "band_trigger",
    WIDE + f""", t AS (SELECT customer_id, payment_discipline_score / {d(100)} * {d(0.4)} + income_stability_index / {d(100)} * {d(0.3)}
  + financial_resilience_score / {d(100)} * {d(0.3)} AS s FROM ec)
SELECT customer_id, CASE WHEN s >= {d(0.7)} THEN 'High' WHEN s >= {d(0.4)} THEN 'Medium' ELSE 'Low' END AS risk_band FROM t""",
)
def band_trigger(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    return wide.select("customer_id", B.band_trigger(behaviour_score(unit=True)).alias("risk_band"))


CATEGORY = f"CASE WHEN risk_score < 40 THEN 'Low Risk' WHEN risk_score BETWEEN 40 AND 70 THEN 'Medium Risk' ELSE 'High Risk' END"
SEGMENT = f"""CASE WHEN spending_ratio > {d(0.8)} THEN 'High Spender' WHEN spending_ratio BETWEEN {d(0.5)} AND {d(0.8)} THEN 'Moderate Spender'
  ELSE 'Low Spender' END"""


@query("band_sql_0_100", WIDE + f"SELECT customer_id, {CATEGORY} AS risk_category FROM ec")
def band_sql_0_100(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", "risk_score").select(
        "customer_id", B.risk_category(F.col("risk_score")).alias("risk_category")
    )


@query("spending_segment", WIDE + f"SELECT customer_id, {SEGMENT} AS spending_segment FROM ec")
def spending_segment(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", "spending_ratio").select(
        "customer_id", B.spending_segment(F.col("spending_ratio")).alias("spending_segment")
    )


@query(
    "risk_zone",
    WIDE + f"""SELECT customer_id, CASE WHEN {BEHAVIOUR} < 50 THEN 'High' WHEN {BEHAVIOUR} < 75 THEN 'Medium'
  WHEN {BEHAVIOUR} >= 75 THEN 'Low' END AS zone FROM ec""",
)
def risk_zone(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    return wide.select("customer_id", B.risk_zone(behaviour_score()).alias("zone"))


@query(
    "score_interpretation",
    WIDE + "SELECT customer_id, " + ", ".join(
        f"CASE WHEN {c} >= 80 THEN 'yüksek' WHEN {c} >= 60 THEN 'orta' ELSE 'düşük' END AS {c}_word" for c in K.FEATURES
    ) + " FROM ec",
)
def score_interpretation(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    return wide.select("customer_id", *[B.score_word(F.col(c)).alias(f"{c}_word") for c in K.FEATURES])


def unit_sql(c: str) -> str:
    return f"(CASE WHEN {c} > 1 THEN {c} / {d(100)} ELSE {c} END)"


def level_sql(c: str) -> str:
    a, b = (0.3, 0.6) if c.startswith("financial") else (0.4, 0.7)
    v = unit_sql(c)
    return f"CASE WHEN {v} IS NULL THEN 'unknown' WHEN {v} < {d(a)} THEN 'high' WHEN {v} < {d(b)} THEN 'medium' ELSE 'low' END"


@query("factor_level", WIDE + "SELECT customer_id, " + ", ".join(f"{level_sql(c)} AS {c}_level" for c in K.FEATURES) + " FROM ec")
def factor_level(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    return wide.select(
        "customer_id",
        *[
            B.factor_level(unit_if_above_one(F.col(c)), c.startswith("financial")).alias(f"{c}_level")
            for c in K.FEATURES
        ],
    )


def _rules_values() -> str:
    def lit(v):
        return "NULL" if v is None else (d(v) if isinstance(v, float) else f"'{v}'")

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in K.RANGE_RULES)


_INS = K.RANGE_INSIGHT


@query(
    "range_rule_lookup",
    WIDE + f""", rules(feature, lo, hi, label, color, impact, priority, action, description) AS (VALUES {_rules_values()}),
v AS (
  SELECT customer_id, 'payment_discipline' AS feature, {unit_sql('payment_discipline_score')} AS v FROM ec
  UNION ALL SELECT customer_id, 'income_stability', {unit_sql('income_stability_index')} FROM ec
  UNION ALL SELECT customer_id, 'financial_resilience', {unit_sql('financial_resilience_score')} FROM ec
  UNION ALL SELECT customer_id, 'savings_rate', {unit_sql('savings_rate')} FROM ec),
m AS (
  SELECT v.*, rules.lo, rules.label, rules.color, rules.impact, rules.priority, rules.action, rules.description,
    v.feature NOT IN ('payment_discipline', 'income_stability', 'financial_resilience') AS unknown
  FROM v LEFT JOIN rules ON rules.feature = v.feature AND v.v >= rules.lo AND v.v < rules.hi),
n AS (
  SELECT *, CASE WHEN unknown THEN 'Unknown' WHEN v IS NULL THEN 'Invalid' WHEN lo IS NULL THEN 'Unmapped'
    WHEN feature = 'financial_resilience' AND v < {d(0.2)} THEN 'Kritik'
    WHEN feature IN ('financial_resilience', 'payment_discipline') AND v < {d(0.6)} THEN 'Zayıf'
    WHEN feature = 'income_stability' AND v < {d(0.6)} THEN 'Dengesiz'
    WHEN v < {d(0.8)} THEN 'Orta' WHEN feature = 'income_stability' THEN 'Stabil' ELSE 'Güçlü' END AS final_label FROM m)
SELECT customer_id, feature, v AS value, final_label AS label, coalesce(color, 'gray') AS color, coalesce(impact, {d(0)}) AS impact,
  coalesce(priority, 'LOW') AS priority,
  CASE WHEN unknown THEN 'Missing rule configuration' WHEN v IS NULL THEN 'Value could not be parsed'
    WHEN lo IS NULL THEN 'Value outside defined segmentation'
    WHEN feature = 'financial_resilience' AND v < {d(0.2)} THEN '{_INS['financial_resilience'][0]}'
    WHEN feature = 'financial_resilience' AND v < {d(0.6)} THEN '{_INS['financial_resilience'][1]}'
    WHEN feature = 'financial_resilience' THEN '{_INS['financial_resilience'][2]}'
    WHEN feature = 'income_stability' AND v < {d(0.6)} THEN '{_INS['income_stability'][0]}'
    WHEN feature = 'income_stability' THEN '{_INS['income_stability'][1]}'
    WHEN v < {d(0.6)} THEN '{_INS['payment_discipline'][0]}' ELSE '{_INS['payment_discipline'][1]}' END AS insight,
  CASE WHEN lo IS NULL THEN NULL
    WHEN feature = 'financial_resilience' AND v < {d(0.2)} THEN '{K.RANGE_ACTION_RESILIENCE}'
    WHEN feature = 'payment_discipline' AND v < {d(0.6)} THEN '{K.RANGE_ACTION_PAYMENT}'
    ELSE coalesce(action, final_label || ' optimization') END AS action,
  CASE WHEN lo IS NULL THEN NULL WHEN feature = 'financial_resilience' AND v < {d(0.2)} THEN '{K.RANGE_ACTION_TEXTS[0]}'
    WHEN feature = 'payment_discipline' AND v < {d(0.6)} THEN '{K.RANGE_ACTION_TEXTS[1]}' ELSE description END AS action_text,
  CASE WHEN lo IS NULL THEN NULL WHEN (feature = 'financial_resilience' AND v < {d(0.2)}) OR (feature = 'payment_discipline' AND v < {d(0.6)}) THEN 'HIGH'
    ELSE priority END AS action_priority,
  CASE WHEN unknown THEN '{K.RANGE_NO_RULE[0]}' WHEN v IS NULL THEN '{K.RANGE_NO_RULE[1]}' WHEN lo IS NULL THEN '{K.RANGE_NO_RULE[2]}' ELSE description END AS description
FROM n""",
)
def range_rule_lookup(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES, "savings_rate")
    long = wide.unpivot(
        ["customer_id"],
        [
            F.col("payment_discipline_score").alias("payment_discipline"),
            F.col("income_stability_index").alias("income_stability"),
            F.col("financial_resilience_score").alias("financial_resilience"),
            F.col("savings_rate"),
        ],
        "feature",
        "value",
    )
    return apply_range_rules(long)


@query(
    "band_normalise",
    """WITH t AS (SELECT o_orderkey AS prediction_id, upper(trim(' ' || lower(substr(o_orderpriority, 3)))) AS b FROM orders)
SELECT prediction_id, CASE WHEN b IN ('LOW', 'MEDIUM', 'HIGH') THEN b ELSE 'MEDIUM' END AS band FROM t""",
)
def band_normalise(spark, sf):
    words = F.concat(F.lit(" "), F.lower(F.substr(F.col("o_orderpriority"), F.lit(3))))
    return read(spark, sf, "orders", "o_orderkey", "o_orderpriority").select(
        F.col("o_orderkey").alias("prediction_id"), B.band_normalise(words).alias("band")
    )


@query(
    "band_override",
    WIDE + f"""SELECT customer_id, CASE WHEN upper(risk_band) = 'LOW' AND {unit_sql('financial_resilience_score')} < {d(0.3)}
  THEN 'MEDIUM' ELSE upper(risk_band) END AS final_band FROM ec""",
)
def band_override(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", "risk_band", "financial_resilience_score")
    return wide.select(
        "customer_id", B.band_override(F.upper("risk_band"), F.col("financial_resilience_score")).alias("final_band")
    )
