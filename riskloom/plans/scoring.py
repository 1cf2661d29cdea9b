"""Queries on rules and scores."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.bands import band_api
from riskloom.functions.numeric import clamp01, dbl, round_up
from riskloom.operators import rules, scoring
from riskloom.plans.bands import BEHAVIOUR, band_sql, cut_sql
from riskloom.plans.registry import query
from riskloom.plans.sqltext import HISTORY, WIDE, clip as clip_sql, d, r, snapshot_cte, with_
from riskloom.sources import proxies as P
from riskloom.sources.store import append_results, materialise, scratch_path
from riskloom.sources.tables import read

PAY, INC, RES = K.FEATURES
RUN_TS = "2024-06-01 00:00:00"


def _fires_sql(a: str, op: str, b: float) -> str:
    return f"coalesce({a}, 0) {op} {d(b)}"


RULE_SUM = r(
    " + ".join(f"CASE WHEN {_fires_sql(a, op, b)} THEN {d(i)} ELSE {d(0)} END" for a, op, b, _, i in K.RULES), 3
)
RULE_NAMES = (
    "coalesce(nullif(concat_ws('|', "
    + ", ".join(f"CASE WHEN {_fires_sql(a, op, b)} THEN '{n}' END" for a, op, b, n, _ in K.RULES)
    + f"), ''), '{K.RULE_FALLBACK[0]}')"
)


@query(
    "rule_engine",
    WIDE + f"SELECT customer_id, {RULE_NAMES} AS rules, {RULE_SUM} AS score FROM ec",
)
def rule_engine(spark, sf):
    hits = rules.rule_hits()
    return P.customer_attributes(spark, sf).select(
        "customer_id", F.array_join(rules.rule_names(hits), "|").alias("rules"), rules.rule_score().alias("score")
    )


@query("rule_scorecard", WIDE + f"SELECT customer_id, {RULE_SUM} AS rule_score FROM ec")
def rule_scorecard(spark, sf):
    return P.customer_attributes(spark, sf).select(
        "customer_id", rules.scorecard(rules.rule_hits()).alias("rule_score")
    )


UNIT_BEHAVIOUR = f"(payment_discipline_score / {d(100)} * {d(0.4)} + income_stability_index / {d(100)} * {d(0.3)} + financial_resilience_score / {d(100)} * {d(0.3)})"


@query(
    "weighted_feature_score",
    WIDE + f"SELECT customer_id, {BEHAVIOUR} AS behaviour_score, {UNIT_BEHAVIOUR} AS behaviour_score_unit FROM ec",
)
def weighted_feature_score(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", *K.FEATURES).select(
        "customer_id",
        scoring.behaviour_score().alias("behaviour_score"),
        scoring.behaviour_score(unit=True).alias("behaviour_score_unit"),
    )


def target_sql(p: str, i: str, res: str) -> str:
    return clip_sql(f"{d(0.4)} * ({d(1)} - {i}) + {d(0.3)} * ({d(1)} - {p}) + {d(0.3)} * ({d(1)} - {res})", 0, 1)


def _filled(c: str) -> str:
    return f"coalesce(nullif({c}, 0), (SELECT median(nullif({c}, 0)) FROM ec))"


TARGET_CTE = f""",
f AS (SELECT customer_id, {', '.join(f'{_filled(c)} AS {c}' for c in K.FEATURES)} FROM ec),
ts AS (SELECT customer_id, {', '.join(K.FEATURES)}, {target_sql(f'{PAY} / {d(100)}', f'{INC} / {d(100)}', f'{RES} / {d(100)}')} AS true_risk_score FROM f)
"""


@query(
    "true_risk_score",
    WIDE + TARGET_CTE + f"""SELECT customer_id, {r('true_risk_score', 9)} AS true_risk_score,
  CASE WHEN true_risk_score > (SELECT quantile_cont(true_risk_score, 0.7) FROM ts) THEN 1 ELSE 0 END AS true_risk_label FROM ts""",
)
def true_risk_score(spark, sf):
    base = materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES))
    return scoring.true_risk_score(base).select(
        "customer_id", round_up(F.col("true_risk_score"), 9).alias("true_risk_score"), "true_risk_label"
    )


_Z = {c: f"coalesce({c}, 0) / {d(100)}" for c in K.FEATURES}
RAW_CTE = f", raw AS (SELECT *, {target_sql(_Z[PAY], _Z[INC], _Z[RES])} AS raw_score FROM ec)"
# The stand-in model has no stored artefact: its digest is that of its own description.
MODEL_VERSION = "linear-target-1"
MODEL_HASH = sha256(MODEL_VERSION.encode()).hexdigest()

SCALED_CTE = RAW_CTE + f""",
sc AS (SELECT *, least({d(1)}, greatest({d(0)}, (raw_score - (SELECT quantile_cont(raw_score, 0.05) FROM raw))
  / ((SELECT quantile_cont(raw_score, 0.95) FROM raw) - (SELECT quantile_cont(raw_score, 0.05) FROM raw) + {d(1e-6)}))) AS predicted FROM raw)
"""


def _scaled(spark, sf):
    """Stored frame of the features with the raw score and its robust scaling."""
    base = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    raw = materialise(base.withColumn("raw_score", scoring.linear_model(base)))
    return scoring.robust_scale(raw, "raw_score", "predicted_risk_score")


@query("robust_scale", WIDE + SCALED_CTE + f"SELECT customer_id, {r('predicted', 9)} AS predicted_risk_score FROM sc")
def robust_scale(spark, sf):
    return _scaled(spark, sf).select("customer_id", round_up(F.col("predicted_risk_score"), 9).alias("predicted_risk_score"))


@query("fixed_scale", WIDE + f"SELECT customer_id, {clip_sql(f'risk_score / {d(25)}', 0, 1)} AS scaled FROM ec")
def fixed_scale(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", "risk_score").select(
        "customer_id", scoring.fixed_scale(F.col("risk_score")).alias("scaled")
    )


@query(
    "standard_scale",
    WIDE + "SELECT customer_id, " + ", ".join(
        r(f"({c} - (SELECT avg({c}) FROM ec)) / (SELECT stddev_pop({c}) FROM ec)", 6) + f" AS {c}_scaled" for c in K.FEATURES
    ) + " FROM ec",
)
def standard_scale(spark, sf):
    out = scoring.standard_scale(materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES)), K.FEATURES)
    return out.select("customer_id", *[round_up(F.col(f"{c}_scaled"), 6).alias(f"{c}_scaled") for c in K.FEATURES])


ML = target_sql(_Z[PAY], _Z[INC], _Z[RES])


@query(
    "hybrid_score",
    WIDE + f""", h AS (SELECT customer_id, CASE WHEN {RES} IS NOT NULL THEN {ML} END AS ml_score,
  least({d(1)}, greatest({d(0)}, {RULE_SUM})) AS rule_score FROM ec),
g AS (SELECT *, CASE WHEN ml_score IS NULL THEN rule_score ELSE least({d(1)}, greatest({d(0)}, {d(0.7)} * ml_score + {d(0.3)} * rule_score)) END AS x FROM h)
SELECT customer_id, {r('x', 3)} AS hybrid_score, {band_sql('x')} AS risk_band, {band_sql('x', 1)} AS risk_color,
  {band_sql('x', 2)} AS risk_label, ml_score, rule_score FROM g""",
)
def hybrid_score(spark, sf):
    wide = P.wide_customers(spark, sf)
    s = wide.select(
        "customer_id",
        F.when(F.col(RES).isNotNull(), scoring.linear_model(wide)).alias("ml_score"),
        clamp01(rules.rule_score()).alias("rule_score"),
    ).withColumn("final", scoring.blend(F.col("ml_score"), F.col("rule_score")))
    band = band_api(F.col("final"))
    return s.select(
        "customer_id",
        round_up(F.col("final"), 3).alias("hybrid_score"),
        band.getField("band").alias("risk_band"),
        band.getField("color").alias("risk_color"),
        band.getField("label").alias("risk_label"),
        "ml_score",
        "rule_score",
    )


def _feature_text_sql(c: str, want: int) -> str:
    weak, strong = K.FEATURE_TEXT[c]
    v = f"coalesce({c}, 0)"
    return f"CASE WHEN {v} < 40 THEN '{weak}' WHEN {v} > 70 THEN '{strong}' END"


def summary_sql() -> str:
    def names(cmp: str) -> str:
        return "concat_ws(', ', " + ", ".join(
            f"CASE WHEN coalesce({c}, 0) {cmp} THEN '{c.replace('_', ' ')}' END" for c in K.FEATURES
        ) + ")"

    neg, pos = names("< 40"), names("> 70")
    text = (
        f"concat_ws(' ve ', CASE WHEN {neg} <> '' THEN {neg} || '{K.SUMMARY_RAISES}' END,"
        f" CASE WHEN {pos} <> '' THEN {pos} || '{K.SUMMARY_LOWERS}' END)"
    )
    return (
        f"(CASE WHEN {text} = '' THEN '{K.SUMMARY_BALANCED}' ELSE upper(substr({text}, 1, 1)) || lower(substr({text}, 2)) || '.' END"
        f" || CASE WHEN coalesce({RES}, 0) < 40 THEN '{K.SUMMARY_FRAGILE}' ELSE '' END)"
    )


def _pct(c: str) -> str:
    v = f"coalesce({c}, {d(0)})"
    return f"least({d(1)}, greatest({d(0)}, (CASE WHEN {v} > 100 THEN {v} / {d(100)} ELSE {v} END) / {d(100)}))"


RESPONSE_CTE = f""",
r0 AS (SELECT *, {RES} IS NULL AS missing, {_pct(PAY)} AS pu, {_pct(INC)} AS iu, {_pct(RES)} AS ru,
  {r(f"risk_score / {d(100)}", 4)} AS original_score, {RULE_SUM} AS rs FROM ec),
r1 AS (SELECT *, CASE WHEN missing THEN {d(0)} ELSE least({d(1)}, greatest({d(0)}, rs)) END AS rule_score,
  CASE WHEN missing THEN {d(0)} ELSE {target_sql('pu', 'iu', 'ru')} END AS ml_score FROM r0),
r2 AS (SELECT *, least({d(1)}, greatest({d(0)}, {d(0.7)} * ml_score + {d(0.3)} * rule_score)) AS final_score,
  coalesce(original_score, rule_score) AS original_risk_score FROM r1),
resp AS (SELECT *, {band_sql('final_score')} AS band, {band_sql('final_score', 2)} AS label, {band_sql('final_score', 1)} AS risk_color,
  {band_sql('original_risk_score')} AS original_band,
  CASE WHEN missing THEN {d(0)} ELSE {d(1)} - abs(ml_score - rule_score) END AS model_confidence FROM r2)
"""


def scoring_input(spark, sf):
    """Stored frame of all customers with the score they came with."""
    return materialise(
        P.wide_customers(spark, sf).withColumn("original_score", round_up(F.col("risk_score") / dbl(100.0), 4))
    )


@query(
    "risk_response",
    WIDE + RESPONSE_CTE + f"""SELECT customer_id, ml_score, rule_score, final_score,
  CASE WHEN missing THEN ml_score * {d(0.8)} ELSE {r('(SELECT avg(ml_score) FROM resp WHERE NOT missing)', 9)} END AS base_value,
  CASE WHEN NOT missing THEN final_score END AS predicted_risk_score, original_risk_score,
  CASE WHEN missing THEN 'UNKNOWN' ELSE band END AS risk_band, risk_color, CASE WHEN missing THEN 'Veri Yok' ELSE label END AS risk_label,
  {r('pu', 3)} AS payment_component, {r('iu', 3)} AS income_component, {r('ru', 3)} AS resilience_component,
  original_band, band AS predicted_band, original_band = band AS agreement,
  concat_ws('|', {', '.join(_feature_text_sql(c, 0) for c in K.FEATURES)}) AS explanations, {summary_sql()} AS explanation,
  CASE WHEN missing THEN '' ELSE {RULE_NAMES} END AS rules, model_confidence,
  concat_ws('|', CASE WHEN missing THEN '{K.WARN_MISSING}' END, CASE WHEN missing THEN '{K.WARN_RESILIENCE_NULL}' END,
    CASE WHEN {RES} = 0 AND final_score < {d(0.3)} THEN '{K.WARN_RESILIENCE_ZERO}' END) AS warnings,
  coalesce({PAY}, 0) AS {PAY}, coalesce({INC}, 0) AS {INC}, coalesce({RES}, 0) AS {RES}, '{MODEL_VERSION}' AS model_version, '{MODEL_HASH}' AS model_hash FROM resp""",
)
def risk_response(spark, sf):
    response = scoring.risk_response(scoring_input(spark, sf), model=(MODEL_VERSION, MODEL_HASH))
    return response.select(
        PAY, INC, RES, F.col("model_info.version").alias("model_version"), F.col("model_info.hash").alias("model_hash"),
        "customer_id", "ml_score", "rule_score", "final_score",
        F.when(F.col("predicted_risk_score").isNull(), F.col("base_value")).otherwise(round_up(F.col("base_value"), 9)).alias("base_value"),
        "predicted_risk_score", "original_risk_score", "risk_band", "risk_color", "risk_label",
        F.col(f"components.{PAY}").alias("payment_component"),
        F.col(f"components.{INC}").alias("income_component"),
        F.col(f"components.{RES}").alias("resilience_component"),
        "label_comparison.original_band", "label_comparison.predicted_band", "label_comparison.agreement",
        F.array_join(F.transform("explanations", lambda e: e.getField("text")), "|").alias("explanations"),
        "explanation",
        F.array_join(rules.rule_names(F.col("rule_explanations")), "|").alias("rules"),
        "model_confidence",
        F.array_join("warnings", "|").alias("warnings"),
    )


@query(
    "batch_score",
    WIDE + RESPONSE_CTE + """, ids AS (SELECT DISTINCT CAST(floor(value) AS BIGINT) AS customer_id FROM events
  UNION SELECT c_custkey + (SELECT count(*) FROM nation) FROM customer)
SELECT ids.customer_id, CASE WHEN NOT missing THEN final_score END AS risk_score,
  CASE WHEN missing THEN 'UNKNOWN' ELSE band END AS risk_segment, CASE WHEN missing THEN 'Veri Yok' ELSE label END AS risk_label, risk_color,
  CASE WHEN resp.customer_id IS NULL THEN 'Customer not found' END AS error
FROM ids LEFT JOIN resp ON resp.customer_id = ids.customer_id""",
)
def batch_score(spark, sf):
    # Requested ids: some from events, some shifted past the last customer, so both outcomes occur.
    shift = read(spark, sf, "nation", "n_nationkey").agg(F.count(F.lit(1))).scalar()
    ids = (
        read(spark, sf, "events", "value").select(F.floor("value").cast("bigint").alias("customer_id"))
        .unionByName(read(spark, sf, "customer", "c_custkey").select((F.col("c_custkey") + shift).alias("customer_id")))
        .distinct()
    )
    return scoring.batch_score(ids, scoring.risk_response(scoring_input(spark, sf)))


@query(
    "simple_score",
    WIDE + RESPONSE_CTE + f"""SELECT customer_id, final_score AS risk_score, CASE WHEN missing THEN 'UNKNOWN' ELSE band END AS risk_band,
  CASE WHEN missing THEN 'Veri Yok' ELSE label END AS risk_label, model_confidence AS confidence,
  CASE WHEN coalesce({RES}, 0) = 0 AND final_score < {d(0.3)} THEN '{K.WARN_SIMPLE}' END AS warning FROM resp""",
)
def simple_score(spark, sf):
    return scoring.simple_response(scoring.risk_response(scoring_input(spark, sf)))


@query(
    "score_v2",
    WIDE + f""", s AS (SELECT customer_id, least({d(1)}, greatest({d(0)}, {r(ML, 4)})) AS x FROM ec)
SELECT customer_id, {r('x', 3)} AS v2_score, {band_sql('x')} AS risk_band, {band_sql('x', 1)} AS risk_color, {band_sql('x', 2)} AS risk_label FROM s""",
)
def score_v2(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    return scoring.score_v2(wide.withColumn("raw_score", scoring.linear_model(wide)), "raw_score")


def hash_sql() -> str:
    cols = sorted(K.FEATURES)
    parts = [
        f"'{'{' if i == 0 else ', '}\"{c}\": ' || coalesce(CAST(CAST({c} AS DECIMAL(18,6)) AS VARCHAR), 'null')" for i, c in enumerate(cols)
    ]
    return "sha256(" + " || ".join(parts) + " || '}')"


@query("feature_hash", WIDE + f"SELECT customer_id, {hash_sql()} AS feature_hash FROM ec")
def feature_hash(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", *K.FEATURES).select(
        "customer_id", scoring.feature_hash(*K.FEATURES).alias("feature_hash")
    )


@query(
    "cached_prediction",
    with_(snapshot_cte("old", P.OLD_WINDOW), snapshot_cte("cur", P.NEW_WINDOW), HISTORY) + f""",
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY prediction_time DESC, prediction_id DESC) AS rn FROM ph) WHERE rn = 1),
oh AS (SELECT customer_id, {hash_sql()} AS h FROM old),
ch AS (SELECT customer_id, {hash_sql()} AS h, {ML} AS fresh FROM cur),
j AS (SELECT ch.customer_id, ch.fresh, last.risk_score AS stored,
  coalesce(last.dataset_version = 'v1.0' AND last.model_version = 'v2.0', false) AND oh.h IS NOT DISTINCT FROM ch.h AS hit
  FROM ch LEFT JOIN last ON last.customer_id = ch.customer_id LEFT JOIN oh ON oh.customer_id = ch.customer_id)
SELECT customer_id, CASE WHEN hit THEN stored ELSE fresh END AS score, hit AS from_cache FROM j""",
)
def cached_prediction(spark, sf):
    old = P.feature_snapshot(spark, sf, P.OLD_WINDOW).select(
        "customer_id", scoring.feature_hash(*K.FEATURES).alias("feature_hash")
    )
    now = P.feature_snapshot(spark, sf, P.NEW_WINDOW)
    current = now.select(
        "customer_id", scoring.feature_hash(*K.FEATURES).alias("feature_hash"), scoring.linear_model(now).alias("fresh_score")
    )
    # One stored row per customer meets the old hashes: the history is reduced before the join.
    newest = scoring.latest_prediction(P.prediction_history(spark, sf))
    history = newest.join(old, "customer_id", "left").withColumn("feature_version", F.lit("v2_safe"))
    return scoring.cached_or_fresh(current, history, "v2.0", "v2_safe", "v1.0")


@query(
    "model_confidence",
    WIDE + SCALED_CTE + f"SELECT customer_id, {r(clip_sql(f'{d(1)} - abs(predicted - (SELECT avg(predicted) FROM sc))', 0, 1), 9)} AS model_confidence FROM sc",
)
def model_confidence(spark, sf):
    s = _scaled(spark, sf)
    mean = s.agg(F.avg("predicted_risk_score")).scalar()
    return s.select(
        "customer_id", round_up(clamp01(dbl(1.0) - F.abs(F.col("predicted_risk_score") - mean)), 9).alias("model_confidence")
    )


@query(
    "base_value",
    WIDE + RESPONSE_CTE + f"""SELECT customer_id, CASE WHEN missing THEN ml_score * {d(0.8)}
  ELSE {r('(SELECT avg(ml_score) FROM resp WHERE NOT missing)', 9)} END AS base_value FROM resp""",
)
def base_value(spark, sf):
    response = scoring.risk_response(scoring_input(spark, sf))
    return response.select(
        "customer_id",
        F.when(F.col("predicted_risk_score").isNull(), F.col("base_value")).otherwise(round_up(F.col("base_value"), 9)).alias("base_value"),
    )


def _bias_group(c: str) -> str:
    return f"CASE WHEN {c} < (SELECT median({c}) FROM sc) THEN 'low' ELSE 'high' END"


def bin_sql(x: str, table: str, n: int = 5) -> str:
    def edge(i: int) -> str:
        return f"(SELECT quantile_cont({x}, {i / n}) FROM {table})"

    return "(" + " + ".join(
        f"CASE WHEN {x} > {edge(i)} AND {edge(i)} > {edge(i - 1)} THEN 1 ELSE 0 END" for i in range(1, n)
    ) + ")"


PREDICTION_CTE = WIDE + SCALED_CTE + f""",
lim AS (SELECT customer_id, {PAY}, {INC}, {RES}, predicted, raw_score,
  rank() OVER (ORDER BY predicted) + (count(*) OVER (PARTITION BY predicted) - 1) / {d(2)} AS rk,
  avg(predicted) OVER (PARTITION BY {_bias_group(PAY)}) AS mp, avg(predicted) OVER (PARTITION BY {_bias_group(INC)}) AS mi,
  avg(predicted) OVER (PARTITION BY {_bias_group(RES)}) AS mr,
  avg(predicted) OVER (PARTITION BY round_even({INC} * {d(10)}, 0), round_even({PAY} * {d(10)}, 0)) AS mx,
  {bin_sql('predicted', 'sc')} AS calibration_bin FROM sc),
pt AS (SELECT customer_id, {INC}, {PAY}, {RES}, {r('predicted', 9)} AS predicted_risk_score, {cut_sql('predicted')} AS predicted_band,
  {r('predicted - (SELECT avg(predicted) FROM sc)', 9)} AS bias_delta,
  {r(f'{d(1)} - abs(predicted - (SELECT avg(predicted) FROM sc))', 9)} AS model_confidence,
  {r('predicted - mp', 9)} AS {PAY}_bias, {r('predicted - mi', 9)} AS {INC}_bias, {r('predicted - mr', 9)} AS {RES}_bias,
  {r('predicted - mx', 9)} AS intersectional_bias, calibration_bin, {r('rk / (SELECT count(predicted) FROM sc)', 9)} AS risk_percentile,
  '{MODEL_HASH}' AS model_hash, '{MODEL_VERSION}' AS model_version,
  {r('(SELECT avg(raw_score) FROM raw)', 9)} AS base_value FROM lim)"""


def rounded_predictions(table):
    digits = [
        "predicted_risk_score", "bias_delta", "model_confidence", *[f"{c}_bias" for c in K.FEATURES],
        "intersectional_bias", "risk_percentile", "base_value",
    ]
    return table.withColumns({c: round_up(F.col(c), 9) for c in digits})


@query("prediction_table", PREDICTION_CTE + " SELECT * FROM pt")
def prediction_table(spark, sf):
    features = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    return rounded_predictions(scoring.prediction_table(features, MODEL_HASH, MODEL_VERSION))


@query(
    "save_scored",
    WIDE + RESPONSE_CTE + f"""SELECT customer_id, ml_score AS risk_score, original_band, {band_sql('ml_score')} AS predicted_band, 'v2.0' AS model_version,
  'v2_safe' AS feature_version, 'v1.0' AS dataset_version, {hash_sql()} AS feature_hash, TIMESTAMP '{RUN_TS}' AS prediction_time,
  'api_inference' AS created_by FROM resp WHERE NOT missing""",
)
def save_scored(spark, sf):
    run_ts = F.lit(RUN_TS).cast("timestamp_ntz")
    rows = scoring.scored_rows(scoring_input(spark, sf), run_ts, "v2.0", "v2_safe", "v1.0")
    path = scratch_path(spark, "history")
    append_results(rows, path)
    return spark.read.schema(rows.schema).parquet(path)
