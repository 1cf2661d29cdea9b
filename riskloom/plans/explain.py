"""Queries on explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.bands import factor_level
from riskloom.functions.numeric import dbl, round_up, unit_if_above_one
from riskloom.operators import explain as X
from riskloom.operators import rules, scoring
from riskloom.plans.bands import level_sql, unit_sql
from riskloom.plans.registry import query
from riskloom.plans.scoring import (
    RUN_TS,
    MODEL_HASH,
    MODEL_VERSION,
    PREDICTION_CTE, RESPONSE_CTE, RULE_NAMES, RULE_SUM, rounded_predictions, scoring_input, summary_sql, target_sql,
)
from riskloom.plans.sqltext import HISTORY, WIDE, d, r, snapshot_cte, u, with_, z
from riskloom.sources import proxies as P
from riskloom.sources.store import materialise, scratch_path
from riskloom.sources.tables import read

PAY, INC, RES = K.FEATURES
_W = K.BEHAVIOUR_WEIGHTS


def contribution_sql(c: str) -> str:
    return r(f"coalesce({c}, {d(0)}) / {d(100)} * {d(_W[c])}", 4)


CONTRIB_CTE = f", cb AS (SELECT *, {contribution_sql(PAY)} AS cp, {contribution_sql(INC)} AS ci, {contribution_sql(RES)} AS cr FROM ec)"
FIRST_SQL = f"CASE WHEN cp >= ci AND cp >= cr THEN '{PAY}' WHEN ci >= cr THEN '{INC}' ELSE '{RES}' END"
TEXT_SQL = f"CASE {FIRST_SQL} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.FACTOR_TEXT.items()) + " END"
# Names from strongest to weakest, ties in feature order.
RANKED_SQL = f"""(SELECT string_agg(n, '|' ORDER BY v DESC, o) FROM (VALUES ('{PAY}', cp, 0), ('{INC}', ci, 1), ('{RES}', cr, 2)) AS t(n, v, o))"""


def _wide(spark, sf, *extra):
    return P.wide_customers(spark, sf, "customer_id", *K.FEATURES, *extra)


@query(
    "feature_contributions",
    WIDE + CONTRIB_CTE + f"SELECT customer_id, cp AS {PAY}, ci AS {INC}, cr AS {RES} FROM cb",
)
def feature_contributions(spark, sf):
    m = X.contributions()
    return _wide(spark, sf).select("customer_id", m.alias("m")).select(
        "customer_id", *[F.col("m")[c].alias(c) for c in K.FEATURES]
    )


@query("rank_contributions", WIDE + CONTRIB_CTE + f"SELECT customer_id, {RANKED_SQL} AS ranked FROM cb")
def rank_contributions(spark, sf):
    base = _wide(spark, sf).select("customer_id", X.contributions().alias("m"))
    ranked = X.ranked_contributions(F.col("m"))
    return base.select("customer_id", F.array_join(F.transform(ranked, lambda x: x.getField("feature")), "|").alias("ranked"))


@query("explanation_text", WIDE + CONTRIB_CTE + f"SELECT customer_id, {TEXT_SQL} AS explanation FROM cb")
def explanation_text(spark, sf):
    base = _wide(spark, sf).select("customer_id", X.contributions().alias("m"))
    return base.select("customer_id", X.explanation_text(X.ranked_contributions(F.col("m"))).alias("explanation"))


def condition_sql(c: str) -> str:
    return f"CASE WHEN {c} <= 60 THEN '{c} <= 60.00' WHEN {c} <= 80 THEN '60.00 < {c} <= 80.00' ELSE '{c} > 80.00' END"


def condition(c: str):
    return (
        F.when(F.col(c) <= 60.0, f"{c} <= 60.00").when(F.col(c) <= 80.0, f"60.00 < {c} <= 80.00").otherwise(f"{c} > 80.00")
    )


def _known_sql(c: str) -> str:
    return f"CASE WHEN {c} > 60 AND {c} <= 80 THEN 0 ELSE 1 END"


@query(
    "explanation_confidence",
    WIDE + f"SELECT customer_id, {r(f'({_known_sql(PAY)} + {_known_sql(INC)} + {_known_sql(RES)}) / {d(3)}', 2)} AS confidence FROM ec",
)
def explanation_confidence(spark, sf):
    base = _wide(spark, sf).select(
        "customer_id",
        X.contributions().alias("m"),
        F.array(*[X.condition_feature(condition(c)) for c in K.FEATURES]).alias("named"),
    )
    ours = F.transform(X.ranked_contributions(F.col("m")), lambda x: x.getField("feature"))
    return base.select("customer_id", X.explanation_confidence(ours, F.col("named")).alias("confidence"))


def _texts_sql() -> str:
    return "concat_ws('|', " + ", ".join(
        f"CASE WHEN coalesce({c}, 0) < 40 THEN '{K.FEATURE_TEXT[c][0]}' WHEN coalesce({c}, 0) > 70 THEN '{K.FEATURE_TEXT[c][1]}' END"
        for c in K.FEATURES
    ) + ")"


@query(
    "feature_explanations",
    WIDE + f"""SELECT customer_id, {_texts_sql()} AS texts, {' + '.join(
        f"(CASE WHEN coalesce({c}, 0) < 40 THEN {d(-1)} WHEN coalesce({c}, 0) > 70 THEN {d(1)} ELSE {d(0)} END)" for c in K.FEATURES
    )} AS total_impact FROM ec""",
)
def feature_explanations(spark, sf):
    base = _wide(spark, sf).select("customer_id", X.feature_explanations().alias("e"))
    return base.select(
        "customer_id",
        F.array_join(F.transform("e", lambda e: e.getField("text")), "|").alias("texts"),
        F.aggregate("e", dbl(0.0), lambda acc, e: acc + e.getField("impact")).alias("total_impact"),
    )


@query("explanation_summary", WIDE + f"SELECT customer_id, {summary_sql()} AS explanation FROM ec")
def explanation_summary(spark, sf):
    explained = _wide(spark, sf).withColumn("explanations", X.feature_explanations())
    return explained.select("customer_id", X.explanation_summary(F.col("explanations")).alias("explanation"))


@query(
    "simple_explanation",
    WIDE + f"""SELECT customer_id, coalesce(nullif(concat_ws('|', CASE WHEN {INC} > 70 THEN '{INC}:-0.07' END,
  CASE WHEN {PAY} > 70 THEN '{PAY}:-0.05' END, CASE WHEN {RES} < 20 THEN '{RES}:0.06' END), ''), 'general_behavior:0.01') AS explanation FROM ec""",
)
def simple_explanation(spark, sf):
    base = _wide(spark, sf).select("customer_id", X.simple_explanation().alias("e"))
    text = F.transform("e", lambda e: F.concat(e.getField("feature"), F.lit(":"), e.getField("impact").cast("string")))
    return base.select("customer_id", F.array_join(text, "|").alias("explanation"))


def _one(c: str) -> str:
    return f"CAST(CAST({r(c, 1)} AS DECIMAL(10,1)) AS VARCHAR)"


@query(
    "customer_sentence",
    WIDE + f""", t AS (SELECT customer_id, concat_ws(', ',
  CASE WHEN {PAY} < 60 THEN '{K.SENTENCE_PAYMENT}' || {_one(PAY)} || ')' END,
  CASE WHEN {RES} < 20 THEN '{K.SENTENCE_RESILIENCE}' || {_one(RES)} || ')' END,
  CASE WHEN {INC} > 80 THEN '{K.SENTENCE_INCOME}' || {_one(INC)} || ')' END) AS p FROM ec)
SELECT customer_id, CASE WHEN p = '' THEN '{K.SENTENCE_DEFAULT}' ELSE '{K.SENTENCE_PREFIX}' || p || '{K.SENTENCE_SUFFIX}' END AS sentence FROM t""",
)
def customer_sentence(spark, sf):
    return _wide(spark, sf).select("customer_id", X.customer_sentence().alias("sentence"))


def _signed_sql(c: str) -> str:
    return f"{r(f'coalesce({c}, {d(0)}) / {d(100)} - {d(0.5)}', 3)}"


@query(
    "attribution_parse",
    WIDE + " UNION ALL ".join(
        f"""SELECT customer_id, '{K.DISPLAY_NAME[c]}' AS factor,
  CASE WHEN {_signed_sql(c)} < 0 THEN '{K.DIRECTION_LOWERS}' ELSE '{K.DIRECTION_RAISES}' END AS direction, {_signed_sql(c)} AS impact FROM ec"""
        for c in K.FEATURES
    ),
)
def attribution_parse(spark, sf):
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"), round_up(F.coalesce(F.col(c), dbl(0.0)) / dbl(100.0) - dbl(0.5), 3).alias("impact")
            )
            for c in K.FEATURES
        ],
        F.struct(F.lit("general_behavior").alias("feature"), dbl(0.01).alias("impact")),
    )
    return X.attribution_parse(_wide(spark, sf).select("customer_id", F.to_json(pairs).alias("attribution")), "attribution")


@query(
    "attribution_clean",
    WIDE + " UNION ALL ".join(
        f"""SELECT customer_id, {condition_sql(c)} AS condition,
  CASE WHEN {_known_sql(c)} = 1 THEN '{c}' ELSE 'unknown_feature' END AS by_split, '{c}' AS by_content FROM ec"""
        for c in K.FEATURES
    ),
)
def attribution_clean(spark, sf):
    texts = F.explode(F.array(*[condition(c) for c in K.FEATURES])).alias("condition")
    return _wide(spark, sf).select("customer_id", texts).select(
        "customer_id",
        "condition",
        X.condition_feature(F.col("condition")).alias("by_split"),
        X.condition_feature_contains(F.col("condition")).alias("by_content"),
    )


@query(
    "explain_factors",
    WIDE + RESPONSE_CTE + f"""SELECT customer_id, CASE WHEN missing THEN 'UNKNOWN' ELSE band END AS prediction,
  CASE WHEN NOT missing THEN final_score END AS prediction_score,
  concat_ws('|', CASE WHEN spending_ratio > {d(0.8)} THEN 'high_spending_ratio' END, CASE WHEN bill_payment_delay_avg > 3 THEN 'payment_delay' END) AS top_positive_factors,
  concat_ws('|', CASE WHEN savings_rate > {d(0.2)} THEN 'high_savings_rate' END, CASE WHEN employment_duration_months > 60 THEN 'long_employment_duration' END) AS top_negative_factors,
  '{K.EXPLAIN_SUMMARY}' AS explanation_summary FROM resp""",
)
def explain_factors(spark, sf):
    source = scoring_input(spark, sf)
    scored = scoring.risk_response(source).select("customer_id", "risk_band", "predicted_risk_score")
    joined = scored.join(source.select("customer_id", *K.RAW_ATTRIBUTES), "customer_id")
    out = joined.select("customer_id", *X.explain_factors(F.col("risk_band"), F.col("predicted_risk_score")))
    return out.withColumns({c: F.array_join(c, "|") for c in ("top_positive_factors", "top_negative_factors")})


@query(
    "explain_customer_json",
    with_(snapshot_cte("cur", P.NEW_WINDOW)) + """SELECT c_custkey AS customer_id,
  CASE WHEN cur.customer_id IS NULL THEN '{"error":"customer_not_found"}'
  ELSE '{"customer_id":' || cur.customer_id || ',"risk_points":' || coalesce(CAST(CAST(round(risk_score * 10000) AS BIGINT) AS VARCHAR), 'null') || ',"risk_band":' || coalesce('"' || risk_band || '"', 'null') || '}' END AS explanation
FROM customer LEFT JOIN cur ON cur.customer_id = c_custkey""",
)
def explain_customer_json(spark, sf):
    ids = read(spark, sf, "customer", "c_custkey").withColumnRenamed("c_custkey", "customer_id")
    # Number texts differ between engines, so the compared form carries whole ten-thousandths.
    features = P.feature_snapshot(spark, sf, P.NEW_WINDOW).withColumn(
        "risk_score", F.rint(F.col("risk_score") * 10000.0).cast("bigint")
    )
    out = X.explain_customer_json(ids, features)
    return out.withColumn("explanation", F.replace(F.col("explanation"), F.lit('"risk_score"'), F.lit('"risk_points"')))


SAMPLES = 5000


def _det(a, b, c):
    return (
        f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]})"
        f" + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))"
    )


def _solved_sql() -> list[str]:
    """The three weights, from columns a00 .. a22 and b0 .. b2."""
    cols, b = [["a00", "a01", "a02"], ["a01", "a11", "a12"], ["a02", "a12", "a22"]], ["b0", "b1", "b2"]
    return [_det(*[b if k == i else v for k, v in enumerate(cols)]) + f" / {_det(*cols)}" for i in range(3)]


_COVARIANCES = ", ".join(f"s{i}{j} - s{i} * s{j} / sw{f' + {d(1)}' if i == j else ''} AS a{i}{j}" for i in range(3) for j in range(i, 3))
_RIGHT_SIDES = ", ".join(f"t{i} - s{i} * sy / sw AS b{i}" for i in range(3))


def _surrogate_ctes(samples: int) -> tuple[str, list[str]]:
    """CTE text from the shared draws to the solved sums, and per feature the weight."""
    feats = list(K.FEATURES)
    moved = [f"(coalesce({c}, 0) + n{i} * sd{i}) / {d(100)}" for i, c in enumerate(feats)]
    moments = ["sum(w) AS sw"] + [f"sum(w * n{i}) AS s{i}" for i in range(3)]
    moments += [f"sum(w * n{i} * n{j}) AS s{i}{j}" for i in range(3) for j in range(i, 3)]
    sums = ["sum(w * y) AS sy"] + [f"sum(w * n{i} * y) AS t{i}" for i in range(3)]
    width = 0.75 * 3.0**0.5
    return f""",
st AS (SELECT {', '.join(f'stddev_pop({c}) AS sd{i}, avg({c}) AS m{i}' for i, c in enumerate(feats))} FROM ec),
nz AS (SELECT {', '.join(f'{z("c", i)} AS n{i}' for i in range(3))} FROM (SELECT unnest(range(1, {samples + 1})) AS c)),
dr AS MATERIALIZED (SELECT n0, n1, n2, sqrt(exp(-(n0 * n0 + n1 * n1 + n2 * n2) / {d(width * width)})) AS w FROM nz),
mo AS (SELECT {', '.join(moments)} FROM dr),
yy AS (SELECT customer_id, {', '.join(f'coalesce({c}, 0) AS at{i}' for i, c in enumerate(feats))}, n0, n1, n2, w,
  {target_sql(*moved)} AS y FROM ec, dr, st),
su AS (SELECT customer_id, at0, at1, at2, {', '.join(sums)} FROM yy GROUP BY ALL),
eq AS (SELECT customer_id, at0, at1, at2, m0, m1, m2, sd0, sd1, sd2, {_COVARIANCES}, {_RIGHT_SIDES} FROM su, mo, st)
""", _solved_sql()


def _impact_sql(weight: str, i: int) -> str:
    return f"({weight}) * (at{i} - m{i}) / sd{i}"


def _surrogate_sql() -> str:
    ctes, weights = _surrogate_ctes(SAMPLES)
    out = ", ".join(
        f"{r(w, 6)} AS {c}_weight, {r(_impact_sql(w, i), 6)} AS {c}_impact" for i, (c, w) in enumerate(zip(K.FEATURES, weights))
    )
    return WIDE + ctes + f"SELECT customer_id, {out} FROM eq"


@query("local_surrogate", _surrogate_sql())
def local_surrogate(spark, sf):
    features = materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES))
    out = X.local_surrogate(features, scoring.linear_model, samples=SAMPLES)
    return out.select("customer_id", *[round_up(F.col(c), 6).alias(c) for c in out.columns if c != "customer_id"])


def _binned_sql() -> str:
    feats = list(K.FEATURES)
    at = [f"coalesce({c}, 0)" for c in feats]
    edges = ", ".join(f"quantile_cont({x}, {k / 4}) AS e{i}{k}" for i, x in enumerate(at) for k in range(5))
    case = lambda q, values: f"CASE {q} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"
    inside = [
        f"{case(f'b{i}', [f'e{i}{k}' for k in range(4)])} + ({case(f'b{i}', [f'e{i}{k + 1}' for k in range(4)])} - {case(f'b{i}', [f'e{i}{k}' for k in range(4)])}) * {u('c', 30 + i)}"
        for i in range(3)
    ]
    y = target_sql(*[f"(v{i}) / {d(100)}" for i in range(3)])
    width = 0.75 * 3.0**0.5
    sums = ["sum(w) AS sw", "sum(w * y) AS sy"] + [f"sum(w * h{i}) AS s{i}, sum(w * h{i} * y) AS t{i}" for i in range(3)]
    sums += [f"sum(w * h{i} * h{j}) AS s{i}{j}" for i in range(3) for j in range(i, 3)]
    quarter = [f"CAST({x} > e{i}1 AS INT) + CAST({x} > e{i}2 AS INT) + CAST({x} > e{i}3 AS INT)" for i, x in enumerate(at)]
    text = lambda i, k: f"CAST(CAST({r(f'e{i}{k}', 2)} AS DECIMAL(12,2)) AS VARCHAR)"
    named = [
        case(f"r{i}", [f"'{c} <= ' || {text(i, 1)}", f"{text(i, 1)} || ' < {c} <= ' || {text(i, 2)}", f"{text(i, 2)} || ' < {c} <= ' || {text(i, 3)}", f"'{c} > ' || {text(i, 3)}"])
        for i, c in enumerate(feats)
    ]
    rows = " UNION ALL ".join(
        f"SELECT customer_id, {named[i]} AS condition, {r(w, 6)} AS weight, CASE WHEN r{i} IN (0, 3) THEN '{c}' ELSE 'unknown_feature' END AS by_split, '{c}' AS by_content FROM so, qe"
        for i, (c, w) in enumerate(zip(feats, _solved_sql()))
    )
    return WIDE + f""",
qe AS MATERIALIZED (SELECT {edges} FROM ec),
dr AS (SELECT c, {', '.join(f'CAST(floor({d(4)} * {u("c", 20 + i)}) AS INT) AS b{i}' for i in range(3))} FROM (SELECT unnest(range(1, {SAMPLES + 1})) AS c)),
mv AS (SELECT b0, b1, b2, {', '.join(f'{x} AS v{i}' for i, x in enumerate(inside))} FROM dr, qe),
sc AS MATERIALIZED (SELECT b0, b1, b2, {y} AS y FROM mv),
cb AS (SELECT a.x AS r0, b.x AS r1, c.x AS r2 FROM (SELECT unnest(range(4)) AS x) a, (SELECT unnest(range(4)) AS x) b, (SELECT unnest(range(4)) AS x) c),
hw AS (SELECT r0, r1, r2, y, {', '.join(f'CAST(b{i} = r{i} AS DOUBLE) AS h{i}' for i in range(3))} FROM sc, cb),
ww AS (SELECT *, sqrt(exp((h0 + h1 + h2 - {d(3)}) / {d(width * width)})) AS w FROM hw),
su AS (SELECT r0, r1, r2, {', '.join(sums)} FROM ww GROUP BY ALL),
eq AS (SELECT r0, r1, r2, {_COVARIANCES}, {_RIGHT_SIDES} FROM su),
ro AS (SELECT customer_id, {', '.join(f'{q} AS r{i}' for i, q in enumerate(quarter))} FROM ec, qe),
so AS (SELECT * FROM ro JOIN eq USING (r0, r1, r2))
{rows}"""


@query("attribution_conditions", _binned_sql())
def attribution_conditions(spark, sf):
    """Quartile-bin attributions with their condition texts, and the features cleaned out of these."""
    features = materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES))
    found = X.binned_surrogate(features, scoring.linear_model, samples=SAMPLES)
    return found.select(
        "customer_id", "condition", round_up(F.col("weight"), 6).alias("weight"),
        X.condition_feature(F.col("condition")).alias("by_split"), X.condition_feature_contains(F.col("condition")).alias("by_content"),
    )


def _explained_sql() -> str:
    ctes, weights = _surrogate_ctes(SAMPLES)
    impacts = ", ".join(f"{_impact_sql(w, i)} AS x{i}" for i, w in enumerate(weights))
    number = f"CAST(CAST({r('v', 4)} AS DECIMAL(10,4)) AS VARCHAR)"
    values = ", ".join(f"('{c}', x{i})" for i, c in enumerate(K.FEATURES))
    return PREDICTION_CTE + ctes + f""", im AS (SELECT customer_id, {impacts} FROM eq)
SELECT pt.*, (SELECT '[' || string_agg('{{"feature":"' || n || '","impact":' || {number} || '}}', ',' ORDER BY abs(v) DESC, n) || ']'
  FROM (VALUES {values}) AS t(n, v)) AS lime_explanation FROM pt JOIN im ON im.customer_id = pt.customer_id"""


@query("prediction_table_explained", _explained_sql())
def prediction_table_explained(spark, sf):
    features = materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES))
    surrogate = X.attribution_json(X.local_surrogate(features, scoring.linear_model, samples=SAMPLES))
    return rounded_predictions(scoring.prediction_table(features, MODEL_HASH, MODEL_VERSION, attributions=surrogate))


def _narrative_sql() -> str:
    rr, c, t = unit_sql(RES), "model_confidence", [x.replace("'", "''") for x in K.NARRATIVE]
    return (
        f"CASE WHEN {rr} < {d(0.3)} AND upper(CASE WHEN missing THEN 'UNKNOWN' ELSE band END) = 'LOW' THEN '{t[0]}' WHEN {c} < {d(0.6)} THEN '{t[1]}'"
        f" WHEN {rr} < {d(0.2)} THEN '{t[2]}' WHEN {rr} < {d(0.4)} THEN '{t[3]}' WHEN {c} < {d(0.85)} THEN '{t[4]}' ELSE '{t[5]}' END"
    )


@query("narrative_case", WIDE + RESPONSE_CTE + f"SELECT customer_id, {_narrative_sql()} AS narrative FROM resp")
def narrative_case(spark, sf):
    source = scoring_input(spark, sf)
    response = scoring.risk_response(source).select("customer_id", "risk_band", "model_confidence", RES, "predicted_risk_score")
    resilience = F.when(F.col("predicted_risk_score").isNotNull(), F.col(RES))
    return response.select(
        "customer_id", X.narrative(F.upper("risk_band"), F.col("model_confidence"), resilience).alias("narrative")
    )


@query(
    "explanation_record",
    WIDE + CONTRIB_CTE + f"""SELECT customer_id, cp AS {PAY}, ci AS {INC}, cr AS {RES}, {RANKED_SQL} AS top_risk_factors, {TEXT_SQL} AS natural_language,
  {RULE_NAMES} AS rules_triggered, {RULE_SUM} AS rule_based_score,
  {r(f'({_known_sql(PAY)} + {_known_sql(INC)} + {_known_sql(RES)}) / {d(3)}', 2)} AS confidence_score, '{K.EXPLANATION_METHOD}' AS explanation_method FROM cb""",
)
def explanation_record(spark, sf):
    base = P.wide_customers(spark, sf).select(
        "customer_id",
        X.contributions().alias("feature_contributions"),
        rules.rule_hits().alias("rules"),
        F.array(*[X.condition_feature(condition(c)) for c in K.FEATURES]).alias("named"),
    )
    base = base.withColumn("ranked", X.ranked_contributions(F.col("feature_contributions")))
    ranked = F.col("ranked")
    names = F.transform(ranked, lambda x: x.getField("feature"))
    return base.select(
        "customer_id",
        *[F.col("feature_contributions")[c].alias(c) for c in K.FEATURES],
        F.array_join(names, "|").alias("top_risk_factors"),
        X.explanation_text(ranked).alias("natural_language"),
        F.array_join(rules.rule_names(F.col("rules")), "|").alias("rules_triggered"),
        rules.scorecard(F.col("rules")).alias("rule_based_score"),
        X.explanation_confidence(names, F.col("named")).alias("confidence_score"),
        F.lit(K.EXPLANATION_METHOD).alias("explanation_method"),
    )


@query(
    "explanation_log",
    WIDE + CONTRIB_CTE + f""", {HISTORY.strip()}, lp AS (SELECT customer_id, max(prediction_id) AS prediction_id FROM ph GROUP BY 1)
SELECT prediction_id, lp.customer_id, {RANKED_SQL} AS top_risk_factors, {RULE_NAMES} AS rules_triggered, TIMESTAMP '{RUN_TS}' AS created_at
FROM lp JOIN cb ON cb.customer_id = lp.customer_id""",
)
def explanation_log(spark, sf):
    """Explanations of every customer's last stored prediction, appended to the log in two runs and read back, the newest of each prediction."""
    last = P.prediction_history(spark, sf).groupBy("customer_id").agg(F.max("prediction_id").alias("prediction_id"))
    records = materialise(last.join(explanation_record(spark, sf), "customer_id"))
    path = scratch_path(spark, "explanation_log")
    for part, stamp in (("true", "2024-01-01 00:00:00"), ("customer_id % 2 = 0", RUN_TS), ("customer_id % 2 <> 0", RUN_TS)):
        X.log_explanations(records.where(part), F.lit(stamp).cast("timestamp_ntz"), path)
    found = X.newest_explanations(spark, path).select("prediction_id", "customer_id", F.col("feature_importance").alias("f"), F.col("rules_triggered").alias("r"), "created_at")
    listed = lambda c: F.array_join(F.from_json(c, "array<string>"), "|")
    return found.select("prediction_id", "customer_id", listed(F.get_json_object("f", "$.order")).alias("top_risk_factors"), listed(F.col("r")).alias("rules_triggered"), "created_at")


@query(
    "attribution_format",
    WIDE + f"""SELECT customer_id, '{PAY}' AS feature, {r(f'coalesce({PAY}, {d(0)})', 4)} AS impact FROM ec
UNION ALL SELECT customer_id, '{RES}', {d(0)} FROM ec UNION ALL SELECT customer_id, risk_band, {d(0)} FROM ec""",
)
def attribution_format(spark, sf):
    def pair(feature, impact):
        return F.struct(feature.alias("feature"), impact.cast("string").alias("impact"))

    pairs = F.array(
        pair(F.lit(PAY), F.col(PAY)), pair(F.lit(RES), F.lit("not a number")), pair(F.col("risk_band"), F.lit(None))
    )
    rows = _wide(spark, sf, "risk_band").select("customer_id", F.explode(X.attribution_format(pairs)).alias("x"))
    return rows.select("customer_id", "x.feature", "x.impact")


@query(
    "worst_factor",
    WIDE + f"""SELECT customer_id, CASE WHEN least({unit_sql(RES)}, {unit_sql(PAY)}, {unit_sql(INC)}) = {unit_sql(RES)} THEN 'Finansal Dayanıklılık'
  WHEN least({unit_sql(RES)}, {unit_sql(PAY)}, {unit_sql(INC)}) = {unit_sql(PAY)} THEN 'Ödeme Disiplini'
  WHEN {INC} IS NOT NULL THEN 'Gelir İstikrarı' END AS worst_factor, least({unit_sql(RES)}, {unit_sql(PAY)}, {unit_sql(INC)}) AS value FROM ec""",
)
def worst_factor(spark, sf):
    return _wide(spark, sf).select("customer_id", X.worst_factor().alias("w")).select(
        "customer_id", F.col("w.name").alias("worst_factor"), F.col("w.value").alias("value")
    )


def _prio(c: str) -> str:
    return f"CASE {level_sql(c)} WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"


@query(
    "factor_order",
    WIDE + f""", p AS (SELECT customer_id, {_prio(PAY)} AS a, {_prio(INC)} AS b, {_prio(RES)} AS c FROM ec)
SELECT customer_id, (SELECT string_agg(n, '|' ORDER BY v DESC, o) FROM (VALUES ('payment_discipline', a, 0), ('income_stability', b, 1),
  ('financial_resilience', c, 2)) AS t(n, v, o)) AS factors FROM p""",
)
def factor_order(spark, sf):
    levels = {
        n: factor_level(unit_if_above_one(F.col(c)), n.startswith("financial"))
        for n, c in zip(("payment_discipline", "income_stability", "financial_resilience"), K.FEATURES)
    }
    return _wide(spark, sf).select("customer_id", F.array_join(X.factor_order(levels), "|").alias("factors"))
