"""Queries on survey analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import round_up
from riskloom.operators import survey as Q
from riskloom.plans.registry import query
from riskloom.plans.sqltext import SURVEY, d, r, with_
from riskloom.sources import proxies as P

_RATING = f"TRY_CAST(trim(rating) AS DOUBLE) * {d(2)}"
_UNDER = f"CASE understood WHEN 'evet' THEN {d(10)} WHEN 'kismen' THEN {d(7)} WHEN 'hayir' THEN {d(3)}"


def _decision(evet: float, hayir: float, emin: float, default: str = "") -> str:
    return f"CASE decision WHEN 'evet' THEN {d(evet)} WHEN 'hayir' THEN {d(hayir)} WHEN 'emin_degilim' THEN {d(emin)}{default} END"


TERMINAL_CTE = with_(SURVEY) + f""", tm AS (SELECT understood, {_UNDER} ELSE {d(5)} END AS understanding_score, {_RATING} AS usability_score,
  trust * {d(2)} AS trust_score, {_decision(10, 5, 7, f' ELSE {d(5)}')} AS decision_score, prediction, model_band,
  CASE WHEN prediction = model_band THEN {d(10)} ELSE {d(5)} END AS prediction_score FROM sv)
"""
_MEANS = {c: f"avg(coalesce({c}, 0))" for c in Q.MEASURES}
_FINAL = " + ".join(f"{d(w)} * {{{c}}}" for c, w in K.SURVEY_WEIGHTS.items())


def _six(df):
    return df.select(*[round_up(F.col(c), 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def terminal(spark, sf):
    return Q.terminal_scores(P.survey_answers(spark, sf))


@query(
    "answer_map",
    with_(SURVEY) + f"""SELECT l_orderkey, l_linenumber, {_UNDER} END AS understanding_score, {_decision(10, 2, 5)} AS decision_form,
  {_decision(10, 5, 7)} AS decision_combined, {_decision(10, 5, 7, f' ELSE {d(5)}')} AS decision_terminal FROM sv""",
)
def answer_map(spark, sf):
    form = P.form_answers(spark, sf)
    back = {"Evet": "evet", "Hayır": "hayir", "Emin Değilim": "emin_degilim"}
    plain = F.col("decision")
    for wide, narrow in back.items():
        plain = F.when(F.col("decision") == wide, narrow).otherwise(plain)
    return form.select(
        "l_orderkey",
        "l_linenumber",
        Q.answer_points(F.col("understood"), K.ANSWERS_UNDERSTOOD_FORM).alias("understanding_score"),
        Q.answer_points(F.col("decision"), K.ANSWERS_DECISION_FORM).alias("decision_form"),
        Q.answer_points(F.col("decision"), K.ANSWERS_DECISION_COMBINED).alias("decision_combined"),
        Q.answer_points(plain, K.ANSWERS_DECISION_TERMINAL, K.ANSWER_TERMINAL_DEFAULT).alias("decision_terminal"),
    )


@query("rating_parse", with_(SURVEY) + f"SELECT l_orderkey, l_linenumber, {_RATING} AS usability_score FROM sv")
def rating_parse(spark, sf):
    return P.survey_answers(spark, sf).select(
        "l_orderkey", "l_linenumber", Q.rating_points(F.col("rating")).alias("usability_score")
    )


_FORM = {
    "understanding": f"avg({_UNDER} END)",
    "explanation": f"avg({_RATING})",
    "trust": f"avg(CASE WHEN upper(prediction) = 'MEDIUM' THEN {d(10)} ELSE {d(0)} END) FILTER (WHERE {_RATING} IS NOT NULL)",
    "decision": f"avg({_decision(10, 2, 5)}) FILTER (WHERE {_RATING} IS NOT NULL)",
}


@query(
    "form_metrics",
    with_(SURVEY) + "SELECT " + ", ".join(f"{r(e, 6)} AS {n}" for n, e in _FORM.items()) + f", {r('(' + ' + '.join(_FORM.values()) + ') / 4', 6)} AS overall FROM sv",
)
def form_metrics(spark, sf):
    return _six(Q.form_metrics(P.form_answers(spark, sf)))


_NUM = ["understanding_score", "usability_score", "trust_score", "decision_score", "prediction_score"]
_FILL = {c: f"avg(coalesce({c}, (SELECT median({c}) FROM al)))" for c in Q.MEASURES}


@query(
    "combined_metrics",
    TERMINAL_CTE + f""", fo AS (SELECT {_UNDER} END AS understanding_score, {_RATING} AS usability_score, trust * {d(2)} AS trust_score,
  {_decision(10, 5, 7)} AS decision_score, CAST(NULL AS DOUBLE) AS prediction_score FROM sv),
al AS (SELECT {', '.join(_NUM)} FROM fo UNION ALL SELECT {', '.join(_NUM)} FROM tm)
SELECT {', '.join(f'{r(e, 6)} AS {c}' for c, e in _FILL.items())}, {r(_FINAL.format(**_FILL), 6)} AS final_score FROM al""",
)
def combined_metrics(spark, sf):
    return _six(Q.combined_metrics(Q.form_scores(P.form_answers(spark, sf)), terminal(spark, sf)))


@query(
    "terminal_metrics",
    TERMINAL_CTE + " UNION ALL ".join(
        [f"SELECT '{K.SURVEY_METRIC_NAMES[c]}' AS \"Metric\", {r(e, 6)} AS \"Value\" FROM tm" for c, e in _MEANS.items()]
        + [f"SELECT '{K.SURVEY_METRIC_NAMES['final']}', {r(_FINAL.format(**_MEANS), 6)} FROM tm"]
    ),
)
def terminal_metrics(spark, sf):
    out = Q.terminal_metrics(terminal(spark, sf))
    return out.withColumn("Value", round_up(F.col("Value"), 6))


@query(
    "terminal_summary",
    TERMINAL_CTE + f"SELECT {', '.join(f'{r(_MEANS[c], 6)} AS {c}' for c in _NUM[:4])}, count(*) AS users FROM tm",
)
def terminal_summary(spark, sf):
    return _six(Q.terminal_summary(terminal(spark, sf)))


@query(
    "understood_share",
    with_(SURVEY) + f"SELECT understood, {r(f'count(*) / CAST((SELECT count(understood) FROM sv) AS DOUBLE) * {d(100)}', 2)} AS percent FROM sv WHERE understood IS NOT NULL GROUP BY 1",
)
def understood_share(spark, sf):
    return Q.understood_share(P.survey_answers(spark, sf))


@query(
    "prediction_agreement",
    TERMINAL_CTE + f"""SELECT {r('avg(prediction_score)', 6)} AS agreement, {r(f"avg(CASE WHEN prediction = 'MEDIUM' THEN {d(1)} ELSE {d(0)} END) * 100", 6)} AS medium_percent FROM tm""",
)
def prediction_agreement(spark, sf):
    return _six(Q.prediction_agreement(P.survey_answers(spark, sf)))


@query(
    "adaptive_metrics",
    TERMINAL_CTE + f"SELECT {r('avg(understanding_score)', 6)} AS understanding, {r('avg(prediction_score)', 6)} AS trust, {r('avg(usability_score)', 6)} AS usability FROM tm",
)
def adaptive_metrics(spark, sf):
    return _six(Q.adaptive_metrics(terminal(spark, sf)))
