"""Queries on features and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import numeric as N
from riskloom.operators import features as feat
from riskloom.plans.registry import query
from riskloom.plans.sqltext import SURVEY, WIDE, clip, d, r, u, with_, z
from riskloom.sources import proxies as P
from riskloom.sources.store import materialise
from riskloom.sources.tables import read

P_, I_, R_ = K.FEATURES


@query("payment_discipline", WIDE + "SELECT customer_id, payment_discipline_score FROM ec")
def payment_discipline(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", P_)


@query("income_stability", WIDE + "SELECT customer_id, income_stability_index FROM ec")
def income_stability(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", I_)


@query("financial_resilience", WIDE + "SELECT customer_id, financial_resilience_score FROM ec")
def financial_resilience(spark, sf):
    return P.wide_customers(spark, sf, "customer_id", R_)


_PER_MISSED = f"CASE WHEN missed_payments_6m = 0 THEN CAST('infinity' AS DOUBLE) ELSE monthly_income / missed_payments_6m END"


@query(
    "inf_to_null",
    WIDE + f"""SELECT customer_id, CASE WHEN isinf(x) OR isnan(x) THEN NULL ELSE x END AS income_per_missed
FROM (SELECT customer_id, {_PER_MISSED} AS x FROM ec)""",
)
def inf_to_null(spark, sf):
    base = P.wide_customers(spark, sf, "customer_id", "monthly_income", "missed_payments_6m")
    ratio = F.when(F.col("missed_payments_6m") == 0, float("inf")).otherwise(
        F.col("monthly_income") / F.col("missed_payments_6m").cast("double")
    )
    return base.select("customer_id", N.inf_to_null(ratio).alias("income_per_missed"))


@query(
    "median_impute",
    WIDE + "SELECT customer_id, " + ", ".join(
        f"{r(f'coalesce({c}, (SELECT median({c}) FROM ec))', 6)} AS {c}" for c in K.FEATURES
    ) + " FROM ec",
)
def median_impute(spark, sf):
    base = materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES))
    filled = feat.median_impute(base, K.FEATURES)
    return filled.select("customer_id", *[N.round_up(F.col(c), 6).alias(c) for c in K.FEATURES])


@query(
    "zero_impute_other",
    WIDE + "SELECT customer_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in K.RAW_ATTRIBUTES) + " FROM ec",
)
def zero_impute_other(spark, sf):
    return feat.zero_impute(P.customer_attributes(spark, sf), K.RAW_ATTRIBUTES)


@query(
    "bounds_clip",
    f"SELECT event_id, {clip('value', 0, 100)} AS event_value FROM events",
)
def bounds_clip(spark, sf):
    return feat.bounds_clip(P.raw_events(spark, sf).select("event_id", "event_value"), ["event_value"])


@query(
    "risk_score_normalise_global",
    WIDE + f"""SELECT customer_id, CASE WHEN (SELECT max({clip('risk_score', 0, 100)}) FROM ec) > 1
  THEN {clip('risk_score', 0, 100)} / {d(100)} ELSE {clip('risk_score', 0, 100)} END AS risk_score FROM ec""",
)
def risk_score_normalise_global(spark, sf):
    return feat.normalise_score_global(materialise(P.wide_customers(spark, sf, "customer_id", "risk_score")), "risk_score")


@query("require_columns", WIDE + f"SELECT customer_id, {', '.join(K.RAW_ATTRIBUTES)} FROM ec")
def require_columns(spark, sf):
    return feat.require_columns(P.customer_attributes(spark, sf), ["customer_id", *K.RAW_ATTRIBUTES])


@query(
    "validate_features",
    WIDE + f"SELECT customer_id, {', '.join(K.FEATURES)}, risk_score, risk_score AS predicted_risk_score FROM ec",
)
def validate_features(spark, sf):
    return feat.validate_features(materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES, "risk_score")))


@query(
    "zero_as_missing",
    WIDE + f"""SELECT customer_id, {r(f'''coalesce(nullif(employment_duration_months, 0),
  (SELECT median(nullif(employment_duration_months, 0)) FROM ec))''', 6)} AS employment_duration_months,
  {r('''coalesce(nullif(missed_payments_6m, 0), (SELECT median(nullif(missed_payments_6m, 0)) FROM ec))''', 6)} AS missed_payments_6m
FROM ec""",
)
def zero_as_missing(spark, sf):
    columns = ["employment_duration_months", "missed_payments_6m"]
    base = materialise(P.wide_customers(spark, sf, "customer_id", *columns))
    filled = feat.zero_as_missing(base, columns)
    return filled.select("customer_id", *[N.round_up(F.col(c), 6).alias(c) for c in columns])


def _describe_sql(c: str) -> str:
    v = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS feature, count({c}) AS count, {r(f'avg({v})', 6)} AS mean, {r(f'stddev_samp({v})', 6)} AS std,
 min({v}) AS min, max({v}) AS max, count(*) FILTER (WHERE {v} < 0 OR {v} > 100) AS out_of_range,
 {r(f'quantile_cont({v}, 0.25)', 6)} AS q25, {r(f'quantile_cont({v}, 0.5)', 6)} AS q50, {r(f'quantile_cont({v}, 0.75)', 6)} AS q75 FROM ec"""


@query(
    "describe_features",
    WIDE + " UNION ALL ".join(_describe_sql(c) for c in [*K.FEATURES, "monthly_income"]),
)
def describe_features(spark, sf):
    columns = [*K.FEATURES, "monthly_income"]
    base = materialise(P.wide_customers(spark, sf, *columns))
    out = feat.describe_features(base, columns)
    return out.withColumns({c: N.round_up(F.col(c), 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "zero_ratio",
    WIDE + f"SELECT {r('avg(CASE WHEN savings_rate = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)', 9)} AS zero_ratio FROM ec",
)
def zero_ratio(spark, sf):
    out = feat.zero_ratio(P.customer_attributes(spark, sf, ["savings_rate"]), "savings_rate")
    return out.select(N.round_up(F.col("zero_ratio"), 9).alias("zero_ratio"))


@query(
    "safe_float",
    with_(SURVEY) + f"SELECT l_orderkey, l_linenumber, coalesce(TRY_CAST(trim(rating) AS DOUBLE), {d(0)}) AS rating_value FROM sv",
)
def safe_float(spark, sf):
    return P.survey_answers(spark, sf).select(
        "l_orderkey", "l_linenumber", N.safe_float(F.col("rating")).alias("rating_value")
    )


@query(
    "normalise_100_to_1",
    f"""SELECT event_id, least({d(1)}, greatest({d(0)},
  (CASE WHEN value > 100 THEN value / {d(100)} ELSE value END) / {d(100)})) AS unit_value FROM events""",
)
def normalise_100_to_1(spark, sf):
    return P.raw_events(spark, sf).select("event_id", N.percent_to_unit(F.col("event_value")).alias("unit_value"))


@query(
    "normalise_if_gt1",
    f"SELECT event_id, CASE WHEN value > 1 THEN value / {d(100)} ELSE value END AS unit_value FROM events",
)
def normalise_if_gt1(spark, sf):
    return P.raw_events(spark, sf).select("event_id", N.unit_if_above_one(F.col("event_value")).alias("unit_value"))


@query(
    "value_status",
    with_(SURVEY) + """SELECT l_orderkey, l_linenumber, TRY_CAST(trim(rating) AS DOUBLE) AS value,
  CASE WHEN rating IS NULL OR rating = '' THEN 'missing' WHEN TRY_CAST(trim(rating) AS DOUBLE) IS NULL THEN 'invalid'
       ELSE 'valid' END AS status FROM sv""",
)
def value_status(spark, sf):
    s = N.value_and_status(F.col("rating"))
    return P.survey_answers(spark, sf).select(
        "l_orderkey", "l_linenumber", s.getField("value").alias("value"), s.getField("status").alias("status")
    )


_POINTS = f"""coalesce(savings_rate, {d(0)}) * {d(100)} + employment_duration_months / {d(12)} * {d(5)}
  + account_age_months / {d(24)} * {d(3)} - missed_payments_6m * {d(8)} - bill_payment_delay_avg * {d(2)}"""


@query(
    "synth_risk_score",
    WIDE + f""", p AS (SELECT customer_id, risk_score, {_POINTS} AS x FROM ec)
SELECT customer_id, risk_score, {r(f'''(x - (SELECT min(x) FROM p)) / ((SELECT max(x) FROM p) - (SELECT min(x) FROM p)
  + {d(1e-9)}) * {d(100)}''', 2)} AS resilience_points FROM p""",
)
def synth_risk_score(spark, sf):
    base = P.customer_attributes(spark, sf).select(
        "customer_id", feat.synth_risk_score().alias("risk_score"), feat.synth_resilience_points().alias("x")
    )
    return feat.min_max_percent(materialise(base), "x", "resilience_points").drop("x")


def _poisson_sql(x: str) -> str:
    import math

    total, parts = 0.0, []
    for k in range(12):
        total += math.exp(-0.8) * 0.8**k / math.factorial(k)
        parts.append(f"CAST({x} >= {d(total)} AS INTEGER)")
    return "(" + " + ".join(parts) + ")"


_KEY = "c_custkey"


@query(
    "generate_customers",
    f"""WITH g AS (SELECT c_custkey AS customer_id,
  {clip(f"{d(30000)} + {d(9000)} * {z(_KEY, 0)}", 12000, 120000)} AS income,
  {d(0.05)} + {d(0.35)} * ({u(_KEY, 2)}) AS variance, {u(_KEY, 3)} AS ud, {u(_KEY, 4)} AS um,
  {d(0.3)} + {d(0.8)} * ({u(_KEY, 5)}) AS spend, {z(_KEY, 3)} AS zs, {u(_KEY, 8)} AS ue, {u(_KEY, 9)} AS ua FROM customer),
h AS (SELECT *, {clip(f"-({d(2)} + variance * {d(5)}) * ln(ud)", 0, 30)} AS delay FROM g)
SELECT customer_id, {r('income', 2)} AS monthly_income, {r('variance', 3)} AS income_variance,
  {r('delay', 2)} AS bill_payment_delay_avg,
  CAST(least(6, floor(delay / {d(5)} + {_poisson_sql('um')})) AS INTEGER) AS missed_payments_6m,
  {r('spend', 2)} AS spending_ratio, {r(clip(f"{d(1)} - spend + {d(0.05)} * zs", 0, 0.4), 2)} AS savings_rate,
  CAST(3 + floor(ue * {d(297)}) AS INTEGER) AS employment_duration_months,
  CAST(6 + floor(ua * {d(234)}) AS INTEGER) AS account_age_months FROM h""",
)
def generate_customers(spark, sf):
    keys = read(spark, sf, "customer", "c_custkey").withColumnRenamed("c_custkey", "customer_id")
    return feat.generate_customers(keys)
