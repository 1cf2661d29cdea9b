"""Queries on masking, anonymity checks and the anonymisation pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import masking as M
from riskloom.operators import privacy as V
from riskloom.plans.registry import query
from riskloom.plans.sqltext import CONTACTS, WIDE, d, r, wide_cte, with_
from riskloom.sources import proxies as P
from riskloom.sources.store import materialise
from riskloom.sources.tables import read


def band_text_sql(e: str, width: int) -> str:
    low = f"CAST(floor(trunc({e}) / {d(width)}) AS BIGINT) * {width}"
    return f"CASE WHEN {e} IS NULL THEN NULL ELSE CAST({low} AS VARCHAR) || '-' || CAST({low} + {width} AS VARCHAR) END"


# A salt for checked results only; real pseudonyms need a secret one.
SALT = "only-for-tests"
_HASH = f"sha256(CAST({{0}} AS VARCHAR) || '{SALT}')"


@query("hash_ids", f"SELECT c_custkey AS customer_id, {_HASH.format('c_custkey')} AS hashed_id FROM customer")
def hash_ids(spark, sf):
    key = F.col("c_custkey")
    return read(spark, sf, "customer", "c_custkey").select(key.alias("customer_id"), M.hash_id(key, SALT).alias("hashed_id"))


@query("hash_ids_plain", "SELECT c_custkey AS customer_id, CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 15) AS BIGINT) AS hashed_id FROM customer")
def hash_ids_plain(spark, sf):
    key = F.col("c_custkey")
    return read(spark, sf, "customer", "c_custkey").select(key.alias("customer_id"), M.hash_id_plain(key).alias("hashed_id"))


_MAIL = "CASE WHEN contains(email, '@') THEN substr(email, 1, 1) || '***@' || split_part(email, '@', 2) ELSE email END"
_PHONE = "CASE WHEN phone IS NULL THEN NULL WHEN length(phone) < 5 THEN '****' ELSE substr(phone, 1, 2) || '****' || right(phone, 3) END"


@query("mask_email", with_(CONTACTS) + f"SELECT customer_id, {_MAIL} AS email FROM ct")
def mask_email(spark, sf):
    return P.contacts(spark, sf).select("customer_id", M.mask_email(F.col("email")).alias("email"))


@query("mask_phone", with_(CONTACTS) + f"SELECT customer_id, {_PHONE} AS phone FROM ct")
def mask_phone(spark, sf):
    return P.contacts(spark, sf).select("customer_id", M.mask_phone(F.col("phone")).alias("phone"))


@query("generalise_age", with_(CONTACTS) + f"SELECT customer_id, {band_text_sql('age', 5)} AS age_group FROM ct")
def generalise_age(spark, sf):
    return P.contacts(spark, sf).select("customer_id", M.generalise_age(F.col("age")).alias("age_group"))


@query("generalise_income", WIDE + f"SELECT customer_id, {band_text_sql('monthly_income', 10000)} AS monthly_income FROM ec")
def generalise_income(spark, sf):
    base = P.customer_attributes(spark, sf, ["monthly_income"])
    return base.select("customer_id", M.generalise_income(F.col("monthly_income")).alias("monthly_income"))


@query("generalise_spending", WIDE + "SELECT customer_id, round_even(spending_ratio, 0) AS spending_ratio FROM ec")
def generalise_spending(spark, sf):
    base = P.customer_attributes(spark, sf, ["spending_ratio"])
    return base.select("customer_id", M.generalise_spending(F.col("spending_ratio")).alias("spending_ratio"))


@query("generalise_account_age", WIDE + f"SELECT customer_id, {band_text_sql('account_age_months', 60)} AS account_age_months FROM ec")
def generalise_account_age(spark, sf):
    base = P.customer_attributes(spark, sf, ["account_age_months"])
    return base.select("customer_id", M.generalise_account_age(F.col("account_age_months")).alias("account_age_months"))


@query(
    "anonymize_table",
    with_(wide_cte(), CONTACTS) + f"""SELECT {_HASH.format('ec.customer_id')} AS customer_id, {_MAIL} AS email, {_PHONE} AS phone,
  {band_text_sql('monthly_income', 10000)} AS monthly_income, round_even(spending_ratio, 0) AS spending_ratio,
  {band_text_sql('account_age_months', 60)} AS account_age_months, {band_text_sql('age', 5)} AS age_group
FROM ec JOIN ct ON ct.customer_id = ec.customer_id""",
)
def anonymize_table(spark, sf):
    base = P.customer_attributes(spark, sf, ["monthly_income", "spending_ratio", "account_age_months"])
    joined = materialise(
        base.join(P.contacts(spark, sf), "customer_id").withColumn("fax", F.lit(None).cast("string"))
    )
    return V.anonymize(joined, SALT)


GENERAL_CTE = f""",
ge AS (SELECT customer_id, {band_text_sql('monthly_income', 10000)} AS monthly_income, round_even(spending_ratio, 0) AS spending_ratio,
  {band_text_sql('account_age_months', 60)} AS account_age_months, round_even(risk_score, 0) / {d(100)} AS risk_score FROM ec)"""
_QI = ["monthly_income", "spending_ratio", "account_age_months"]
_QS = ", ".join(_QI)


@query(
    "k_anonymity_violations",
    WIDE + GENERAL_CTE + f"""SELECT {', '.join(f"coalesce(CAST({c} AS VARCHAR), 'UNKNOWN') AS {c}" for c in _QI)}, count(*) AS count FROM ge
GROUP BY 1, 2, 3 HAVING count(*) < 3""",
)
def k_anonymity_violations(spark, sf):
    return V.k_violations(P.generalised(spark, sf), _QI, 3)


@query(
    "l_diversity_violations",
    WIDE + GENERAL_CTE + f"""SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _QI)}, count(DISTINCT risk_score) AS diversity FROM ge
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _QI)} GROUP BY 1, 2, 3 HAVING count(DISTINCT risk_score) < 6""",
)
def l_diversity_violations(spark, sf):
    return V.l_violations(P.generalised(spark, sf), _QI, "risk_score", 6)


@query(
    "l_diversity_stats",
    WIDE + GENERAL_CTE + f""", g AS (SELECT count(DISTINCT risk_score) AS dv FROM ge WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _QI)} GROUP BY {_QS})
SELECT count(*) AS total_groups, count(*) FILTER (WHERE dv < 6) AS violating_groups, {r(f'count(*) FILTER (WHERE dv < 6) * {d(100)} / count(*)', 2)} AS violation_rate,
  6 AS l_value FROM g""",
)
def l_diversity_stats(spark, sf):
    return V.l_diversity_stats(P.generalised(spark, sf), _QI, "risk_score", 6)


@query(
    "suppress_groups",
    WIDE + GENERAL_CTE + f""", n AS (SELECT *, count(*) OVER (PARTITION BY {_QS}) AS sz FROM ge)
SELECT customer_id, {_QS}, risk_score FROM n WHERE sz >= 3 OR {' OR '.join(f'{c} IS NULL' for c in _QI)}""",
)
def suppress_groups(spark, sf):
    rows = materialise(P.generalised(spark, sf))
    return V.suppress(rows, V.k_violations(rows, _QI, 3), _QI)


_COARSE_INCOME = f"CAST(CAST(floor(CAST(split_part(monthly_income, '-', 1) AS DOUBLE) / {d(20000)}) AS BIGINT) * 20000 AS VARCHAR)"


@query(
    "coarsen_if_needed",
    WIDE + GENERAL_CTE + f""", v AS (SELECT count(*) AS n FROM (SELECT 1 FROM ge GROUP BY {_QS} HAVING count(*) < 3)),
t AS (SELECT (SELECT n FROM v) > (SELECT count(*) FROM ge) * {d(0)} AS needed)
SELECT customer_id, CASE WHEN needed THEN {_COARSE_INCOME} ELSE monthly_income END AS monthly_income,
  CASE WHEN needed THEN round_even(spending_ratio / {d(10)}, 0) * {d(10)} ELSE spending_ratio END AS spending_ratio,
  account_age_months, risk_score FROM ge, t""",
)
def coarsen_if_needed(spark, sf):
    return V.coarsen_if_needed(materialise(P.generalised(spark, sf)), _QI, 3, threshold=0.0)


def _pipeline_sql(l: int, source: str = "ge", before: str = "") -> str:
    nulls = " OR ".join(f"{c} IS NULL" for c in _QI)
    return WIDE + GENERAL_CTE + before + f""",
k1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY {_QS}) AS sz FROM {source}) WHERE sz >= 3 OR {nulls}),
dv AS (SELECT {_QS}, count(DISTINCT risk_score) AS dv FROM k1 GROUP BY {_QS}),
fin AS (SELECT k1.* FROM k1 LEFT JOIN dv ON k1.monthly_income = dv.monthly_income AND k1.spending_ratio = dv.spending_ratio
  AND k1.account_age_months = dv.account_age_months WHERE dv.dv IS NULL OR dv.dv >= {l})
"""


_COARSE = f""",
co AS (SELECT customer_id, {_COARSE_INCOME} AS monthly_income, round_even(spending_ratio / {d(10)}, 0) * {d(10)} AS spending_ratio,
  account_age_months, risk_score FROM ge)"""


@query(
    "anonymize_pipeline_coarsened",
    _pipeline_sql(6, "co", _COARSE) + f"SELECT {_HASH.format('customer_id')} AS customer_id, {_QS}, risk_score FROM fin",
)
def anonymize_pipeline_coarsened(spark, sf):
    """With no tolerance, one small group is enough to coarsen all rows."""
    source = P.privacy_input(spark, sf).select("customer_id", *_QI, "risk_score")
    return V.anonymize_pipeline(source, SALT, k=3, l=6, threshold=0.0)


@query(
    "anonymize_pipeline",
    _pipeline_sql(6) + f"SELECT {_HASH.format('customer_id')} AS customer_id, {_QS}, risk_score FROM fin",
)
def anonymize_pipeline(spark, sf):
    source = P.privacy_input(spark, sf).select("customer_id", *_QI, "risk_score")
    return V.anonymize_pipeline(source, SALT, k=3, l=6)


_REPORT = [
    "(SELECT count(*) FROM ge)", "(SELECT count(*) FROM fin)",
    r("(1 - CAST((SELECT count(*) FROM fin) AS DOUBLE) / (SELECT count(*) FROM ge)) * 100", 2),
    f"(SELECT {r('avg(sz)', 2)} FROM gs)", "(SELECT min(sz) FROM gs)",
    f"""(SELECT {r(f"({d(0.5)} * (count(*) FILTER (WHERE sz = 1) / CAST(count(*) AS DOUBLE)) + {d(0.3)} * (count(*) FILTER (WHERE sz < 3) / CAST(count(*) AS DOUBLE)) + {d(0.2)} * (1 - count(DISTINCT sz) / CAST(count(*) AS DOUBLE))) * 100", 2)} FROM gs)""",
    "(SELECT count(DISTINCT risk_score) FROM fin)", "3", "3",
]


@query(
    "privacy_report",
    _pipeline_sql(3) + f""", gs AS (SELECT count(*) AS sz FROM fin WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _QI)} GROUP BY {_QS})
""" + " UNION ALL ".join(f"SELECT '{m}' AS \"Metric\", CAST({e} AS DOUBLE) AS \"Value\"" for m, e in zip(K.PRIVACY_METRICS, _REPORT)),
)
def privacy_report(spark, sf):
    source = P.privacy_input(spark, sf).select("customer_id", *_QI, "risk_score")
    final = materialise(V.anonymize_pipeline(source, SALT, k=3, l=3), "final")
    return V.privacy_report(read(spark, sf, "customer", "c_custkey"), final)
