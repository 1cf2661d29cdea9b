"""Queries on portfolio reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import round_up
from riskloom.operators import portfolio as A
from riskloom.operators.portfolio_view import PortfolioView, change_rows
from riskloom.operators.scoring import behaviour_score
from riskloom.plans.bands import BEHAVIOUR, CATEGORY, SEGMENT
from riskloom.plans.registry import query
from riskloom.plans.sqltext import WIDE, d, r, snapshot_cte, with_
from riskloom.sources import proxies as P
from riskloom.sources.published import publish, read_published
from riskloom.sources.store import materialise, scratch_path
from riskloom.sources.tables import read

PAY, INC, RES = K.FEATURES


def _r6(df, *columns):
    return df.withColumns({c: round_up(F.col(c), 6) for c in columns})


@query("total_customers", "SELECT count(*) AS total_customers FROM customer")
def total_customers(spark, sf):
    return A.total_customers(read(spark, sf, "customer", "c_custkey"))


@query("risk_distribution", WIDE + f"SELECT {CATEGORY} AS risk_category, count(*) AS customer_count FROM ec GROUP BY 1")
def risk_distribution(spark, sf):
    return A.risk_distribution(P.wide_customers(spark, sf, "risk_score"))


@query("income_by_risk", WIDE + f"SELECT {CATEGORY} AS risk_category, {r('avg(monthly_income)', 6)} AS average_income FROM ec GROUP BY 1")
def income_by_risk(spark, sf):
    return _r6(A.income_by_risk(P.wide_customers(spark, sf, "risk_score", "monthly_income")), "average_income")


@query(
    "payment_behaviour",
    WIDE + f"SELECT {r('avg(bill_payment_delay_avg)', 6)} AS average_payment_delay, {r('avg(missed_payments_6m)', 6)} AS average_missed_payments FROM ec",
)
def payment_behaviour(spark, sf):
    out = A.payment_behaviour(P.wide_customers(spark, sf, "bill_payment_delay_avg", "missed_payments_6m"))
    return _r6(out, *out.columns)


@query("spending_segments", WIDE + f"SELECT {SEGMENT} AS spending_segment, count(*) AS customer_count FROM ec GROUP BY 1")
def spending_segments(spark, sf):
    return A.spending_segments(P.wide_customers(spark, sf, "spending_ratio"))


@query(
    "feature_averages",
    WIDE + f"""SELECT {r(f'avg({PAY})', 6)} AS avg_payment_discipline, {r(f'avg({INC})', 6)} AS avg_income_stability,
  {r(f'avg({RES})', 6)} AS avg_financial_resilience FROM ec""",
)
def feature_averages(spark, sf):
    out = A.feature_averages(P.wide_customers(spark, sf, *K.FEATURES))
    return _r6(out, *out.columns)


@query("risk_by_missed", WIDE + f"SELECT missed_payments_6m, {r('avg(risk_score)', 6)} AS average_risk_score FROM ec GROUP BY 1")
def risk_by_missed(spark, sf):
    return _r6(A.risk_by_missed(P.wide_customers(spark, sf, "missed_payments_6m", "risk_score")), "average_risk_score")


@query(
    "model_validation",
    WIDE + f"SELECT {r('avg(risk_score)', 6)} AS original_avg_risk_score, {r(f'avg({BEHAVIOUR})', 6)} AS predicted_avg_risk_score FROM ec",
)
def model_validation(spark, sf):
    out = A.model_validation(P.wide_customers(spark, sf, "risk_score", *K.FEATURES))
    return _r6(out, *out.columns)


@query(
    "reconstruction_error",
    WIDE + f"""SELECT {r('avg(risk_score)', 6)} AS original_avg, {r(f'avg({BEHAVIOUR})', 6)} AS predicted_avg,
  {r(f'abs(avg(risk_score) - avg({BEHAVIOUR}))', 6)} AS difference FROM ec""",
)
def reconstruction_error(spark, sf):
    out = A.reconstruction_error(P.wide_customers(spark, sf, "risk_score", *K.FEATURES))
    return _r6(out, *out.columns)


@query(
    "portfolio_summary",
    WIDE + f"SELECT risk_band, count(*) AS customer_count, {r('avg(risk_score)', 6)} AS avg_risk_score FROM ec GROUP BY 1",
)
def portfolio_summary(spark, sf):
    summary = _r6(A.portfolio_summary(P.wide_customers(spark, sf, "risk_band", "risk_score")), "avg_risk_score")
    path = scratch_path(spark, "portfolio_summary")
    publish(summary, path)  # refresh of the stored summary
    return read_published(spark, path)


@query(
    "portfolio_kept_up_to_date",
    with_(snapshot_cte("cur", P.NEW_WINDOW)) + f"SELECT risk_band, count(*) AS customer_count, {r('avg(CAST(risk_score AS DECIMAL(24,12)))', 6)} AS avg_risk_score FROM cur GROUP BY 1",
)
def portfolio_kept_up_to_date(spark, sf):
    """The stored view of the first window after customers came, went and changed: changes are counted in, in three batches, one of them twice."""
    old = P.feature_snapshot(spark, sf, P.OLD_WINDOW).select("customer_id", "risk_band", "risk_score")
    new = P.feature_snapshot(spark, sf, P.NEW_WINDOW).select("customer_id", "risk_band", "risk_score")
    view = PortfolioView(scratch_path(spark, "portfolio_view"))
    view.build(old)
    changes = materialise(change_rows(old, new), "portfolio_changes")
    for batch in (1, 2, 2, 3):
        view.apply(changes.where(F.pmod("customer_id", F.lit(3)) == batch - 1), batch)
    return _r6(view.read(spark), "avg_risk_score")


@query(
    "zone_shares",
    WIDE + f""", s AS (SELECT {BEHAVIOUR} AS x FROM ec)
SELECT {r('100.0 * count(*) FILTER (WHERE x < 50) / count(*)', 6)} AS high_pct, {r('100.0 * count(*) FILTER (WHERE x >= 50 AND x < 75) / count(*)', 6)} AS medium_pct,
  {r('100.0 * count(*) FILTER (WHERE x >= 75) / count(*)', 6)} AS low_pct, {r('avg(x)', 6)} AS mean_score FROM s""",
)
def zone_shares(spark, sf):
    out = A.zone_shares(P.wide_customers(spark, sf, *K.FEATURES))
    return _r6(out, *out.columns)


@query(
    "score_histogram",
    WIDE + f""", s AS (SELECT {BEHAVIOUR} AS x FROM ec WHERE {BEHAVIOUR} IS NOT NULL), b AS (SELECT min(x) AS lo, max(x) AS hi FROM s)
SELECT CAST(least(29, floor((x - lo) / (hi - lo) * {d(30)})) AS INTEGER) AS bin, count(*) AS n FROM s, b GROUP BY 1""",
)
def score_histogram(spark, sf):
    scores = P.wide_customers(spark, sf, *K.FEATURES).select(behaviour_score().alias("score"))
    return A.histogram(materialise(scores), "score", 30)


@query(
    "high_risk_filter",
    WIDE + "SELECT customer_id, risk_score, risk_band FROM ec WHERE risk_band = 'High'",
)
def high_risk_filter(spark, sf):
    return A.high_risk(P.wide_customers(spark, sf, "customer_id", "risk_score", "risk_band"))


_NN = ["customer_id", "risk_score", RES]


@query(
    "constraint_violations",
    WIDE + " UNION ALL ".join(
        [f"SELECT 'not_null:{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM ec" for c in _NN]
        + [
            "SELECT 'range:risk_score', count(*) FILTER (WHERE risk_score NOT BETWEEN 0 AND 1) FROM ec",
            f"SELECT 'range:{RES}', count(*) FILTER (WHERE {RES} NOT BETWEEN 20 AND 100) FROM ec",
            "SELECT 'enum:risk_band', count(*) FILTER (WHERE risk_band NOT IN ('Low', 'Medium')) FROM ec",
            "SELECT 'unique:customer_id', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM ec GROUP BY customer_id HAVING count(*) > 1)",
        ]
    ),
)
def constraint_violations(spark, sf):
    df = P.wide_customers(spark, sf, "customer_id", "risk_score", "risk_band", RES)
    return A.constraint_violations(
        df, "customer_id", _NN, {"risk_score": (0.0, 1.0), RES: (20.0, 100.0)}, {"risk_band": ["Low", "Medium"]}
    )


_TYPES = {
    "customer_id": "bigint", "monthly_income": "double", "income_variance": "double", "bill_payment_delay_avg": "double",
    "missed_payments_6m": "int", "spending_ratio": "double", "savings_rate": "double", "employment_duration_months": "int",
    "account_age_months": "int", PAY: "double", INC: "double", RES: "double", "risk_score": "double", "risk_band": "string",
}
_REQUIRED = ["customer_id", *K.FEATURES, "risk_score"]


@query(
    "schema_listing",
    WIDE + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, {str(c in _REQUIRED).lower()} AS required, count(*) FILTER (WHERE {c} IS NULL) AS missing_values FROM ec"
        for c, t in _TYPES.items()
    ),
)
def schema_listing(spark, sf):
    return A.schema_listing(P.wide_customers(spark, sf), _REQUIRED)
