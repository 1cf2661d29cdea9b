"""Pieces of the checking SQL. Literals are cast to DOUBLE so both engines do binary arithmetic."""

from __future__ import annotations


def d(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def r(e: str, n: int) -> str:
    """Round half up on the binary value."""
    return f"floor(({e}) * {d(10.0**n)} + {d(0.5)}) / {d(10.0**n)}"


def clip(e: str, lo: float, hi: float) -> str:
    return f"CASE WHEN ({e}) IS NULL THEN NULL ELSE least({d(hi)}, greatest({d(lo)}, {e})) END"


def u(key: str, draw: int, seed: int = 42) -> str:
    """Uniform draw fixed by (key, draw, seed)."""
    start = 1 if draw % 2 == 0 else 14
    digest = f"md5(CAST({key} AS VARCHAR) || ':{draw // 2}:{seed}')"
    return f"(CAST(CAST('0x' || substr({digest}, {start}, 13) AS BIGINT) AS DOUBLE) + {d(0.5)}) / {d(16.0**13)}"


def z(key: str, draw: int, seed: int = 42) -> str:
    """Standard normal draw from two uniform draws."""
    import math

    return f"sqrt({d(-2.0)} * ln({u(key, 2 * draw, seed)})) * cos({d(2.0 * math.pi)} * {u(key, 2 * draw + 1, seed)})"


def bucket(key: str, n: int) -> str:
    """Stable hash bucket of a key."""
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {n})"


def customers_cte(name: str = "sc", since: str | None = None, until: str | None = None) -> str:
    """CTE text of the customer attributes (and helper CTEs)."""
    window = ""
    if since:
        window += f" AND o_orderdate >= TIMESTAMP '{since}'"
    if until:
        window += f" AND o_orderdate < TIMESTAMP '{until}'"
    join = "JOIN" if since or until else "LEFT JOIN"
    return f"""
{name}_o AS (
  SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent,
         min(o_totalprice) AS low, max(o_totalprice) AS high,
         min(o_orderdate) AS first, max(o_orderdate) AS last,
         count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) AS urgent
  FROM orders WHERE true{window} GROUP BY o_custkey),
{name}_l AS (
  SELECT o_custkey AS ck, count(*) AS nl, count(*) FILTER (WHERE l_returnflag = 'R') AS nr
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE true{window} GROUP BY o_custkey),
{name} AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_acctbal < {d(-890)} THEN NULL
         ELSE {r(f"{d(10000)} + CAST(spent AS DOUBLE) / n / {d(10)}", 2)} END AS monthly_income,
    {r(f"{d(0.4)} * (high - low) / {d(500000)}", 3)} AS income_variance,
    {r(f"{d(9)} * nr / nl", 2)} AS bill_payment_delay_avg,
    CASE WHEN urgent IS NULL THEN NULL ELSE CAST(least(6, urgent) AS INTEGER) END AS missed_payments_6m,
    CASE WHEN n IS NULL THEN NULL ELSE {r(f"{d(0.3)} + {d(0.8)} * least({d(1)}, n / {d(20)})", 2)} END AS spending_ratio,
    CASE WHEN c_acctbal > {d(9890)} OR n IS NULL THEN NULL
         ELSE {r(f"least({d(0.4)}, greatest({d(0)}, (c_acctbal + {d(1000)}) / {d(27500)}))", 2)} END AS savings_rate,
    CAST(floor(date_diff('day', first, last) / {d(30)}) AS INTEGER) AS employment_duration_months,
    CAST(floor(date_diff('day', first, TIMESTAMP '2001-12-31') / {d(30)}) AS INTEGER) AS account_age_months
  FROM customer {join} {name}_o ON o_custkey = c_custkey LEFT JOIN {name}_l ON ck = c_custkey)"""


PAYMENT = clip(f"{d(100)} - bill_payment_delay_avg * {d(5)} - missed_payments_6m * {d(10)}", 0, 100)
INCOME = clip(f"({d(1)} - income_variance) * {d(100)}", 0, 100)
RESILIENCE = clip(
    f"savings_rate * {d(50)} + ({d(1)} - spending_ratio) * {d(30)}"
    f" + ({d(1)} - least(CAST(missed_payments_6m AS DOUBLE), {d(5)}) / {d(5)}) * {d(20)}",
    5,
    100,
)
RISK = clip(
    f"missed_payments_6m * {d(12)} + bill_payment_delay_avg * {d(1.5)} + spending_ratio * {d(20)}"
    f" - coalesce(savings_rate, {d(0)}) * {d(30)} - employment_duration_months / {d(12)}",
    0,
    100,
)


def wide_cte(name: str = "ec", since: str | None = None, until: str | None = None) -> str:
    """Attributes, three scores, 0..100 risk score and band."""
    base = f"{name}_sc"
    return f"""{customers_cte(base, since, until)},
{name}_s AS (
  SELECT *, {PAYMENT} AS payment_discipline_score, {INCOME} AS income_stability_index,
         {RESILIENCE} AS financial_resilience_score, {RISK} AS risk_score FROM {base}),
{name} AS (
  SELECT *, CASE WHEN risk_score > {d(-0.01)} AND risk_score <= 33 THEN 'Low'
                 WHEN risk_score > 33 AND risk_score <= 66 THEN 'Medium'
                 WHEN risk_score > 66 AND risk_score <= 100 THEN 'High' END AS risk_band FROM {name}_s)"""


def snapshot_cte(name: str, window: tuple[str | None, str | None] = (None, None)) -> str:
    return f"""{wide_cte(name + "_w", *window)},
{name} AS (
  SELECT customer_id, payment_discipline_score, income_stability_index, financial_resilience_score,
         {r(f"risk_score / {d(100)}", 4)} AS risk_score, risk_band FROM {name}_w)"""


HISTORY = f"""
ph AS (
  SELECT o_orderkey AS prediction_id, o_custkey AS customer_id, {r(f"o_totalprice / {d(500000)}", 4)} AS risk_score,
         'v' || substr(o_orderpriority, 1, 1) || '.0' AS model_version,
         CASE WHEN o_orderstatus = 'F' THEN 'dataset_v1' ELSE 'v1.0' END AS dataset_version,
         o_orderdate AS prediction_time,
         CASE WHEN o_orderstatus = 'P' THEN 'batch_pipeline' ELSE 'api_inference' END AS created_by,
         CASE o_orderstatus WHEN 'F' THEN 'High' WHEN 'P' THEN 'Medium' ELSE 'Low' END AS original_band,
         CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'v1_raw' ELSE 'v2_safe' END AS feature_version
  FROM orders)"""

SURVEY = f"""
sv AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_returnflag WHEN 'N' THEN 'evet' WHEN 'A' THEN 'kismen' WHEN 'R' THEN 'hayir' END AS understood,
         CASE WHEN l_quantity = 13 THEN '5 → Çok iyi' WHEN l_quantity = 17 THEN NULL
              ELSE CAST(CAST(ceil(l_quantity / {d(10)}) AS BIGINT) AS VARCHAR) END AS rating,
         CAST(1 + (l_suppkey + l_linenumber) % 5 AS INTEGER) AS trust,
         CASE WHEN l_linenumber = 7 THEN 'emin_degilim' WHEN l_linestatus = 'F' THEN 'evet'
              WHEN l_linestatus = 'O' THEN 'hayir' END AS decision,
         CASE l_partkey % 3 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' ELSE 'HIGH' END AS prediction,
         CASE WHEN l_tax < {d(0.03)} THEN 'LOW' WHEN l_tax < {d(0.06)} THEN 'MEDIUM' ELSE 'HIGH' END AS model_band
  FROM lineitem)"""

CONTACTS = """
ct AS (
  SELECT c_custkey AS customer_id,
         lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS email,
         CAST(5550000000 + c_custkey * 7919 AS VARCHAR) AS phone,
         CAST(18 + c_custkey % 60 AS INTEGER) AS age
  FROM customer)"""


def registry_cte(active: str = "v2.0") -> str:
    return f"""{HISTORY},
mr AS (
  SELECT model_version, CASE WHEN model_version < 'v2' THEN 'linear' ELSE 'xgboost' END AS model_name,
         max(prediction_time) AS trained_at, count(*) AS training_rows, model_version = '{active}' AS is_active
  FROM ph GROUP BY model_version)"""


def activations_cte() -> str:
    """Stored predictions and the activations derived from them."""
    return f"""{HISTORY},
act AS (
  SELECT arg_min(model_version, {{'t': prediction_time, 'i': prediction_id}}) AS model_version, min(prediction_time) AS activated_at
  FROM ph GROUP BY date_trunc('month', prediction_time))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


WIDE = with_(wide_cte())
