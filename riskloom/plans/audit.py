"""Queries on change records, the registry and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.operators import asof
from riskloom.operators import audit as C
from riskloom.operators.changes import change_log
from riskloom.plans.joins import ALL, CUR
from riskloom.plans.load import OLD, _new, _old
from riskloom.plans.registry import query
from riskloom.plans.scoring import RUN_TS, UNIT_BEHAVIOUR
from riskloom.plans.sqltext import activations_cte, d, r, registry_cte, with_
from riskloom.sources import proxies as P
from riskloom.sources.store import materialise, scratch_path
from riskloom.streaming.audit_stream import AuditStream, read_updates

PAY, INC, RES = K.FEATURES
RUN_ID = "run-2024-06"


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


@query(
    "audit_insert",
    with_(ALL) + "SELECT customer_id, risk_score, risk_band, 'v1' AS model_version, 'ml_pipeline' AS created_by, 'dataset_v1' AS dataset_version FROM cur",
)
def audit_insert(spark, sf):
    return C.audit_insert(P.feature_snapshot(spark, sf))


@query(
    "audit_change_check",
    with_(OLD, CUR) + """SELECT cur.customer_id, cur.risk_score, cur.risk_band, CASE WHEN old.customer_id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS change
FROM cur LEFT JOIN old ON old.customer_id = cur.customer_id
WHERE old.customer_id IS NULL OR cur.risk_score IS DISTINCT FROM old.risk_score""",
)
def audit_change_check(spark, sf):
    version = F.lit("v2_safe")
    old, new = _old(spark, sf).withColumn("feature_version", version), _new(spark, sf).withColumn("feature_version", version)
    changed = C.changes(old, new, ["risk_score", "feature_version"])
    return changed.select("customer_id", "risk_score", "risk_band", "change")


@query(
    "audit_delete",
    with_(OLD, CUR, registry_cte()) + f"""SELECT customer_id, risk_score, (SELECT min(model_version) FROM mr WHERE is_active) AS model_version,
  'dataset_v1' AS dataset_version, TIMESTAMP '{RUN_TS}' AS deleted_at FROM old WHERE customer_id NOT IN (SELECT customer_id FROM cur)""",
)
def audit_delete(spark, sf):
    return C.deletes(_old(spark, sf), _new(spark, sf), P.model_registry(spark, sf), _run_ts())


_HEX = f"md5('{RUN_ID}:' || customer_id)"


@query(
    "audit_recomputed",
    with_(ALL) + f"""SELECT customer_id, {UNIT_BEHAVIOUR} AS risk_score, CASE WHEN {UNIT_BEHAVIOUR} >= {d(0.7)} THEN 'High' WHEN {UNIT_BEHAVIOUR} >= {d(0.4)} THEN 'Medium' ELSE 'Low' END AS risk_band,
  'v1' AS model_version, TIMESTAMP '{RUN_TS}' AS prediction_time, 'ml_pipeline' AS created_by, 'dataset_v1' AS dataset_version,
  substr({_HEX}, 1, 8) || '-' || substr({_HEX}, 9, 4) || '-' || substr({_HEX}, 13, 4) || '-' || substr({_HEX}, 17, 4) || '-' || substr({_HEX}, 21, 12) AS pipeline_run_id FROM cur""",
)
def audit_recomputed(spark, sf):
    return C.audit_recomputed(P.feature_snapshot(spark, sf), RUN_ID, _run_ts())


@query(
    "audit_with_registry",
    with_(ALL, registry_cte()) + "SELECT customer_id, risk_score, risk_band, (SELECT min(model_version) FROM mr WHERE is_active) AS model_version FROM cur",
)
def audit_with_registry(spark, sf):
    return C.audit_with_registry(P.feature_snapshot(spark, sf), P.model_registry(spark, sf))


@query(
    "activate_model",
    with_(registry_cte()) + f"""SELECT model_version, CASE WHEN model_version = 'v3.0' THEN 'gbt' ELSE model_name END AS model_name,
  CASE WHEN model_version = 'v3.0' THEN TIMESTAMP '{RUN_TS}' ELSE trained_at END AS trained_at, training_rows, model_version = 'v3.0' AS is_active FROM mr""",
)
def activate_model(spark, sf):
    registry = P.model_registry(spark, sf)
    model = registry.where("model_version = 'v3.0'").select(
        "model_version", F.lit("gbt").alias("model_name"), _run_ts().alias("trained_at")
    )
    return C.activate_model(registry, model)


_LOG = """SELECT user_id AS customer_id, event_id, ts AS event_time, value AS risk_score, p AS previous_score,
  CASE WHEN rn = 1 THEN 'INSERT' ELSE 'UPDATE' END AS change, 'v1' AS model_version, 'ml_pipeline' AS created_by, 'dataset_v1' AS dataset_version
FROM (SELECT *, lag(value) OVER w AS p, row_number() OVER w AS rn FROM (SELECT event_id, ts, user_id, {value} AS value FROM events)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE rn = 1 OR value IS DISTINCT FROM p"""
_COARSE = f"floor(value / {d(50)})"


def _updates(spark, sf):
    """Score updates of customers: event values in steps, so that neighbours are often equal."""
    return P.raw_events(spark, sf).select(
        "customer_id",
        "event_id",
        "event_time",
        F.floor(F.col("event_value") / 50.0).cast("double").alias("risk_score"),
    )


@query("audit_change_log", _LOG.format(value=_COARSE))
def audit_change_log(spark, sf):
    return change_log(materialise(_updates(spark, sf)))


@query(
    "audit_log_as_of",
    with_(activations_cte(), f"lg AS ({_LOG.format(value=_COARSE)})") + f"""SELECT customer_id, event_id, event_time, risk_score, previous_score, change, created_by,
  dataset_version, coalesce(act.model_version, '{K.UNKNOWN_MODEL}') AS model_version FROM (SELECT * EXCLUDE (model_version) FROM lg) l
ASOF LEFT JOIN act ON l.event_time >= act.activated_at""",
)
def audit_log_as_of(spark, sf):
    """The change log, each row stamped with the model that was active when the change was made."""
    log = change_log(materialise(_updates(spark, sf))).drop("model_version")
    return asof.active_at(log, P.model_activations(spark, sf), "event_time")


@query("audit_stream", _LOG.format(value=_COARSE))
def audit_stream(spark, sf):
    """Updates arrive in three parts; after each the stream runs on from its checkpoint."""
    updates = _updates(spark, sf)
    span = updates.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).first()
    step = (span.hi - span.lo) / 3
    source, stream = scratch_path(spark, "updates"), AuditStream.fresh(spark)
    time = F.col("event_time")
    for i in range(3):
        low, high = span.lo + step * i, span.lo + step * (i + 1)
        part = updates.where((time >= F.lit(low)) if i else F.lit(True)).where((time < F.lit(high)) if i < 2 else F.lit(True))
        part.write.mode("append").parquet(source)
        stream.run(read_updates(spark, source, updates.schema))
    return stream.log(spark)


def _psi_sql() -> str:
    parts = []
    for c in K.FEATURES:
        edges = [f"(SELECT quantile_cont({c}, {i / 10}) FROM old)" for i in range(1, 10)]
        place = "(" + " + ".join(f"CASE WHEN {c} > {e} THEN 1 ELSE 0 END" for e in edges) + ")"
        parts.append(
            f"""SELECT '{c}' AS feature_name, {r('sum((a - e) * ln(a / e))', 4)} AS psi_score FROM (
  SELECT greatest({d(1e-6)}, sum(cr) / (SELECT CAST(count({c}) AS DOUBLE) FROM cur)) AS a, greatest({d(1e-6)}, sum(br) / (SELECT CAST(count({c}) AS DOUBLE) FROM old)) AS e FROM (
    SELECT {place} AS b, 1 AS br, 0 AS cr FROM old WHERE {c} IS NOT NULL UNION ALL SELECT {place}, 0, 1 FROM cur WHERE {c} IS NOT NULL) GROUP BY b)"""
        )
    return with_(OLD, CUR) + " UNION ALL ".join(parts)


@query("drift_psi", _psi_sql())
def drift_psi(spark, sf):
    base = materialise(_old(spark, sf).select(*K.FEATURES))
    return C.drift_psi(base, _new(spark, sf).select(*K.FEATURES), K.FEATURES)
