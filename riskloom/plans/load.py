"""Queries on sources, sinks and load steps."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom import constants as K
from riskloom.functions.numeric import dbl, round_up
from riskloom.operators import load as L
from riskloom.operators import setops as U
from riskloom.operators.privacy import drop_empty_columns
from riskloom.plans.joins import ALL, CUR
from riskloom.plans.registry import query
from riskloom.plans.scoring import RUN_TS
from riskloom.plans.sqltext import HISTORY, SURVEY, WIDE, d, r, snapshot_cte, with_
from riskloom.sources import proxies as P
from riskloom.sources import store as S
from riskloom.sources.published import publish, read_published
from riskloom.streaming.event_sessions import EventSessions, heartbeat

PAY, INC, RES = K.FEATURES
_FEATS = f"{PAY}, {INC}, {RES}"
OLD = snapshot_cte("old", P.OLD_WINDOW)


def _old(spark, sf):
    return P.feature_snapshot(spark, sf, P.OLD_WINDOW)


def _new(spark, sf):
    return P.feature_snapshot(spark, sf, P.NEW_WINDOW)


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


@query("scan_csv", WIDE + f"SELECT customer_id, {', '.join(K.RAW_ATTRIBUTES)} FROM ec")
def scan_csv(spark, sf):
    rows = P.customer_attributes(spark, sf)
    path = S.scratch_path(spark, "customers-csv")
    S.write_csv(rows, path)
    return S.read_csv(spark, path, rows.schema)


@query(
    "scan_csv_skip_bad",
    with_(SURVEY) + """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, understood, rating, CASE WHEN rating IS NULL THEN NULL ELSE CAST(trust AS VARCHAR) END AS trust
FROM sv WHERE rating IS NULL OR rating <> '5 → Çok iyi'""",
)
def scan_csv_skip_bad(spark, sf):
    # Lines as people type them: one field too many where the rating carries a remark, one too few where there is none.
    a = P.survey_answers(spark, sf)
    lines = a.select(
        F.when(F.col("rating").isNull(), F.concat_ws(",", "l_orderkey", "understood", F.lit("")))
        .when(F.col("rating").contains("→"), F.concat_ws(",", "l_orderkey", "understood", F.lit("5"), F.lit("Çok iyi"), "trust"))
        .otherwise(F.concat_ws(",", "l_orderkey", "understood", "rating", "trust"))
        .alias("value")
    )
    path = S.scratch_path(spark, "answers")
    lines.write.text(path)
    return S.read_csv_skip_bad(spark, path, ["l_orderkey", "understood", "rating", "trust"], header=False)


@query("strip_headers", with_(SURVEY) + "SELECT l_orderkey AS \"Anahtar\", rating AS \"Açıklamayı ne kadar yeterli buldunuz?\" FROM sv")
def strip_headers(spark, sf):
    a = P.survey_answers(spark, sf).select(
        F.col("l_orderkey").alias("Anahtar "), F.col("rating").alias("  Açıklamayı ne kadar yeterli buldunuz?  ")
    )
    return S.strip_headers(a)


@query("copy_staging", WIDE + f"SELECT customer_id, {_FEATS}, risk_score, risk_band FROM ec")
def copy_staging(spark, sf):
    rows = P.wide_customers(spark, sf, "customer_id", *K.FEATURES, "risk_score", "risk_band")
    path = S.scratch_path(spark, "features-csv")
    S.write_csv(rows, path)
    view = f"staging_engineered_features_{uuid.uuid4().hex}"
    S.read_csv(spark, path, rows.schema).createOrReplaceTempView(view)
    return spark.table(view)


@query("load_features_projection", with_(ALL) + f"SELECT customer_id, {_FEATS} FROM cur")
def load_features_projection(spark, sf):
    view = f"engineered_features_{uuid.uuid4().hex}"
    P.feature_snapshot(spark, sf).createOrReplaceTempView(view)
    return L.load_features(spark, view)


@query("write_replace", with_(ALL) + f"SELECT customer_id, {_FEATS}, risk_score, risk_band FROM cur")
def write_replace(spark, sf):
    path = S.scratch_path(spark, "replaced")
    publish(_old(spark, sf), path)
    publish(P.feature_snapshot(spark, sf), path)
    return read_published(spark, path)


@query("write_csv", with_(HISTORY) + "SELECT prediction_id, customer_id, risk_score, model_version, created_by FROM ph")
def write_csv(spark, sf):
    rows = P.prediction_history(spark, sf).select("prediction_id", "customer_id", "risk_score", "model_version", "created_by")
    path = S.scratch_path(spark, "predictions-csv")
    S.write_csv(rows, path)
    return S.read_csv(spark, path, rows.schema)


@query("append_results", with_(ALL) + "SELECT customer_id, risk_score FROM cur")
def append_results(spark, sf):
    path = S.scratch_path(spark, "appended")
    rows = S.materialise(P.feature_snapshot(spark, sf).select("customer_id", "risk_score"))
    for part in ("customer_id % 2 = 0", "customer_id % 2 <> 0"):  # two runs that add to one table
        S.append_results(rows.where(part), path)
    return spark.read.schema("customer_id bigint, risk_score double").parquet(path)


@query("upsert_do_nothing", with_(OLD, CUR) + "SELECT customer_id FROM old UNION SELECT customer_id FROM cur")
def upsert_do_nothing(spark, sf):
    return L.upsert_do_nothing(_old(spark, sf).select("customer_id"), _new(spark, sf), "customer_id")


@query(
    "upsert_do_update",
    with_(OLD, CUR) + f"""SELECT customer_id, {_FEATS}, risk_score, risk_band FROM cur
UNION ALL SELECT customer_id, {_FEATS}, risk_score, risk_band FROM old WHERE customer_id NOT IN (SELECT customer_id FROM cur)""",
)
def upsert_do_update(spark, sf):
    return L.upsert_do_update(_old(spark, sf), _new(spark, sf), "customer_id")


@query(
    "load_features_rescale",
    WIDE + f"""SELECT customer_id, {_FEATS}, CASE WHEN risk_score > 1 THEN risk_score / {d(100)} ELSE risk_score END AS risk_score,
  CAST(NULL AS VARCHAR) AS risk_band FROM ec WHERE risk_band IN ('Low', 'Medium', 'High')""",
)
def load_features_rescale(spark, sf):
    return L.rescale_staged(P.wide_customers(spark, sf, "customer_id", *K.FEATURES, "risk_score", "risk_band"))


@query("touch_updated_at", with_(HISTORY) + f"SELECT prediction_id, risk_score, TIMESTAMP '{RUN_TS}' AS updated_at FROM ph")
def touch_updated_at(spark, sf):
    rows = P.prediction_history(spark, sf).select("prediction_id", "risk_score", F.col("prediction_time").alias("updated_at"))
    return L.touch_updated_at(rows, _run_ts())


@query(
    "promote_to_production",
    WIDE + f"SELECT customer_id, {PAY}, {INC}, coalesce({RES}, {d(50)}) AS {RES}, risk_score, risk_band FROM ec",
)
def promote_to_production(spark, sf):
    return L.promote(P.staging_features(spark, sf, clean=True), S.scratch_path(spark, "production"))


@query("promote_rejected", with_(ALL) + f"SELECT customer_id, {_FEATS}, risk_score, risk_band FROM cur")
def promote_rejected(spark, sf):
    """A stage that does not pass its gate leaves the published table as it was."""
    path = S.scratch_path(spark, "production")
    publish(P.feature_snapshot(spark, sf), path)
    try:
        L.promote(P.staging_features(spark, sf, clean=False), path)
    except ValueError:
        return read_published(spark, path)
    raise AssertionError("a stage with bad rows was promoted")


@query(
    "validate_staging",
    WIDE + f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE x IS NULL OR x <= 1) AS bad_rows
FROM (SELECT CASE WHEN monthly_income IS NULL THEN {d(0.5)} ELSE {RES} END AS x FROM ec)""",
)
def validate_staging(spark, sf):
    return L.staging_counts(P.staging_features(spark, sf, clean=False))


@query(
    "save_predictions",
    WIDE + f"""SELECT customer_id, {r(f"{d(1)} / ({d(1)} + exp(-(risk_score / {d(100)})))", 9)} AS risk_score, risk_band AS original_band, upper(risk_band) AS predicted_band,
  'offline' AS model_version, 'v1' AS feature_version, 'dataset_v1' AS dataset_version, TIMESTAMP '{RUN_TS}' AS prediction_time, 'batch_pipeline' AS created_by FROM ec""",
)
def save_predictions(spark, sf):
    rows = P.wide_customers(spark, sf, "customer_id", "risk_score", "risk_band").select(
        "customer_id",
        (F.col("risk_score") / dbl(100.0)).alias("risk_score"),
        F.col("risk_band").alias("original_band"),
        F.upper("risk_band").alias("predicted_band"),
        F.lit("dataset_v1").alias("dataset_version"),
    )
    stored = L.stored_predictions(rows, _run_ts())
    path = S.scratch_path(spark, "history")
    S.append_results(stored, path)
    back = spark.read.schema(stored.schema).parquet(path)
    return back.withColumn("risk_score", round_up(F.col("risk_score"), 9))


_META = "training_samples bigint, base_value double, target_max double, features array<string>, model_version string"


@query(
    "read_json_metadata",
    with_(HISTORY) + f"""SELECT model_version, count(*) AS training_samples, {r('avg(risk_score)', 6)} AS base_value, max(risk_score) AS target_max,
  '{'|'.join(K.FEATURES)}' AS features FROM ph GROUP BY 1""",
)
def read_json_metadata(spark, sf):
    facts = P.prediction_history(spark, sf).groupBy("model_version").agg(
        F.count(F.lit(1)).alias("training_samples"),
        round_up(F.avg("risk_score"), 6).alias("base_value"),
        F.max("risk_score").alias("target_max"),
    )
    path = S.scratch_path(spark, "metadata")
    documents = facts.withColumn("features", F.array(*[F.lit(c) for c in K.FEATURES]))
    documents.repartition("model_version").write.partitionBy("model_version").json(path)
    back = S.read_json_records(spark, path, StructType.fromDDL(_META))
    return back.withColumn("features", F.array_join("features", "|"))


def _number_sql(e: str) -> str:
    return f"CAST(CAST({r(e, 6)} AS DECIMAL(18,6)) AS VARCHAR)"


_SCALER_SQL = "concat_ws(',', " + ", ".join(f"{_number_sql(f'{f}({c})')}" for f in ("avg", "stddev_samp") for c in K.FEATURES) + ")"


@query(
    "create_model_metadata",
    WIDE + f"""SELECT sha256(sha256({_SCALER_SQL} || chr(10))) AS model_hash, '{RUN_TS}' AS trained_at, 'v2_safe' AS feature_version, 'v1.0' AS dataset_version,
  '{"|".join(K.FEATURES)}' AS features, 'StandardScaler' AS model_type
FROM ec WHERE {' AND '.join(f'{c} IS NOT NULL' for c in K.FEATURES)}""",
)
def create_model_metadata(spark, sf):
    """The artefact holds what was trained, a scaler's means and deviations, and no time or id: its digest says the same on every run."""
    rows = P.wide_customers(spark, sf, *K.FEATURES).dropna()
    numbers = [round_up(f(c), 6).cast("decimal(18,6)").cast("string") for f in (F.avg, F.stddev_samp) for c in K.FEATURES]
    path = S.scratch_path(spark, "scaler")
    rows.agg(F.concat_ws(",", *numbers).alias("value")).write.text(path)
    found = L.model_metadata(spark, path, K.FEATURES, "StandardScaler", RUN_TS, "v2_safe", "v1.0")
    return found.withColumn("features", F.array_join("features", "|"))


@query("feature_store_rebuild", with_(ALL) + f"SELECT customer_id, {_FEATS}, risk_score, risk_band, TIMESTAMP '{RUN_TS}' AS created_at FROM cur")
def feature_store_rebuild(spark, sf):
    backup = S.scratch_path(spark, "backup")
    P.feature_snapshot(spark, sf).withColumn("updated_at", _run_ts()).write.parquet(backup)
    return L.rebuild_features(spark, backup)


@query(
    "rebuild_normalise",
    WIDE + f"""SELECT customer_id, CASE WHEN x IS NULL OR x < 0 THEN {d(0)} WHEN x > 1 THEN {d(1)} ELSE x END AS risk_score
FROM (SELECT customer_id, (monthly_income - {d(30000)}) / {d(10000)} AS x FROM ec)""",
)
def rebuild_normalise(spark, sf):
    score = (F.col("monthly_income") - dbl(30000.0)) / dbl(10000.0)
    rows = P.customer_attributes(spark, sf, ["monthly_income"]).select("customer_id", score.alias("x"))
    return rows.select("customer_id", L.rebuild_normalise(F.col("x")).alias("risk_score"))


@query(
    "union_surveys",
    with_(SURVEY) + """SELECT understood, rating, NULL AS decision, trust FROM sv UNION ALL SELECT understood, NULL, decision, NULL FROM sv""",
)
def union_surveys(spark, sf):
    a = P.survey_answers(spark, sf)
    return U.union_frames(a.select("understood", "rating", "trust"), a.select("understood", "decision"))


@query(
    "drop_all_null",
    WIDE + "SELECT customer_id, savings_rate, monthly_income FROM ec WHERE savings_rate IS NOT NULL OR monthly_income IS NOT NULL",
)
def drop_all_null(spark, sf):
    rows = P.customer_attributes(spark, sf, ["savings_rate", "monthly_income"])
    return U.drop_all_null(rows, ["savings_rate", "monthly_income"]).select("customer_id", "savings_rate", "monthly_income")


@query("drop_empty_columns", with_(HISTORY) + "SELECT prediction_id, risk_score FROM ph")
def drop_empty_columns_query(spark, sf):
    rows = P.prediction_history(spark, sf).select(
        "prediction_id", "risk_score", F.lit(None).cast("string").alias("explanation_version")
    )
    return drop_empty_columns(rows)


@query("scan_raw_events", "SELECT event_id, user_id AS customer_id, event_type, value AS event_value, ts AS event_time FROM events")
def scan_raw_events(spark, sf):
    return P.raw_events(spark, sf)


_GAP_HOURS = 36


@query(
    "event_sessions",
    f"""WITH e AS (SELECT user_id AS customer_id, ts, value, CASE WHEN ts - lag(ts) OVER w <= INTERVAL {_GAP_HOURS} HOUR THEN 0 ELSE 1 END AS first
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(first) OVER (PARTITION BY customer_id ORDER BY ts) AS n FROM e)
SELECT customer_id, min(ts) AS started_at, max(ts) AS last_at, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS total_value
FROM s GROUP BY customer_id, n""",
)
def event_sessions(spark, sf):
    """Events arrive in three files, every tenth of them twice; after each the stream runs on. A heartbeat closes what is open."""
    events = P.raw_events(spark, sf)
    span = events.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).first()
    step, time = (span.hi - span.lo) / 3, F.col("event_time")
    source, stream = S.scratch_path(spark, "events"), EventSessions.fresh(spark, f"{_GAP_HOURS} hours", "2 hours")
    arrived = spark.readStream.schema(events.schema)
    for i in range(3):
        low, high = span.lo + step * i, span.lo + step * (i + 1)
        part = events.where((time >= F.lit(low)) if i else F.lit(True)).where((time < F.lit(high)) if i < 2 else F.lit(True))
        part.unionByName(part.where("event_id % 10 = 0")).write.mode("append").parquet(source)
        stream.run(arrived.parquet(source))
    end = heartbeat(spark, str(span.hi + timedelta(days=30)))
    end.select(*[F.col(f.name).cast(f.dataType) for f in events.schema]).write.mode("append").parquet(source)
    stream.run(arrived.parquet(source))
    return stream.read(spark)


@query("distinct_ids", "SELECT DISTINCT o_custkey AS customer_id FROM orders")
def distinct_ids(spark, sf):
    return L.distinct_ids(P.prediction_history(spark, sf))
