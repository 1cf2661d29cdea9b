"""Load steps: upserts, staging gate, promotion, rebuild and stored predictions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import dbl, sigmoid
from riskloom.sources.published import publish
from riskloom.sources.store import path_exists

RESILIENCE = K.FEATURES[2]
MIN_RESILIENCE = 1.0

FEATURE_SCHEMA = (
    "customer_id int, payment_discipline_score double, income_stability_index double, "
    "financial_resilience_score double, risk_score double, risk_band string, created_at timestamp"
)


def load_features(spark: SparkSession, table: str) -> DataFrame:
    """Key and features of a table or view that must exist."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    return spark.table(table).select("customer_id", *K.FEATURES)


def distinct_ids(df: DataFrame, key: str = "customer_id") -> DataFrame:
    return df.select(key).distinct()


def upsert_do_nothing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target plus the new keys of the source; known keys are left alone."""
    new = source.select(key).where(F.col(key).isNotNull()).distinct().join(target.select(key), key, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def upsert_do_update(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target with source rows inserted or replacing the columns they carry.

    A key that occurs twice in the source is an error. The check rides on the
    aggregate that partitions the source by key, so it adds no shuffle.
    """
    carried = [c for c in source.columns if c != key]
    once = source.groupBy(key).agg(F.any_value(F.struct(*carried)).alias("new"), F.count(F.lit(1)).alias("times"))
    checked = once.select(
        F.col(key).alias("_key"),
        F.when(F.col("times") == 1, F.col("new")).otherwise(F.raise_error("a key occurs twice in one batch")).alias("new"),
    )
    joined = target.join(checked, F.col(key) == F.col("_key"), "full_outer")
    came = F.col("_key").isNotNull()
    out: list[Column] = [F.coalesce(F.col(key), F.col("_key")).alias(key)]
    for c in target.columns:
        if c != key:
            out.append(F.when(came, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in carried else F.col(c))
    return joined.select(*out)


def rescale_staged(staged: DataFrame) -> DataFrame:
    """Staged features with a known band; scores above 1 are percentages; the band is left open."""
    score = F.col("risk_score")
    return staged.where(F.col("risk_band").isin("Low", "Medium", "High")).select(
        "customer_id",
        *K.FEATURES,
        F.when(score > 1.0, score / dbl(100.0)).otherwise(score).alias("risk_score"),
        F.lit(None).cast("string").alias("risk_band"),
    )


def touch_updated_at(df: DataFrame, run_ts: Column) -> DataFrame:
    """Stamp ``updated_at`` where the table has it."""
    return df.withColumn("updated_at", run_ts) if "updated_at" in df.columns else df


def _staging_facts() -> dict[str, Column]:
    """Rows staged and rows whose resilience is missing or at most the accepted minimum."""
    bad = F.col(RESILIENCE).isNull() | (F.col(RESILIENCE) <= MIN_RESILIENCE)
    return {"total_rows": F.count(F.lit(1)), "bad_rows": F.count_if(bad)}


def _accept_staging(facts: dict[str, Any]) -> None:
    if facts["total_rows"] == 0:
        raise ValueError("staging table is empty, promotion stopped")
    if facts["bad_rows"] > 0:
        raise ValueError(f"invalid {RESILIENCE} in {facts['bad_rows']} rows, promotion stopped")


def staging_counts(staged: DataFrame) -> DataFrame:
    """Rows staged and rows whose resilience is missing or at most the accepted minimum."""
    return staged.agg(*[c.alias(n) for n, c in _staging_facts().items()])


def validate_staging(staged: DataFrame) -> int:
    """Number of staged rows, or an error for an empty stage or bad resilience."""
    counts = staging_counts(staged).first().asDict()
    _accept_staging(counts)
    return counts["total_rows"]


def promote(staged: DataFrame, path: str) -> DataFrame:
    """Gate the stage and publish it as the production table, all or nothing, and read it back.

    One job writes the rows and counts them and the bad ones among them. Only a version that passes the gate is committed; until then, and
    after any failure, readers have the last one.
    """
    resilience = F.col(RESILIENCE)
    passed = staged.withColumn(RESILIENCE, F.when(resilience > MIN_RESILIENCE, resilience))
    production = passed.select("customer_id", *K.FEATURES, "risk_score", "risk_band")
    return publish(production, path, _staging_facts(), _accept_staging).read(staged.sparkSession)


def stored_predictions(df: DataFrame, run_ts: Column) -> DataFrame:
    """Batch predictions in history form: sigmoid score, default versions for columns that are absent."""
    required = ["customer_id", "risk_score", "original_band", "predicted_band"]
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    defaults = {"model_version": "offline", "feature_version": "v1", "dataset_version": "v1"}
    return df.select(
        "customer_id",
        sigmoid(F.col("risk_score").cast("double")).alias("risk_score"),
        "original_band",
        "predicted_band",
        *[F.col(c) if c in df.columns else F.lit(v).alias(c) for c, v in defaults.items()],
        run_ts.alias("prediction_time"),
        F.lit(K.STAMP_BATCH).alias("created_by"),
    )


def rebuild_features(spark: SparkSession, backup_path: str) -> DataFrame:
    """Feature store from a backup, or an empty one of the right types where there is no backup."""
    if path_exists(spark, backup_path):
        return spark.read.parquet(backup_path).select(
            "customer_id", *K.FEATURES, "risk_score", "risk_band", F.col("updated_at").alias("created_at")
        )
    return spark.createDataFrame([], FEATURE_SCHEMA)


def rebuild_normalise(score: Column) -> Column:
    """Scores forced into 0..1: NULL becomes 0; NaN sorts above every number and becomes 1."""
    return F.when(score.isNull() | (score < 0.0), dbl(0.0)).when(score > 1.0, dbl(1.0)).otherwise(score)


def model_metadata(spark: SparkSession, artefact_path: str, features: list[str], model_type: str, run_ts: str, feature_version: str, dataset_version: str) -> DataFrame:
    """Lineage record of a saved model: one SHA-256 over the digests of its files, versions, features, type."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(artefact_path)
    digests = files.select(F.sha2("content", 256).alias("digest"))
    joined = F.array_join(F.array_sort(F.collect_list("digest")), "")
    return digests.agg(F.sha2(joined, 256).alias("model_hash")).select(
        "model_hash",
        F.lit(run_ts).alias("trained_at"),
        F.lit(feature_version).alias("feature_version"),
        F.lit(dataset_version).alias("dataset_version"),
        F.array(*[F.lit(c) for c in features]).alias("features"),
        F.lit(model_type).alias("model_type"),
    )
