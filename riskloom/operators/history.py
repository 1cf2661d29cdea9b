"""Latest rows per customer and small ordered reports over event and prediction history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.bands import band_api
from riskloom.functions.numeric import dbl


def newest_per_customer(df: DataFrame, time: str, key: str, n: int) -> DataFrame:
    """Newest ``n`` rows per customer with their place.

    The place filter lets Spark keep ``n`` rows per customer in every map task
    before the shuffle, so a hot customer sends at most ``n`` rows per task.
    """
    order = Window.partitionBy("customer_id").orderBy(F.desc(time), F.desc(key))
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def prediction_history(history: DataFrame, n: int = 50) -> DataFrame:
    """Newest ``n`` predictions per customer, band computed anew from the stored score, with the number returned."""
    score = F.coalesce(F.col("risk_score"), dbl(0.0))
    rows = newest_per_customer(history, "prediction_time", "prediction_id", n)
    records = F.count(F.lit(1)).over(Window.partitionBy("customer_id"))
    return rows.select(
        "customer_id",
        "prediction_id",
        score.alias("predicted_risk_score"),
        "original_band",
        band_api(score).getField("band").alias("predicted_band"),
        F.coalesce("model_version", F.lit("")).alias("model_version"),
        "feature_version",
        "dataset_version",
        "prediction_time",
        "created_by",
        records.alias("total_records"),
    )


def recent_audit(history: DataFrame, n: int = 5) -> DataFrame:
    return history.orderBy(F.desc("prediction_time"), F.desc("prediction_id")).limit(n)


def random_row(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One row picked by a seeded hash of its key: a top-1, no sort of the table."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))).limit(1)
