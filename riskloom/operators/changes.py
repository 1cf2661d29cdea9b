"""Change detection over ordered updates of customers, safe for hot customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.sources.store import materialise


def last_scores(updates: DataFrame) -> DataFrame:
    """Newest event and its score per customer: a two-step aggregate."""
    newest = F.max(F.struct("event_time", "event_id", "risk_score")).alias("last")
    return updates.groupBy("customer_id").agg(newest).select(
        "customer_id", F.col("last.risk_score").alias("last_score"), "last.event_time", "last.event_id"
    )


def change_log(updates: DataFrame, known: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Updates whose score differs, null-safe, from the update before; the first one of a new customer is an insert.

    ``updates``: customer_id, event_id, event_time, risk_score. ``known``: last_score
    per customer from earlier data. The updates are range partitioned by customer and
    time and written once, so a hot customer, or a hot hour of one, is cut into as many
    parts as it needs. Neighbours are compared inside a part; the first row of a
    customer in a part takes its predecessor from one summary row per customer and part.
    """
    parts = parts or max(2, int(updates.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["customer_id", "event_time", "event_id"]
    rows = materialise(updates.repartitionByRange(parts, *order).withColumn("slot", F.spark_partition_id()), "updates")
    inside = Window.partitionBy("customer_id", "slot").orderBy("event_time", "event_id")
    rows = rows.withColumns({"inner": F.lag(F.struct("risk_score")).over(inside)})
    ends = rows.groupBy("customer_id", "slot").agg(
        F.max_by(F.struct("risk_score"), F.struct("event_time", "event_id")).alias("end")
    )
    before = F.lag("end").over(Window.partitionBy("customer_id").orderBy("slot"))
    starts = ends.select("customer_id", "slot", before.alias("carried"))
    if known is not None:
        starts = starts.join(
            known.select("customer_id", F.struct(F.col("last_score").alias("risk_score")).alias("known")), "customer_id", "left"
        ).select("customer_id", "slot", F.coalesce("carried", "known").alias("carried"))
    previous = F.coalesce("inner", "carried")
    joined = rows.join(starts, ["customer_id", "slot"], "left").withColumn("previous", previous)
    first = F.col("previous").isNull()
    same = F.col("risk_score").eqNullSafe(F.col("previous.risk_score"))
    return joined.where(first | ~same).select(
        "customer_id",
        "event_id",
        "event_time",
        "risk_score",
        F.col("previous.risk_score").alias("previous_score"),
        F.when(first, "INSERT").otherwise("UPDATE").alias("change"),
        F.lit(K.TRIGGER_MODEL).alias("model_version"),
        F.lit(K.STAMP_TRIGGER).alias("created_by"),
        F.lit(K.TRIGGER_DATASET).alias("dataset_version"),
    )
