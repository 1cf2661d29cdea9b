"""Sessions of customers from a stream of raw events, by event time.

Events may come late, up to a delay, and more than once. The watermark trails the newest event by the delay: an event is
taken once within it, a session is complete when the watermark has passed its end, and then it is appended to the
output and leaves the state, so the state holds open sessions and recent event ids only. Events
older than the watermark are counted, batch by batch, beside the sessions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.sources.store import path_exists, scratch_path

#: Type of the rows that only move the watermark on.
HEARTBEAT = "heartbeat"
EVENTS = "event_id bigint, customer_id bigint, event_type string, event_value double, event_time timestamp_ntz"
LATE = "run bigint, batch bigint, rows bigint"


@dataclass(frozen=True)
class EventSessions:
    """Where one stream keeps its sessions, its count of late events and its progress."""

    sessions_path: str
    late_path: str
    checkpoint_path: str
    gap: str = "30 minutes"
    delay: str = "1 hour"

    @classmethod
    def fresh(cls, spark: SparkSession, gap: str = "30 minutes", delay: str = "1 hour") -> EventSessions:
        return cls(*[scratch_path(spark, f"sessions-{part}") for part in ("out", "late", "checkpoint")], gap, delay)

    def sessions(self, events: DataFrame) -> DataFrame:
        """Sessions (customer_id, started_at, last_at, events, total_value) of an event stream with a watermark of its own."""
        # Watermarks need instants; event times without a zone are taken as UTC and given back without one.
        timed = events.withColumn("event_time", F.col("event_time").cast("timestamp")).withWatermark("event_time", self.delay)
        once = timed.dropDuplicatesWithinWatermark(["event_id"])
        window = F.session_window("event_time", self.gap)
        grouped = once.where(F.col("event_type") != HEARTBEAT).groupBy("customer_id", window).agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(F.coalesce(F.col("event_value"), F.lit(0)).cast("decimal(28,6)")).cast("double").alias("total_value"),
            F.max("event_time").cast("timestamp_ntz").alias("last_at"),
        )
        return grouped.select("customer_id", F.col("session_window.start").cast("timestamp_ntz").alias("started_at"), "last_at", "events", "total_value")

    def run(self, events: DataFrame) -> int:
        """Process all events that have arrived, then stop, and say how many came too late; the next run goes on from there."""
        spark = events.sparkSession
        query = (
            self.sessions(events)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", self.sessions_path)
            .option("checkpointLocation", self.checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        late = []
        for progress in query.recentProgress:
            rows = sum(int(s["numRowsDroppedByWatermark"]) for s in progress["stateOperators"])
            if rows:
                late.append((progress["batchId"], rows))
        if late:
            runs = self.late(spark).agg(F.max("run")).first()[0]
            marked = [(0 if runs is None else runs + 1, batch, rows) for batch, rows in late]
            spark.createDataFrame(marked, LATE).coalesce(1).write.mode("append").parquet(self.late_path)
        return sum(rows for _, rows in late)

    def late(self, spark: SparkSession) -> DataFrame:
        """Events that came after the watermark had passed them, per run and micro-batch."""
        return spark.read.schema(LATE).parquet(self.late_path) if path_exists(spark, self.late_path) else spark.createDataFrame([], LATE)

    def read(self, spark: SparkSession) -> DataFrame:
        """The complete sessions; only those of finished micro-batches."""
        names = "customer_id bigint, started_at timestamp_ntz, last_at timestamp_ntz, events bigint, total_value double"
        return spark.read.schema(StructType.fromDDL(names)).parquet(self.sessions_path)


def heartbeat(spark: SparkSession, at: str, number: int = -1) -> DataFrame:
    """A row that moves the watermark on to its time less the delay, as a source without traffic sends from time to time.

    ``number`` is an event id that no event has.
    """
    return spark.createDataFrame([(number, None, HEARTBEAT, None, at)], EVENTS.replace("timestamp_ntz", "string")).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    )
