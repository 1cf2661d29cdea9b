"""Change log over a stream of feature updates.

Every micro-batch is an ordinary batch job: its updates are compared with each
other and with the last known score of their customers. Log and state of a batch
go to a folder named by the batch number, written with overwrite, so a batch that
runs again after a failure replaces its own output and nothing is logged twice.

The state is a log per bucket of customers: a batch writes the newest events of its customers, split into
buckets by a hash of the customer, and reads the buckets of its customers only. An index per batch
names the batches whose files make up each bucket. A bucket with many of them is written whole
by the next batch that touches it, so no batch ever copies the state of all customers.

Order is that of (event_time, event_id), inside a batch and between batches: the state
keeps the newest event of every customer. An update that is not newer than what
earlier batches brought is late. It is logged as LATE beside the newest score and moves no state.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom import constants as K
from riskloom.operators.changes import change_log, last_scores
from riskloom.sources.store import materialise, path_exists, read_text, remove_path, scratch_path, write_text

#: Buckets of the state, fixed for a stream, and the most batches that make up one before it is written whole.
#: Few suit a small table; a stream over very many customers is given as many as keep a bucket to some hundred MB.
BUCKETS, LONGEST = 16, 10
STATE_SCHEMA = "customer_id bigint, last_score double, event_time timestamp_ntz, event_id bigint"

Index = dict[int, list[int]]


def bucket_of(customer: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(buckets)).cast("int")


def _newest(rows: DataFrame) -> DataFrame:
    newest = F.max(F.struct("event_time", "event_id", "last_score")).alias("s")
    return rows.groupBy("customer_id").agg(newest).select("customer_id", "s.last_score", "s.event_time", "s.event_id")


@dataclass(frozen=True)
class AuditStream:
    """Where one stream keeps its log, its state and its progress; ``buckets`` must stay what it was at the start."""

    log_path: str
    state_path: str
    checkpoint_path: str
    buckets: int = BUCKETS

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int = BUCKETS) -> AuditStream:
        return cls(*[scratch_path(spark, f"audit-{part}") for part in ("log", "state", "checkpoint")], buckets)

    def _index_path(self, batch: int) -> str:
        return f"{self.state_path}/index/batch={batch}.json"

    def index_after(self, spark: SparkSession, batch: int) -> Index:
        """Per bucket the batches that make up its state after a batch; state that should be there and is not is an error."""
        if batch < 0:
            return {}
        if not path_exists(spark, self._index_path(batch)):
            raise RuntimeError(f"the state of batch {batch} is missing below {self.state_path}")
        return {int(b): batches for b, batches in json.loads(read_text(spark, self._index_path(batch))).items()}

    def state(self, spark: SparkSession, index: Index, buckets: list[int]) -> DataFrame:
        """Newest event per customer of some buckets; only their files are read."""
        held = [(b, batch) for b in buckets for batch in index.get(b, [])]
        folders = [f"{self.state_path}/batch={batch}/bucket={b}" for b, batch in held]
        for (b, batch), folder in zip(held, folders):
            if not path_exists(spark, folder):
                raise RuntimeError(f"the state of batch {batch} is missing in bucket {b} below {self.state_path}")
        if not folders:
            return spark.createDataFrame([], STATE_SCHEMA)
        return _newest(spark.read.schema(STATE_SCHEMA).parquet(*folders))

    def known_before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Newest event per customer after the batches before this one."""
        return self.state(spark, self.index_after(spark, batch_id - 1), list(range(self.buckets)))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = self.index_after(spark, batch_id - 1)
        updates = materialise(batch.withColumn("bucket", bucket_of(F.col("customer_id"), self.buckets)), "batch")
        touched = sorted(r[0] for r in updates.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        updates = updates.drop("bucket")
        if any(b in index for b in touched):
            ids = updates.select("customer_id").distinct()
            known = materialise(self.state(spark, index, touched).join(ids, "customer_id", "left_semi"), "known")
            seen = known.select("customer_id", "last_score", F.struct("event_time", "event_id").alias("newest"))
            is_late = F.coalesce(F.struct("event_time", "event_id") <= F.col("newest"), F.lit(False))
            met = materialise(updates.join(seen, "customer_id", "left").withColumn("late", is_late), "met")
            fresh = met.where(~F.col("late")).select(*updates.columns)
            marks = {"previous_score": F.col("last_score"), "change": F.lit("LATE"), "model_version": F.lit(K.TRIGGER_MODEL)}
            marks |= {"created_by": F.lit(K.STAMP_TRIGGER), "dataset_version": F.lit(K.TRIGGER_DATASET)}
            log = change_log(fresh, known)
            log = log.unionByName(met.where("late").withColumns(marks).select(*log.columns))
        else:
            fresh, log = updates, change_log(updates)
        log.write.mode("overwrite").parquet(f"{self.log_path}/batch={batch_id}")
        self._remember(spark, batch_id, index, last_scores(fresh), touched)

    def _remember(self, spark: SparkSession, batch_id: int, index: Index, last: DataFrame, touched: list[int]) -> None:
        """Write the batch's part of the state and the index, then remove what the index before the last one needed alone."""
        full = [b for b in touched if len(index.get(b, [])) >= LONGEST]
        bucket = bucket_of(F.col("customer_id"), self.buckets)
        if full:
            rest = self.state(spark, index, full).join(last.select("customer_id"), "customer_id", "left_anti")
            last = last.unionByName(rest)
        folder = f"{self.state_path}/batch={batch_id}"
        last.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = {b for b in touched if path_exists(spark, f"{folder}/bucket={b}")}
        new = index | {b: [batch_id] if b in full else [*index.get(b, []), batch_id] for b in written}
        write_text(spark, self._index_path(batch_id), json.dumps(new))
        # A batch that runs again starts from the index before it: only older ones may lose their files.
        older = self._index_path(batch_id - 2)
        if path_exists(spark, older):
            used = {(b, at) for b, batches in index.items() for at in batches}
            for b, batches in self.index_after(spark, batch_id - 2).items():
                for at in batches:
                    if (b, at) not in used:
                        remove_path(spark, f"{self.state_path}/batch={at}/bucket={b}")
            remove_path(spark, older)

    def run(self, updates: DataFrame) -> None:
        """Process all updates that have arrived, then stop; the next run goes on from there."""
        query = (
            updates.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.log_path).drop("batch")


def read_updates(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files of updates as a stream, in order of arrival."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
