"""Tables kept in buckets of a key, so that joins on it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Write a catalogue table in sorted buckets of a key, and read it.

    The rows are shuffled once, here, so every bucket is one sorted file. Tables with the same number of buckets
    meet in a sort-merge join without an exchange, as often as they are joined. ``buckets`` is chosen for the largest
    of them: a bucket is read by one task. A null key has a bucket like any other.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("errorifexists").saveAsTable(table)
    return df.sparkSession.table(table)
