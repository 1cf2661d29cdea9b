"""Gapless places inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.sources.store import materialise


def with_slot(df: DataFrame, *group: str, name: str = "slot") -> DataFrame:
    """Add the place of each row in its group, 0, 1, 2 and so on without gaps.

    Every task sorts the rows it has by group and writes them with its own number and their places in it. A slot is
    the group's rows in earlier tasks plus the place after the group's first row in the own task. So no row is
    shuffled, however large a group or equal its rows are; only counts per group and task are, and they are
    summed up per group and joined back. Rows with a null group value form a group.
    """
    part, place, first, rows = fresh(df, "part", "place", "first", "rows")
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = materialise(df.sortWithinPartitions(*group).withColumn(part, F.spark_partition_id()).withColumn(place, low), "slots")
    keys = [*group, part]
    counts = stored.groupBy(*keys).agg(F.count("*").alias(rows), F.min(place).alias(first))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(rows).over(earlier), F.lit(0))
    # Written, so that Spark knows its size, a row per group and task, before it plans the join.
    starts = materialise(counts.select(*keys, (before - F.col(first)).alias(first)), "slot_starts")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = stored.alias("a").join(starts.alias("b"), same)
    return joined.select(*[F.col(f"a.{c}") for c in df.columns], (F.col(f"a.{place}") + F.col(f"b.{first}")).cast("long").alias(name))
