"""As-of joins: every row with the newest row of another frame at or before its own time.

Both sides are laid together, range partitioned by key and time and written once, so a hot key, or a
hot moment of one, is cut into as many parts as it needs. Inside a part the last value seen is a running
last over the order. A part can only owe its first key a value from before, so the carry is one row per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.sources.store import materialise

_KEY, _TIME, _SIDE, _TIE, _SPREAD, _SLOT, _ROW, _SEEN = "_key", "_time", "_side", "_tie", "_spread", "_slot", "_row", "_seen"


def asof_join(
    left: DataFrame, right: DataFrame, time: str, right_time: str, values: Sequence[str], by: Sequence[str] = (), tie: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``left`` with the ``values`` of the newest ``right`` row of the same ``by`` whose time is not later; null where there is none.

    Of right rows of one key and time the one with the largest ``tie`` counts; ``by`` names columns of both sides, none makes
    one sequence of everything. Missing keys and times match nothing: such left rows come out with null
    values. Every left row comes out once, repeated ones too. Rows are shuffled once whatever the number of right rows per left one.
    """
    clash = [v for v in values if v in left.columns]
    if clash:
        raise ValueError(f"columns exist on the left: {clash}")
    parts = parts or max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0))
    known = [F.col(c).isNotNull() for c in [*by, right_time]]
    found = right.where(_all(known)).select(
        key.alias(_KEY), F.col(right_time).alias(_TIME), F.lit(0).alias(_SIDE), F.col(tie).alias(_TIE) if tie else F.lit(0).alias(_TIE),
        F.lit(0).cast("long").alias(_SPREAD), F.struct(*values).alias(_SEEN),
    )
    asked = left.select(
        key.alias(_KEY), F.col(time).alias(_TIME), F.lit(1).alias(_SIDE), F.lit(None).cast(found.schema[_TIE].dataType).alias(_TIE),
        F.xxhash64(*left.columns).alias(_SPREAD), F.struct(*left.columns).alias(_ROW),
    )
    order = [_TIME, _SIDE, _TIE]
    laid = found.unionByName(asked, allowMissingColumns=True)
    # The hash of the row ends the order, so that equal moments of one key can be cut as well.
    dealt = laid.repartitionByRange(parts, _KEY, *order, _SPREAD).withColumn(_SLOT, F.spark_partition_id())
    rows = materialise(dealt, "asof")
    here = Window.partitionBy(_SLOT, _KEY).orderBy(*order, _SPREAD).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn(_SEEN, F.last(_SEEN, ignorenulls=True).over(here)).where(F.col(_SIDE) == 1)
    carried = F.broadcast(_carry(rows))  # one row per part
    owed = F.when(F.col(_KEY).eqNullSafe(F.col("_first")), F.col("_carried"))
    out = seen.join(carried, _SLOT, "left").withColumn(_SEEN, F.coalesce(_SEEN, owed))
    return out.select(f"{_ROW}.*", *[F.when(F.col(_TIME).isNotNull(), F.col(f"{_SEEN}.{v}")).alias(v) for v in values])


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _carry(rows: DataFrame) -> DataFrame:
    """Per part its first key and the last value that earlier parts saw for it: one row per part."""
    place = F.struct(_KEY, _TIME, _TIE)
    parts = rows.groupBy(_SLOT).agg(
        F.min(_KEY).alias("_first"), F.max(_KEY).alias("_last"),
        F.max(F.when(F.col(_SIDE) == 0, place)).alias("_newest"), F.max_by(F.when(F.col(_SIDE) == 0, F.col(_SEEN)), F.when(F.col(_SIDE) == 0, place)).alias("_end"),
    )
    # A part asks for its first key, then offers what it saw last of its last key.
    end = F.when(F.col(f"_newest.{_KEY}").eqNullSafe(F.col("_last")), F.col("_end"))
    asks = parts.select(_SLOT, F.lit(0).alias("_turn"), F.col("_first").alias("_of"), F.lit(None).cast(parts.schema["_end"].dataType).alias("_value"))
    offers = parts.select(_SLOT, F.lit(1).alias("_turn"), F.col("_last").alias("_of"), end.alias("_value"))
    before = Window.partitionBy("_of").orderBy(_SLOT, "_turn").rowsBetween(Window.unboundedPreceding, -1)
    told = asks.unionByName(offers).withColumn("_carried", F.last("_value", ignorenulls=True).over(before))
    return told.where("_turn = 0").select(_SLOT, F.col("_of").alias("_first"), "_carried")


def active_at(df: DataFrame, activations: DataFrame, time: str, fallback: str | None = K.UNKNOWN_MODEL) -> DataFrame:
    """Rows stamped with the model that was active at their own time; before the first activation the fallback or (``None``) an error.

    ``activations``: activated_at, model_version. Of models activated at one moment the highest version counts.
    """
    stamped = asof_join(df, activations, time, "activated_at", ["model_version"], tie="model_version")
    missing = F.raise_error("no active model in the registry at the time of a row") if fallback is None else F.lit(fallback)
    return stamped.withColumn("model_version", F.coalesce("model_version", missing.cast("string")))


def activation_periods(activations: DataFrame) -> DataFrame:
    """Each activation with the time of the next one, null for the model active now: the registry's own history.

    The log has a row per activation, an act of an operator, so one ordered window over it is small.
    """
    order = Window.orderBy("activated_at", "model_version")
    return activations.withColumn("ended_at", F.lead("activated_at").over(order))
