"""Exact quantiles and ranks that never gather a whole column in one task.

Quantiles are found by selection. Sketches, which merge, name a narrow bracket of values around every wanted place; a second pass
counts what lies below and inside each; a third fetches the few values inside. A bracket that missed its place is
widened, one that holds too many values gets a sketch of its own. So the answer is exact, and nothing but sketches and
counts is shuffled.

Ranks need the place of every value: columns are reduced to (column, value, count) before any shuffle, range partitioned by
column and value and written once, all columns together. Counts per written part give
each part its offset, a running sum inside each part gives every value its position.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import dbl
from riskloom.sources.store import materialise


@dataclass(frozen=True)
class Positions:
    """``rows`` (name, value, n, before): the distinct values of columns, how often each occurs and how many values are smaller;
    ``totals``: the number of values per column."""

    rows: DataFrame
    totals: dict[str, int]

    def of(self, name: str) -> DataFrame:
        return self.rows.where(F.col("name") == name).drop("name")


def column_positions(df: DataFrame, columns: list[str], weight: str | None = None, parts: int | None = None) -> Positions:
    """Positions of the values of several columns in one pass.

    A value held by a third of the rows is one row here, so no part is hot. Missing values
    and NaN have no position. ``weight`` names a column of row counts where ``df`` is already grouped.
    """
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    counted = (
        df.select(F.inline(values), (F.col(weight) if weight else F.lit(1)).alias("rows"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("name", "value")
        .agg(F.sum("rows").alias("n"))
        .repartitionByRange(parts, "name", "value")
        .withColumn("part", F.spark_partition_id())
    )
    stored = materialise(counted, "positions")
    # At most ``parts`` rows more than there are columns.
    sizes = stored.groupBy("name", "part").agg(F.sum("n").alias("rows")).collect()
    totals, offsets = dict.fromkeys(columns, 0), []
    for r in sorted(sizes, key=lambda r: (r.name, r.part)):
        offsets.append((r.name, r.part, totals[r.name]))
        totals[r.name] += r.rows
    starts = df.sparkSession.createDataFrame(offsets, "name string, part int, offset long")
    within = Window.partitionBy("name", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        stored.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(starts), ["name", "part"])
        .select("name", "value", "n", (F.col("offset") + F.col("inside")).alias("before"))
    )
    return Positions(rows, totals)


def value_positions(df: DataFrame, column: str, parts: int | None = None, weight: str | None = None) -> Positions:
    return column_positions(df, [column], weight, parts)


def places(total: int, probability: float) -> tuple[int, int, float]:
    """The two positions that a linear-interpolation quantile lies between, and where."""
    at = max(total - 1, 0) * probability
    return math.floor(at), math.ceil(at), at


def interpolated(low: float | None, high: float | None, at: float) -> float | None:
    lo, hi = math.floor(at), math.ceil(at)
    return low if low is None or lo == hi or low == high else (hi - at) * low + (at - lo) * high


def values_at(positions: Positions, picks: set[tuple[str, int]]) -> dict[tuple[str, int], float | None]:
    """The values that stand at given places (from 0) of columns: one aggregate of one row."""
    keys = sorted(picks)
    covers = [(F.col("name") == c) & (F.col("before") <= k) & (F.col("before") + F.col("n") > k) for c, k in keys]
    return dict(zip(keys, positions.rows.agg(*[F.max(F.when(x, F.col("value"))).alias(f"at_{i}") for i, x in enumerate(covers)]).first()))


def quantile_values(positions: Positions, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Linear-interpolation quantiles: name -> (column, probability) gives name -> number."""
    spots = {name: (column, *places(positions.totals[column], p)) for name, (column, p) in wanted.items()}
    found = values_at(positions, {(c, k) for c, lo, hi, _ in spots.values() for k in (lo, hi)})
    return {name: interpolated(found[c, lo], found[c, hi], at) for name, (c, lo, hi, at) in spots.items()}


#: Ranks by which a sketch may be wrong, as a share of the values; and values of one bracket that are fetched.
ACCURACY, FEW = 10_000, 10_000


@dataclass
class _Bracket:
    """Where the value at a place (from 0) of a column is looked for: from ``low`` to ``high``, open ended where infinite."""

    column: str
    place: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    counted: bool = False
    found: float | None = None


def _inside(column: str, b: _Bracket) -> Column:
    return (F.col(column) > dbl(b.low)) & (F.col(column) < dbl(b.high))


def _settle(b: _Bracket, below: int, at_low: int, inside: int, at_high: int) -> None:
    """What counts say of a bracket: found at an end, missed and to be widened, or to be searched between its ends."""
    if b.place < below:
        b.low, b.high = -math.inf, b.low
    elif b.place < below + at_low:
        b.found = b.low
    elif b.place < below + at_low + inside:
        b.below, b.inside, b.counted = below + at_low, inside, True
    elif b.place < below + at_low + inside + at_high:
        b.found = b.high
    else:
        b.low, b.high = b.high, math.inf


def _sketched(value: Column, shares: Sequence[float]) -> Column:
    """Values near the given shares of a column, a little below and above each."""
    off = 2.0 / ACCURACY
    return F.percentile_approx(value, [min(1.0, max(0.0, p + d)) for p in shares for d in (-off, off)], ACCURACY)


def select_places(df: DataFrame, brackets: list[_Bracket], few: int = FEW) -> None:
    """Find the values of brackets over a frame of doubles without NaN; each pass is one aggregate."""
    while True:
        unknown = [b for b in brackets if b.found is None and not b.counted]
        if unknown:
            aggregates = []
            for i, b in enumerate(unknown):
                v = F.col(b.column)
                parts = {"b": v < dbl(b.low), "l": v == dbl(b.low), "i": _inside(b.column, b), "h": (v == dbl(b.high)) & F.lit(b.high > b.low)}
                aggregates += [F.count_if(condition).alias(f"{k}{i}") for k, condition in parts.items()]
            row = df.agg(*aggregates).first()
            for i, b in enumerate(unknown):
                _settle(b, row[f"b{i}"], row[f"l{i}"], row[f"i{i}"], row[f"h{i}"])
            continue
        wide = [b for b in brackets if b.found is None and b.inside > few]
        if not wide:
            break
        row = df.agg(*[_sketched(F.when(_inside(b.column, b), F.col(b.column)), [(b.place - b.below) / b.inside]).alias(f"s{i}") for i, b in enumerate(wide)]).first()
        for i, b in enumerate(wide):
            b.low, b.high, b.counted = *row[f"s{i}"], False
    left = [b for b in brackets if b.found is None]
    if left:
        held = F.array(*[F.struct(F.lit(i).alias("bracket"), F.when(_inside(b.column, b), F.col(b.column)).alias("value")) for i, b in enumerate(left)])
        some = df.where(F.exists(F.array(*[F.coalesce(_inside(b.column, b), F.lit(False)) for b in left]), lambda x: x))
        counts = some.select(F.inline(held)).where("value is not null").groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("n"))
        by: dict[int, list[tuple[float, int]]] = {}
        for r in counts.collect():  # at most ``few`` rows for each bracket
            by.setdefault(r.bracket, []).append((r.value, r.n))
        for i, b in enumerate(left):
            at = b.below
            for value, n in sorted(by[i]):
                at += n
                if b.place < at:
                    b.found = value
                    break


def selected_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], few: int = FEW) -> dict[str, float | None]:
    """Linear-interpolation quantiles by selection: name -> (column, probability) gives name -> number.

    ``df`` is read a few times. Missing values and NaN are left out; a column without values has no quantiles.
    """
    columns = sorted({c for c, _ in wanted.values()})
    shares = {c: sorted({p for x, p in wanted.values() if x == c}) for c in columns}
    value = {c: F.col(c).cast("double") for c in columns}
    known = df.select(*[F.when(~F.isnan(value[c]), value[c]).alias(c) for c in columns])
    row = known.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)], *[_sketched(F.col(c), shares[c]).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    spots: dict[str, tuple[str, int, int, float]] = {}
    brackets: dict[tuple[str, int], _Bracket] = {}
    for name, (c, p) in wanted.items():
        total, ends = row[f"n{columns.index(c)}"], row[f"s{columns.index(c)}"]
        if total:
            spots[name] = (c, *places(total, p))
            at = 2 * shares[c].index(p)
            for k in spots[name][1:3]:
                brackets.setdefault((c, k), _Bracket(c, k, ends[at], ends[at + 1]))
    select_places(known, list(brackets.values()), few)
    return {
        name: interpolated(brackets[spots[name][0], spots[name][1]].found, brackets[spots[name][0], spots[name][2]].found, spots[name][3]) if name in spots else None
        for name in wanted
    }


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], weight: str | None = None) -> dict[str, Column]:
    """Exact quantiles: name -> (column, probability) gives name -> constant column for use in any plan.

    All columns share each pass, and ``df`` is read a few times: pass a stored frame when it is costly to make. ``weight`` names a column of row
    counts where ``df`` is already grouped; such small frames are positioned instead.
    """
    if weight is None:
        values = selected_quantiles(df, wanted)
    else:
        values = quantile_values(column_positions(df, sorted({c for c, _ in wanted.values()}), weight), wanted)
    return {name: F.lit(v).cast("double") for name, v in values.items()}


def with_percent_rank(df: DataFrame, column: str, out: str, known: Positions | None = None, ends: tuple[float, ...] = ()) -> DataFrame:
    """Average rank of ties over the number of values; rows without a value get none.

    ``ends`` are values that very many rows may share, such as the limits of a clipped score: their ranks are
    constants of the plan, so these rows stay where they are and only the others are joined.
    """
    known = known or value_positions(df, column)
    total = dbl(float(max(1, known.totals[column])))
    ranks = known.of(column).select(
        F.col("value").alias("_value"), ((F.col("before") + (F.col("n") + 1) / dbl(2.0)) / total).alias(out)
    )
    value = F.col(column).cast("double")
    if not ends:
        return df.join(ranks, value == F.col("_value"), "left").drop("_value")
    found = ranks.agg(*[F.max(F.when(F.col("_value") == e, F.col(out))).alias(f"e{i}") for i, e in enumerate(ends)]).first()
    fixed = F.lit(None).cast("double")
    for i, e in enumerate(ends):
        fixed = F.when(value == e, F.lit(found[i]).cast("double")).otherwise(fixed)
    rest = F.coalesce(value.isin(list(ends)), F.lit(True)) | F.isnan(value)
    joined = df.where(~rest).join(ranks, value == F.col("_value"), "left").drop("_value")
    return joined.unionByName(df.where(rest).withColumn(out, fixed))


def with_global_position(df: DataFrame, order: list[Column], parts: int | None = None) -> tuple[DataFrame, Column]:
    """Rows with their place (from 1) in a total order, and the number of rows as a scalar column.

    ``order`` must be unique, so ranges can cut through ties. Rows are range
    partitioned, sorted inside their part and written once with part and place.
    """
    spark = df.sparkSession
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    mask = (1 << 33) - 1
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(mask)))
    )
    stored = materialise(placed, "ordered")
    totals = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))  # at most ``parts`` rows
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    out = stored.join(F.broadcast(offsets), "_part").withColumn("position", F.col("_offset") + F.col("_place") + 1)
    return out.drop("_part", "_place", "_offset"), stored.agg(F.count(F.lit(1))).scalar()


def ntile_of(position: Column, total: Column, tiles: int) -> Column:
    """Tile of a place: the first ``total % tiles`` tiles hold one row more."""
    size, extra = F.floor(total / F.lit(tiles)).cast("bigint"), total % F.lit(tiles)
    head = extra * (size + 1)
    return (
        F.when(position <= head, F.ceil(position / (size + 1)))
        .otherwise(extra + F.ceil(F.try_divide(position - head, size)))
        .cast("int")
    )
