"""Mixing sources to target weights by fitting each source's budget as a subset sum.

Every source gets a budget of words. Whole passes over the source use up most of a budget that is larger than the source; what
remains is a subset sum over its documents. Documents are counted by exact length, so the problem is a
bounded knapsack over lengths: a proportional share of every length is taken first, until the remaining budget is short,
and dynamic programming over the lengths left closes it. Which documents of a length are
taken is decided by a seeded hash of their keys.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, fresh
from riskloom.sources.store import materialise

#: Words that the dynamic programme fits at least, and at most: its memory is five bytes a word.
ROOM, LARGEST_ROOM = 1 << 16, 1 << 24


def word_count(text: Column) -> Column:
    """Number of words; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# Fitting one budget


def closest_sum(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int) -> np.ndarray:
    """How many documents of each length make the sum closest to the budget: a bounded knapsack, exact up to ``limit``.

    The counts are cut to powers of two, each a piece taken or not. ``by`` holds the first piece that reached a sum, so the
    pieces of a sum are found by walking back, and no piece is met twice. Of two sums equally
    close the smaller one is made. It ends early once the budget itself is reached.
    """
    taken = np.zeros(len(lengths), np.int64)
    by = np.full(limit + 1, -1, np.int32)
    reached = np.zeros(limit + 1, bool)
    reached[0] = True
    pieces: list[tuple[int, int]] = []
    for at in range(len(lengths)):
        length, left, step = int(lengths[at]), min(int(counts[at]), limit // int(lengths[at])), 1
        while left and not reached[min(budget, limit)]:
            n = min(step, left)
            move = n * length
            new = reached[: limit + 1 - move] & ~reached[move:]
            by[move:][new] = len(pieces)
            reached[move:] |= new
            pieces.append((at, n))
            left, step = left - n, 2 * step
    sums = np.flatnonzero(reached)
    made = int(sums[np.argmin(np.abs(sums - budget))])
    while made:
        at, n = pieces[by[made]]
        taken[at] += n
        made -= n * int(lengths[at])
    return taken


def fit(lengths: Sequence[int], counts: Sequence[int], budget: int, room: int = ROOM) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to the budget as can be found.

    ``lengths`` are different and positive. A budget over ``room`` is first filled to ``room`` // 2 by a proportional
    share of every length, from the longest on; what rounding leaves over goes on to the shorter ones. The rest is ``closest_sum``.
    """
    order = np.argsort(lengths)[::-1]
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    taken = np.zeros(len(lengths), np.int64)
    words = sum(int(x) * int(n) for x, n in zip(lengths, counts))
    budget = max(0, min(int(budget), words))
    if budget > room:
        aim, carry = budget - room // 2, 0
        for at, (x, n) in enumerate(zip(lengths.tolist(), counts.tolist())):
            # The share aim / words of these n documents, in 1 / words of a word, so that no rounding enters.
            carry += n * x * aim
            taken[at] = min(n, carry // (x * words))
            carry -= int(taken[at]) * x * words
        short = aim - int((taken * lengths).sum())
        for at, (x, n) in enumerate(zip(lengths.tolist(), counts.tolist())):
            more = min(n - int(taken[at]), short // x)
            taken[at] += more
            short -= more * x
    left = budget - int((taken * lengths).sum())
    limit = min(max(room, 2 * left), LARGEST_ROOM)
    free = (lengths <= limit) & (counts > taken)
    if left <= limit:
        taken[free] += closest_sum(lengths[free], (counts - taken)[free], left, limit)
    back = np.empty_like(taken)
    back[order] = taken
    return back


# Targets


def _weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sources with their ``weight``: the weights repeat along the sources in code point order, a null source last.

    The sources are range partitioned; their places are counts of earlier parts plus the place inside the part.
    """
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = materialise(ordered.withColumn("part", F.spark_partition_id()).withColumn("place", low), "mix_sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return placed.join(starts, "part").withColumn("weight", F.element_at(cycle, ((F.col("start") + F.col("place")) % len(weights) + 1).cast("int"))).drop("part", "place", "start")


def with_targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Add ``target`` to rows (source, source_size): shares of all words by weight, none above ``most`` times its source's words.

    What a stopped source leaves over is shared again among the others by weight, until none is above: round by
    round, every other target is its weight times a common level, and one row of sums per round reaches the driver.
    """
    known = materialise(_weights(sources, weights), "mix_weights")
    total = int(known.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * most
    level, before = 0.0, -1
    while True:
        # At the last level these sources were above their stop; a level only rises, so they stay stopped.
        stopped = cap < F.col("weight") * F.lit(level)
        weight, used, count = known.agg(F.sum(F.when(~stopped, F.col("weight"))), F.sum(F.when(stopped, cap)), F.count(F.when(stopped, 1))).first()
        if count == before or not weight:
            break
        level, before = (total - int(used or 0)) / weight, count
    return known.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double"))).drop("weight")


# The mix


def mix(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (1, 2, 3), most: int = 3, seed: int = 11,
    room: int = ROOM,
) -> DataFrame:
    """Key, source, ``size`` in words, ``source_size``, ``target`` and ``copies``: how often the mix takes the document, at most ``most`` times.

    A source's copies are whole passes plus one more of some documents, so that their words come as near to its target,
    rounded to a whole number, as ``fit`` finds. The documents with one more are those of their length with the
    smallest seeded hashes, so reruns agree whatever the partitioning. Ranks come from a range partitioning by source, length and hash, so
    neither a hot source nor a hot length is one task; a task of ``fit`` has one row per different length of a source.

    Null and empty texts have size 0 and no copies. A null source is a source, the last. Documents without a key, and repeated
    rows, are documents; rows that agree in key, source and size are interchangeable. Other columns are ignored. An empty frame stays empty.
    """
    sized = materialise(
        df.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
        .withColumn("draw", F.xxhash64(F.lit(seed), F.col("key").cast("string"))), "mix_sizes",
    )
    order = ["source", "size", "draw"]
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = sized.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = materialise(ranked.withColumn("part", F.spark_partition_id()).withColumn("place", low), "mix_ranked")

    counts = materialise(stored.groupBy("source", "size", "part").agg(F.count("*").alias("n"), F.min("place").alias("first")), "mix_counts")
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = materialise(with_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most), "mix_targets")

    def plan(block: pd.DataFrame) -> pd.DataFrame:
        name, words, budget = block["source"].iloc[0], int(block["source_size"].iloc[0]), round(float(block["target"].iloc[0]))
        passes = min(budget // words, most) if words else 0
        used = block[block["size"] > 0]
        more = fit(used["size"].to_numpy(), used["n"].to_numpy(), budget - passes * words if passes < most else 0, room)
        return pd.DataFrame({"source": name, "size": used["size"], "passes": passes, "more": more})

    known = lengths.withColumnRenamed("source", "name").join(targets, F.col("name").eqNullSafe(F.col("source"))).drop("name")
    plans = known.groupBy("source").applyInPandas(plan, "source string, size long, passes int, more long")
    plans = materialise(plans, "mix_plans")

    earlier = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).drop("n", "first")
    same = F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.size") == F.col("c.size"))
    starts = starts.alias("c").join(plans.alias("p"), same, "left").select("c.*", "passes", "more")
    starts = starts.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select("c.*", "source_size", "target")
    # Written, so that Spark knows its size, a row per source, length and task, before it plans the join.
    starts = materialise(starts, "mix_starts")
    at = F.col("s.part") == F.col("c.part"), F.col("s.size") == F.col("c.size"), F.col("s.source").eqNullSafe(F.col("c.source"))
    extra = (F.col("s.place") + F.col("c.start") < F.col("c.more")).cast("int")
    return stored.alias("s").join(starts.alias("c"), list(at)).select(
        F.col("s.key").alias(key), F.col("s.source").alias(source), "s.size", "c.source_size", "c.target", F.coalesce(F.col("c.passes") + extra, F.lit(0)).alias("copies")
    )


def mixed_rows(df: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The rows of the mix itself, each as often as it is taken, with all columns; keys must be unique and not null."""
    copies, name = fresh(df, "copies", "mixed key")
    taken = mix(df, key, **how).where("copies > 0").select(F.col(key).alias(name), F.col("copies").alias(copies))
    found = df.join(taken, F.col(key) == F.col(name)).drop(name)
    return found.withColumn(copies, F.explode(F.array_repeat(F.col(copies), F.col(copies)))).drop(copies)
