"""Packing: length buckets of least padding, and token-budget batches inside each bucket."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import let, text_or_empty, words
from riskloom.llm.slots import with_slot


@dataclass(frozen=True)
class Plan:
    """Ascending bucket boundaries: a sequence goes to the first that is not below its length, and is padded to it."""

    boundaries: tuple[int, ...]
    padding: int

    def bucket(self, length: Column) -> Column:
        out = F.lit(len(self.boundaries) - 1)
        for i in range(len(self.boundaries) - 2, -1, -1):
            out = F.when(length <= self.boundaries[i], F.lit(i)).otherwise(out)
        return out

    def padded_to(self, bucket: Column) -> Column:
        return F.get(F.array(*[F.lit(b) for b in self.boundaries]), bucket)


def plan_buckets(histogram: dict[int, int], buckets: int) -> Plan:
    """The at most ``buckets`` boundaries that pad a length histogram least, by dynamic programming over all distinct lengths.

    best[k][j] is the least padded size of the lengths up to the j-th in k buckets, the last of them
    ending at the j-th: the minimum over i of best[k - 1][i] + length[j] * count(i, j]. Ties take fewer buckets, then smaller
    boundaries. An empty histogram has the single boundary 1; length 0 is padded like any other.
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if c > 0), np.int64)
    if not len(lengths):
        return Plan((1,), 0)
    count = np.concatenate([[0], np.cumsum([histogram[n] for n in lengths.tolist()])]).astype(np.float64)
    size = len(lengths)
    best = np.full(size + 1, np.inf)
    best[0] = 0.0
    found, choices = (np.inf, 0), []
    for k in range(1, min(buckets, size) + 1):
        new, choice = np.full(size + 1, np.inf), np.zeros(size + 1, np.int64)
        for j in range(k, size + 1):
            cost = best[:j] + lengths[j - 1] * (count[j] - count[:j])
            choice[j] = int(np.argmin(cost))
            new[j] = cost[choice[j]]
        choices.append(choice)
        best = new
        if best[size] < found[0]:
            found = (best[size], k)
    ends, j = [], size
    for k in range(found[1], 0, -1):
        ends.append(int(lengths[j - 1]))
        j = int(choices[k - 1][j])
    total = sum(n * histogram[n] for n in lengths.tolist())
    return Plan(tuple(reversed(ends)), int(found[0]) - total)


def pieces(df: DataFrame, tokens: Column, context: int) -> DataFrame:
    """Cut token arrays into consecutive pieces of at most ``context``: adds piece, start, n_tokens and tokens.

    An empty or null array has one piece of no tokens, so no row is lost.
    """
    numbered = let(F.coalesce(tokens, F.array()), lambda t: F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(t) / context).cast("int") - 1, F.lit(0))),
        lambda i: F.struct(i.alias("piece"), (i * context).alias("start"), F.slice(t, i * context + 1, F.lit(context)).alias("tokens")),
    ))
    return df.select("*", F.explode(numbered).alias("cut")).select(*df.columns, "cut.piece", "cut.start", F.size("cut.tokens").alias("n_tokens"), "cut.tokens")


def batches(sequences: DataFrame, budget: int, buckets: int, length: str = "n_tokens") -> tuple[DataFrame, Plan]:
    """Bucket and batch rows by a length column: adds bucket, padded_to, batch and place; also returns the plan.

    The histogram of all rows, at most one count per distinct length, goes to the driver. A batch of bucket b holds
    budget // padded_to rows (one, where that is none), in a single bucket; only the last batch of a bucket is short.
    Numbers of batches and places start at 0 and have no gaps. Rows with a null length count as 0.
    """
    n = F.coalesce(F.col(length), F.lit(0))
    histogram = {r[0]: r[1] for r in sequences.groupBy(n.alias("n")).agg(F.count("*").alias("c")).collect()}
    plan = plan_buckets(histogram, buckets)
    dealt = sequences.withColumn("bucket", plan.bucket(n)).withColumn("padded_to", plan.padded_to(F.col("bucket")).cast("int"))
    holds = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("padded_to"), F.lit(1)))).cast("long")
    placed = with_slot(dealt, "bucket", name="slot")
    return placed.withColumn("batch", F.floor(F.col("slot") / holds).cast("long")).withColumn("place", (F.col("slot") % holds).cast("int")).drop("slot"), plan


def pack(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokens: Column | None = None, context: int = 2048, budget: int = 16384,
    buckets: int = 8, with_tokens: bool = False, with_text: bool = False,
) -> tuple[DataFrame, Plan]:
    """Training sequences of all texts: key, piece, start, n_tokens, bucket, padded_to, batch, place, and the tokens, or the text they make joined by blanks, if asked for.

    Tokens are the words of the text unless ``tokens``, a column of arrays, says otherwise. A text longer
    than ``context`` becomes several pieces, none is cut off; null and empty texts are one piece of no tokens. Null keys and repeated
    rows are packed like any other; other columns are ignored, whatever their names; no rows give no batches.
    """
    cut = pieces(df.select(F.col(key).alias("key"), (words(text_or_empty(text)) if tokens is None else tokens).alias("all")), F.col("all"), context)
    kept = ["key", "piece", "start", "n_tokens", *(["tokens"] if with_tokens else []), *([F.array_join("tokens", " ").alias("text")] if with_text else [])]
    out, plan = batches(cut.select(*kept), budget, buckets)
    return out.withColumnRenamed("key", key), plan
