"""SimHash near-duplicates: fingerprints, and their self-join on binary tries.

The trie of all fingerprints is met with itself. A node pair starts as (root, root);
both nodes step down one bit at a time, a pair of different bits costs one of the
Hamming budget, and a pair over budget or with an empty side is dropped.

Spark deals the work by trie nodes. Budget + 1 tries hold the same fingerprints with
their bits rotated, so that each trie begins with another block of bits. Two
fingerprints within the budget agree on one whole block, hence meet in one trie at the
same node below that block, and only same-node pairs need be followed from there. A
node pair with more than ``leaf`` fingerprints is split further by Spark, level by
level, into the pairs of its descendants within the budget; smaller ones are finished
inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.llm.components import components
from riskloom.sources.store import materialise

BITS = 64


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 (seed 42) of every k-word shingle of the text with A-Z in lower case, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    return np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit number; zero for none."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint_udf(k: int):
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(shingle_hashes(t, k)) for t in texts], dtype="int64")

    return fingerprint


def with_fingerprint(df: DataFrame, text: str = "text", k: int = 3, name: str = "fingerprint") -> DataFrame:
    """Add the SimHash of a text column as a long. A null or empty text has fingerprint zero."""
    return df.withColumn(name, fingerprint_udf(k)(F.col(text)))


def _rotate(values: np.ndarray, by: int) -> np.ndarray:
    return values if by == 0 else (values << np.uint64(by)) | (values >> np.uint64(BITS - by))


def _tries(fingerprints: DataFrame, shifts: list[int], width: int) -> DataFrame:
    """Every fingerprint once for each trie, at the node below that trie's first block."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for trie, shift in enumerate(shifts):
                turned = _rotate(values, shift)
                node = (turned >> np.uint64(BITS - width)).astype(np.int64)
                yield pd.DataFrame({"trie": np.int32(trie), "a": node, "b": node, "side": np.int32(0), "fp": turned.view(np.int64)})

    return fingerprints.select("fp").mapInPandas(place, "trie int, a long, b long, side int, fp long")


def _split(rows: DataFrame, depth: int, levels: int, budget: int) -> DataFrame:
    """Step the node pairs down by some levels: each fingerprint goes to every pair of descendants within the budget."""
    masks = np.arange(1 << levels, dtype=np.int64)
    cost = np.bitwise_count(masks)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turned = batch["fp"].to_numpy(np.int64).view(np.uint64)
            own = (turned >> np.uint64(BITS - depth - levels)).astype(np.int64)
            a, b, side = batch["a"].to_numpy(np.int64), batch["b"].to_numpy(np.int64), batch["side"].to_numpy(np.int64)
            spent, same = np.bitwise_count(a ^ b), a == b
            other_node = np.where(side == 0, b, a) << levels
            low = own & ((1 << levels) - 1)
            for mask in masks:
                keep = spent + cost[mask] <= budget
                other = other_node | (low ^ mask)
                # Below a same-node pair the smaller node is side 0; below others the sides stay.
                lower = np.where(same, own <= other, side == 0)
                yield pd.DataFrame({
                    "trie": batch["trie"][keep], "a": np.where(lower, own, other)[keep], "b": np.where(lower, other, own)[keep],
                    "side": np.where(lower, 0, 1)[keep].astype(np.int32), "fp": batch["fp"][keep],
                })

    return rows.mapInPandas(step, "trie int, a long, b long, side int, fp long")


def meet(values: np.ndarray, pairs: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i before j, of values within the budget, by stepping node pairs down together.

    ``values`` is sorted inside every node; ``pairs`` has a row (a from, a to, b from, b to) per node pair,
    with b equal to a for a node met with itself. All pairs step down one bit at a time, at once.
    """
    pairs = np.column_stack([pairs, np.zeros(len(pairs), np.int64)])
    for bit in range(BITS - 1, -1, -1):
        if not len(pairs):
            break
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        al, ah, bl, bh, spent = pairs.T
        am, bm = ah - (ones[ah] - ones[al]), bh - (ones[bh] - ones[bl])  # zeros come first
        itself = (al == bl) & (ah == bh)
        kinds = [(al, am, bl, bm, spent, True), (am, ah, bm, bh, spent, True), (al, am, bm, bh, spent + 1, True), (am, ah, bl, bm, spent + 1, ~itself)]
        steps = []
        for xl, xh, yl, yh, cost, allowed in kinds:
            alone = (xl == yl) & (xh == yh) & (xh - xl < 2)
            live = (xh > xl) & (yh > yl) & (cost <= budget) & ~alone & allowed
            steps.append(np.column_stack([xl[live], xh[live], yl[live], yh[live], cost[live]]))
        pairs = np.concatenate(steps)
    return pairs[:, 0], pairs[:, 2]


def _forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every position the smallest one that its links reach."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _finish(rows: DataFrame, shifts: list[int], budget: int, partitions: int) -> DataFrame:
    """Links (u, v) of a spanning forest of each node pair, found inside tasks."""
    keys = ["trie", "a", "b"]

    def links(block: pd.DataFrame) -> pd.DataFrame:
        values = block["fp"].to_numpy(np.int64).view(np.uint64)
        trie, a, b, side = (block[c].to_numpy(np.int64) for c in ("trie", "a", "b", "side"))
        order = np.lexsort((values, side, b, a, trie))
        values, trie, a, b, side = values[order], trie[order], a[order], b[order], side[order]
        new = np.flatnonzero((np.diff(trie) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
        start, end = np.concatenate([[0], new]), np.concatenate([new, [len(values)]])
        second = np.concatenate([[0], np.cumsum(side)])
        middle = end - (second[end] - second[start])
        itself = a[start] == b[start]
        pairs = np.column_stack([start, np.where(itself, end, middle), np.where(itself, start, middle), end])
        i, j = meet(values, pairs, budget)
        root = _forest(len(values), i, j)
        at = np.flatnonzero(root != np.arange(len(values)))
        back = values.copy()
        for t, shift in enumerate(shifts):
            own = trie == t
            back[own] = _rotate(values[own], BITS - shift) if shift else values[own]
        back = back.view(np.int64)
        return pd.DataFrame({"u": back[at], "v": back[root[at]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last node pair of a batch may go on in the next one
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
            cut = len(batch) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = batch.iloc[cut:]
            if cut:
                yield links(batch.iloc[:cut])
        if held is not None and len(held):
            yield links(held)

    dealt = rows.select(*keys, "side", "fp").repartition(partitions, *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(run, "u long, v long")


def hamming_links(fingerprints: DataFrame, budget: int = 2, leaf: int = 4096, levels: int = 4) -> DataFrame:
    """Links (u, v) that connect the distinct longs of column ``fp`` exactly as all pairs within the budget would.

    Each fingerprint is written once per trie. The links of a node pair are a spanning forest, at most one
    row per fingerprint, so no group is expanded into its pairs. A node of any size is handled: Spark splits those over ``leaf``.
    """
    spark = fingerprints.sparkSession
    width = BITS // (budget + 1)
    shifts = [width * t for t in range(budget + 1)]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, depth, done = _tries(fingerprints, shifts, width), width, None
    while True:
        sizes = rows.groupBy("trie", "a", "b").agg(
            F.count("*").alias("n"), F.sum("side").alias("second")
        ).where("n > 1 and (a = b or (second > 0 and second < n))")
        met = materialise(rows.join(sizes, ["trie", "a", "b"]), "trie_nodes")
        small = _finish(met.where(F.col("n") <= leaf), shifts, budget, partitions)
        done = small if done is None else done.unionByName(small)
        large = met.where(F.col("n") > leaf).drop("n", "second")
        if depth >= BITS or large.isEmpty():
            return done
        down = min(levels, BITS - depth)
        rows, depth = _split(large, depth, down, budget), depth + down


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, budget: int = 2, leaf: int = 4096
) -> DataFrame:
    """Each row's key, its ``fingerprint`` (long) and ``component_id``, the smallest key that links reach.

    Rows with equal fingerprints are one node, so copies never meet pairwise. Null and
    empty texts have fingerprint zero and are linked like any other. A row with a null
    key takes part and gets its component's smallest key (null if it has none). Repeated
    rows come out as often as they came in. Other columns are ignored, whatever their names.
    """
    marked = materialise(with_fingerprint(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", k).drop("text"), "fingerprints")
    nodes = marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("low"))
    named = _rooted(nodes, budget, leaf)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.join(lowest, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return marked.join(classes, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def _rooted(nodes: DataFrame, budget: int, leaf: int) -> DataFrame:
    """Rows of distinct fingerprints ``fp`` with ``root``, the smallest fingerprint that their links reach."""
    joined = components(hamming_links(nodes, budget, leaf))
    return nodes.join(joined, F.col("fp") == F.col("node"), "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, budget: int = 2, leaf: int = 4096) -> DataFrame:
    """One row of each component of ``near_duplicates``: that with the smallest key, null keys last; columns as they came.

    The frame is written once with fingerprints and row numbers; only numbers and fingerprints take part in the choice, one
    row per fingerprint after a partial aggregate, so a large group of copies is never gathered. Rows that share key and
    component are ties, of which the first one written stays. Null and empty texts are one component. An empty frame stays empty.
    """
    mark, number, chosen = fresh(df, "fingerprint", "number", "chosen")
    stored = materialise(with_fingerprint(df, text, k, mark).withColumn(number, F.monotonically_increasing_id()), "fingerprinted")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col(number).alias("number"))
    nodes = materialise(stored.groupBy(F.col(mark).alias("fp")).agg(F.min(order).alias("best")), "fingerprints")
    best = _rooted(nodes, budget, leaf).groupBy("root").agg(F.min("best").alias("best"))
    return stored.join(best.select(F.col("best.number").alias(chosen)), F.col(number) == F.col(chosen), "left_semi").select(*df.columns)
