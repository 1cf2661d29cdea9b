"""Exact substring duplicates: word sequences of a fixed length that stand anywhere else too.

A window is ``width`` consecutive words. Its anchor is the smallest hash of the ``GRAM``-word sequences inside it, so equal
windows have equal anchors. A text is cut into pieces, runs of up to ``RUN`` windows with one anchor, and pieces are dealt by their
anchor: whatever repeats, repeats inside a shard. Each shard builds a compressed index over its different pieces
and streams its pieces backward through it; ranges that occur again and hold a window are reported.

Equal pieces are one piece with a count before they meet; pieces whose anchor stands nowhere else never reach a
shard. An anchor with more than ``hot`` different pieces has them cut into single windows, which are dealt by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.llm.fmindex import FMIndex, repeated_ranges
from riskloom.sources.store import materialise

GRAM = 8
RUN = 28
#: Long texts are read in parts of so many windows; a place in one fits the low bits of ``PLACE``.
PART = 1 << 20
PLACE = (1 << 24) - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words of one index; a shard holds several of them, cut between anchors.
INDEX_WORDS = 200_000


class WordHash(dict):
    """Remembers the 64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` values, by doubling."""
    out, done, power = None, 0, h
    step, scale = 1, BASE
    while True:
        if size & step:
            if out is None:
                out, done = power, step
            else:
                n = len(h) - (done + step) + 1
                out = out[:n] * scale + power[done : done + n]
                done += step
        if done == size:
            return _mix(out)
        n = len(h) - 2 * step + 1
        power = power[:n] * scale + power[step : step + n]
        step, scale = step * 2, np.uint64(int(scale) ** 2 & ((1 << 64) - 1))


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of all runs of ``size`` values, by doubling."""
    step = 1
    while step * 2 <= size:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (size - step)], values[size - step :]) if size > step else values


def anchored_pieces(h: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(anchor, content hash, first window, windows, several) of the pieces of a text, from the hashes of its words.

    The anchor of a window is its smallest hash of a sequence; a piece is a run of at most ``RUN`` windows with one anchor. The fifth
    array marks pieces where the anchor stands at several places, as only those can hold a window twice.
    """
    parts = [_pieces_of(h[at : at + PART + width - 1], at, width) for at in range(0, max(0, len(h) - width + 1), PART)]
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else empty


def _pieces_of(h: np.ndarray, offset: int, width: int) -> tuple[np.ndarray, ...]:
    gram = min(GRAM, width)
    hashes = _rolled(h, gram)
    # The low bits hold the place, so that the minimum tells where it is.
    keyed = (hashes & ~np.uint64(PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    place = (_least(keyed, width - gram + 1) & np.uint64(PLACE)).astype(np.int64)
    anchors = hashes[place]
    first = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    length = np.diff(np.append(first, len(place)))
    several = place[first] != place[first + length - 1]
    if length.max() > RUN:
        parts = -(-length // RUN)
        inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        length = np.minimum(RUN, np.repeat(length, parts) - inside * RUN)
        first, several = np.repeat(first, parts) + inside * RUN, np.repeat(several, parts)
    # The content of a piece from prefix sums of word hashes times powers of an odd number, brought to a common power.
    size = length + width - 1
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), BASE, np.uint64)]))
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    backs = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), inverse, np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(h) * powers[:-1], dtype=np.uint64)])
    content = _mix((sums[first + size] - sums[first]) * backs[first] + size.astype(np.uint64))
    return anchors[first], content, first + offset, length, several


PIECE = "anchor long, content long, start int, windows int"


def _pieces(texts: DataFrame, width: int) -> DataFrame:
    """Rows (id, size, anchor, content, start, windows, several) of all texts with at least one window."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHash()
        for batch in batches:
            rows = []
            for key, size, text in zip(batch["id"], batch["size"], batch["text"]):
                words = split(text)
                if len(words) >= width:
                    if len(known) > 150_000:
                        known.clear()
                    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                    a, c, s, n, several = anchored_pieces(h, width)
                    rows.append((np.full(len(a), key), np.full(len(a), size), a.view(np.int64), c.view(np.int64), s, n, several))
            if rows:
                columns = [np.concatenate(x) for x in zip(*rows)]
                yield pd.DataFrame(dict(zip(("id", "size", "anchor", "content", "start", "windows", "several"), columns)))

    return texts.mapInPandas(cut, f"id long, size int, {PIECE}, several boolean")


def _contents(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(anchor, content, words) of wanted pieces, read out of the texts that have them."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given: set[tuple[int, int]] = set()  # copies give a piece once per task
        for batch in batches:
            anchors, contents, pieces = [], [], []
            for data, wants in zip(batch["packed"], batch["wants"]):
                wants = [w for w in wants if (w["anchor"], w["content"]) not in given]
                given.update((w["anchor"], w["content"]) for w in wants)
                words = expand(data) if wants else []
                for w in wants:
                    anchors.append(w["anchor"])
                    contents.append(w["content"])
                    pieces.append(b" ".join(words[w["start"] : w["start"] + w["windows"] + width - 1]))
            yield pd.DataFrame({"anchor": np.array(anchors, np.int64), "content": np.array(contents, np.int64), "words": pd.Series(pieces, dtype=object)})

    # Written, like the ranges below, so that a join has two plain sides and Spark can split the copies of one text.
    lists = materialise(wanted.groupBy("id", "size").agg(F.collect_set(F.struct("anchor", "content", "start", "windows")).alias("wants")), "substring_wants")
    packed = texts.select("id", "size", compressed(F.col("text")).alias("packed"))
    joined = packed.join(lists, ["id", "size"]).select("packed", "wants")
    return joined.mapInPandas(cut, "anchor long, content long, words binary")


def search_shard(pieces: list[bytes], alone: np.ndarray, width: int) -> list[list[tuple[int, int]]]:
    """Word ranges of each piece that occur again among the pieces. A piece that is not ``alone`` has copies, so all of it does."""
    words = [p.split(b" ") for p in pieces]
    sizes = np.array([len(w) for w in words], np.int64)
    numbers: dict[bytes, int] = {}
    text = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    for at, w in zip(starts.tolist(), words):
        text[at : at + len(w)] = [numbers.setdefault(x, len(numbers) + 1) for x in w]
    out: list[list[tuple[int, int]]] = [[] if a else [(0, int(n))] for a, n in zip(alone, sizes)]
    asked = np.flatnonzero(alone)
    if len(asked):
        index = FMIndex(text, RUN + width + 1)
        for part in repeated_ranges(index, text, starts[asked], ends[asked], width):
            for i, a, b in part.tolist():
                at = int(asked[i])
                out[at].append((a - int(starts[at]), b - int(starts[at])))
    return out


FOUND = "anchor long, content long, ranges array<int>"


def _searched(rows: DataFrame, width: int, partitions: int) -> DataFrame:
    """(anchor, content, ranges) of all pieces (anchor, content, copies, words) with ranges that occur again, shard by shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def flush(block: pd.DataFrame) -> pd.DataFrame:
            block = block.drop_duplicates(["anchor", "content"])
            found = search_shard(block["words"].tolist(), (block["copies"] == 1).to_numpy(), width)
            keep = [i for i, r in enumerate(found) if r]
            return pd.DataFrame({
                "anchor": block["anchor"].to_numpy()[keep], "content": block["content"].to_numpy()[keep], "ranges": pd.Series([[x for r in found[i] for x in r] for i in keep], dtype=object),
            })

        for batch in batches:
            held.append(batch)
            size += int(batch["words"].map(len).sum()) // 6
            if size > INDEX_WORDS:
                block = pd.concat(held, ignore_index=True)
                open_anchor = (block["anchor"] == block["anchor"].iloc[-1]).to_numpy()
                held = [block[open_anchor]]
                size = int(held[0]["words"].map(len).sum()) // 6
                if not open_anchor.all():
                    yield flush(block[~open_anchor])
        if held:
            yield flush(pd.concat(held, ignore_index=True))

    dealt = rows.select("anchor", "content", "copies", "words").repartition(partitions, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInPandas(run, FOUND)


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """Rows (window, at, anchor, content, copies, words): pieces cut into single windows; ``window`` is the hash of one, ``words`` its words."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, c, n, words in zip(batch["anchor"], batch["content"], batch["copies"], batch["words"]):
                w = words.split(b" ")
                for at in range(len(w) - width + 1):
                    part = b" ".join(w[at : at + width])
                    out.append((xxhash.xxh64_intdigest(part) - (1 << 63), at, a, c, n, part))
            yield pd.DataFrame(out, columns=["window", "at", "anchor", "content", "copies", "words"])

    return rows.mapInPandas(cut, "window long, at int, anchor long, content long, copies long, words binary")


def repeated_ranges_of(texts: DataFrame, width: int = 35, hot: int = 5000) -> DataFrame:
    """(id, size, ranges): for each different text (id, size, text) the word ranges inside windows that stand anywhere else too.

    Rows with the same id and size are copies; they count as occurrences of their own. Ranges of one text may overlap.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = materialise(_pieces(texts, width), "substring_pieces")
    places = F.sum(F.when(F.col("several"), 2).otherwise(1)).alias("n")
    # Written, so that the join has two plain shuffles, of which Spark can split a crowded anchor.
    twice = materialise(pieces.groupBy("anchor").agg(places).where("n > 1").select("anchor"), "substring_twice")
    met = materialise(pieces.drop("several").join(twice, "anchor"), "substring_met")
    first = F.min(F.struct("id", "size", "start", "windows")).alias("first")
    distinct = materialise(met.groupBy("anchor", "content").agg(F.count("*").alias("copies"), first), "substring_distinct")
    words = _contents(texts, distinct.select("anchor", "content", "first.*"), width)
    # A text with copies may give its pieces in several tasks; equal rows meet in one shard, where one is kept.
    full = words.join(distinct.select("anchor", "content", "copies"), ["anchor", "content"])
    crowded = materialise(distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor"), "substring_crowded")
    if crowded.isEmpty():
        found = _searched(full, width, partitions)
    else:
        full = materialise(full.dropDuplicates(["anchor", "content"]), "substring_contents")
        found = _searched(full.join(crowded, "anchor", "left_anti"), width, partitions)
        windows = materialise(_windows(full.join(crowded, "anchor"), width), "substring_windows")
        single = windows.groupBy("window").agg(F.sum("copies").alias("copies"), F.first("words").alias("words"))
        again = _searched(single.select(F.col("window").alias("anchor"), F.lit(0).cast("long").alias("content"), "copies", "words"), width, partitions)
        back = windows.join(again.select(F.col("anchor").alias("window")), "window")
        found = found.unionByName(back.groupBy("anchor", "content").agg(F.flatten(F.collect_list(F.array("at", F.col("at") + width))).alias("ranges")))
    found = materialise(found, "substring_found")
    placed = met.select("id", "size", "anchor", "content", "start").distinct().join(found, ["anchor", "content"])
    each = placed.select("id", "size", F.transform("ranges", lambda x: x + F.col("start")).alias("ranges"))
    return materialise(each.groupBy("id", "size").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "substring_ranges")


def _compressed(texts: pd.Series) -> pd.Series:
    packer = zstandard.ZstdCompressor(level=1)
    return pd.Series([None if t is None else packer.compress(t.encode("utf-8", "replace")) for t in texts], dtype=object)


def compressed(text: Column) -> Column:
    """The text as compressed bytes: shuffled texts take half the room."""
    return F.pandas_udf(_compressed, "binary")(text)


def expand(data: bytes | None) -> list[bytes]:
    """The words of a compressed text."""
    return zstandard.ZstdDecompressor().decompress(data).split() if data is not None else []


def covered(ranges, n: int) -> np.ndarray:
    """Which of n words lie in ranges, given as starts and ends in turn."""
    marks = np.zeros(n + 1, np.int64)
    if ranges is not None and len(ranges):
        at = np.asarray(ranges, np.int64)
        np.add.at(marks, at[::2], 1)
        np.add.at(marks, at[1::2], -1)
    return np.cumsum(marks)[:n] > 0


def _cut(packed: pd.Series, ranges: pd.Series, with_text: bool) -> pd.DataFrame:
    rows = []
    for data, found in zip(packed, ranges):
        words = expand(data)
        gone = covered(found, len(words))
        kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if gone.any() else b" ".join(words)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        rows.append((len(words), int(gone.sum()), sha256(kept).hexdigest(), edges.tolist(), kept.decode("utf-8") if with_text else None))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "removed", "kept"])


def remove_repeats(df: DataFrame, text: str = "text", width: int = 35, name: str = "substrings", with_text: bool = False, hot: int = 5000) -> DataFrame:
    """Add a struct of each text without its repeated words: n_words, n_removed, kept_sha256, ``removed`` (first and end word of each gap), kept.

    A word goes if a window of ``width`` words covers it that also starts at any other place, in the same text or another, judged on the
    input. Every copy loses its words, none is spared. ``kept``, the words left joined by one blank, is null unless asked for. Null texts have no
    words. Rows keep their number, copies included, and their columns; ``name`` must be new.

    Texts are told apart by a 64-bit hash and their length in bytes, pieces of them by two 64-bit hashes.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {name} exists")
    identity, length, packed, gaps = fresh(df, "id", "size", "packed", "ranges")
    hashed = df.withColumn(identity, F.xxhash64(text)).withColumn(length, F.octet_length(text)).withColumn(packed, compressed(F.col(text)))
    texts = df.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("id"), F.octet_length(text).alias("size"), F.col(text).alias("text"))
    found = repeated_ranges_of(texts, width, hot).select(F.col("id").alias(identity), F.col("size").alias(length), F.col("ranges").alias(gaps))
    kind = "n_words long, n_removed long, kept_sha256 string, removed array<int>, kept string"
    cut = F.pandas_udf(lambda data, ranges: _cut(data, ranges, with_text), kind)
    return hashed.join(found, [identity, length], "left").select(*df.columns, cut(F.col(packed), F.col(gaps)).alias(name))
