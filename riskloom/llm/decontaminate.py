"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.sources.store import materialise

#: Byte by byte: A-Z in lower case, 0-9 and a-z and all bytes of other characters as they are, the rest a blank.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
FOUND = "n_words long, runs array<int>, spans array<int>, items array<string>"


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(NORMAL).split()


def item_windows(items: list[tuple[str, str | None]], size: int) -> dict[bytes, set[str]]:
    """The windows of all items, each framed by blanks, with the ids of the items that have it."""
    windows: dict[bytes, set[str]] = {}
    for item, text in items:
        words = normal_words(text)
        for at in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(b" " + b" ".join(words[at : at + size]) + b" ", set()).add(item)
    return windows


def _automaton(windows: dict[bytes, set[str]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for window, items in windows.items():
        automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, sorted(items)))
    automaton.make_automaton()
    return automaton


def _runs(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges (first, last) joined where they touch."""
    out: list[list[int]] = []
    for first, last in sorted(pairs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _offsets(text: str, runs: list[tuple[int, int]]) -> list[int]:
    """Code point offsets (start, end) in the original text of ranges of normalised words."""
    raw = text.encode("utf-8", "replace")
    data = np.frombuffer(raw.translate(NORMAL), np.uint8)
    word = np.concatenate([[False], data != 32, [False]])
    starts, ends = np.flatnonzero(~word[:-1] & word[1:]), np.flatnonzero(word[:-1] & ~word[1:])
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [int(points[x]) for first, last in runs for x in (starts[first], ends[last])]


def _scan(text: str | None, automaton: ahocorasick.Automaton, before: tuple[list[int], list[str]]) -> tuple:
    words = normal_words(text)
    line = b" " + b" ".join(words) + b" "
    pairs, items = list(zip(before[0][::2], before[0][1::2])), set(before[1])
    hits = list(automaton.iter(line.decode("latin-1"))) if len(automaton) else []
    if hits:
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        last = np.searchsorted(blanks, [end for end, _ in hits]) - 1
        for at, (_, (length, ids)) in zip(last.tolist(), hits):
            pairs.append((at - length + 1, at))
            items.update(ids)
    runs = _runs(pairs)
    return len(words), [x for run in runs for x in run], _offsets(text, runs) if runs else [], sorted(items)


def _finder(windows) -> object:
    """A function of a text column, and of the runs and items that earlier blocks found in it."""

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(windows.value)
        for texts, runs, items in batches:
            found = [_scan(t, automaton, (list(r), list(i))) for t, r, i in zip(texts, runs, items)]
            yield pd.DataFrame(found, columns=["n_words", "runs", "spans", "items"])

    return find


def find_items(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    size: int = 10, name: str = "found", block_bytes: int = 8 << 20,
) -> DataFrame:
    """Add a struct of what a text shares with a set of test items.

    ``n_words``: its normalised words; ``runs``: first and last word of each run of words inside
    occurring windows; ``spans``: the same runs as start and end code point in the original text;
    ``items``: ids, as sorted strings, of the items with an occurring window.

    A window is ``size`` consecutive words of an item, or all words of a shorter one. Null and
    empty texts have no words; items without words or with a null id match nothing. Repeated items
    count once, rows keep their number, and other columns stay as they are; ``name`` must be new.

    An automaton holds at most about ``block_bytes`` of item text and is broadcast. Its windows take about fifty times that on the driver and in
    every Python worker, 0.4 GB with the default. More items are dealt to several automata by a hash of their text, each a pass over the
    documents of its own.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {name} exists")
    tests = benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")
    )
    total = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    runs, items = F.expr("array()").cast("array<int>"), F.expr("array()").cast("array<string>")
    for block in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else tests
        rows = [(r[0], r[1]) for r in mine.collect()]
        windows = df.sparkSession.sparkContext.broadcast(item_windows(rows, size))
        df = df.withColumn(name, _finder(windows)(F.col(text), runs, items))
        if block + 1 < blocks:
            df = materialise(df, "decontaminate")
        runs, items = F.col(f"{name}.runs"), F.col(f"{name}.items")
    return df


def hit_words(found: str = "found") -> Column:
    """How many words of the text lie inside occurring windows."""
    runs = F.col(f"{found}.runs")
    ends = F.aggregate(runs, F.struct(F.lit(0).alias("n"), F.lit(-1).alias("s")), lambda a, x: F.struct((a.n + a.s * x).alias("n"), (-a.s).alias("s")))
    return (ends.n + F.size(runs) / 2).cast("long")


def clean_rows(df: DataFrame, benchmark: DataFrame, text: str = "text", size: int = 10) -> DataFrame:
    """The rows whose text has no word of an occurring window; columns as they came."""
    (name,) = fresh(df, "found")
    return find_items(df, benchmark, text=text, size=size, name=name).where(F.size(F.col(f"{name}.items")) == 0).drop(name)
