"""Personal data: base kinds by rule, further identifiers by bootstrapped contexts."""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.sources.store import materialise

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD, DIGIT = re.compile(r"[^\x20\x09-\x0D]+"), re.compile("[0-9]")
#: A word of a context counts by its last characters, so many of them.
LAST = 64
EDGES = "\"'`()[]{}<>,;:!?*#$%&|."


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in time linear in the text.

    A local part is a maximal run, which an @ must follow; no start inside that run does better than its first place.
    """
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            found["phone"].append(m.span())
    return found


def _context(text: str, words: list[tuple[int, int]], starts: list[int], start: int) -> list[str]:
    """Lexical patterns of a place: the one and the two words before it, digits as 0, in lower case.

    What stands before the place in its own word is a word. Words are given by their places, so a context has both however long they are.
    """
    at = bisect_left(starts, start)
    near = [text[max(a, min(b, start) - LAST) : min(b, start)] for a, b in words[max(0, at - 2) : at]]
    near = [DIGIT.sub("0", w.lower()) for w in near]
    return [f"1 {near[-1]}", f"2 {' '.join(near)}"] if len(near) == 2 else [f"1 {w}" for w in near]


def occurrences(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple]:
    """(kind or None, instance, start, end, patterns) of all base spans and of all other words with a digit, in time linear in the text."""
    spans = sorted((a, b, k) for k, found in base.items() for a, b in found)
    words = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in words]
    out = [(k, text[a:b].lower(), a, b, _context(text, words, starts, a)) for a, b, k in spans]
    at = 0
    for begin, end in words:
        if not DIGIT.search(text, begin, end):
            continue
        while at < len(spans) and spans[at][1] <= begin:
            at += 1
        if at < len(spans) and spans[at][0] < end:
            continue
        token = text[begin:end]
        start = begin + len(token) - len(token.lstrip(EDGES))
        core = token.strip(EDGES)
        if core:
            out.append((None, core.lower(), start, start + len(core), _context(text, words, starts, begin)))
    return out


SPANS = "array<struct<kind:string,start:int,end:int>>"
OCCURRENCES = "array<struct<kind:string,instance:string,start:int,end:int,patterns:array<string>>>"


def _base(texts: pd.Series) -> pd.Series:
    found = (base_spans(t or "") for t in texts)
    return pd.Series([[{"kind": k, "start": a, "end": b} for k in KINDS for a, b in f[k]] for f in found], dtype=object)


def _seen(texts: pd.Series) -> pd.Series:
    found = (occurrences(t, base_spans(t)) if t else [] for t in texts)
    return pd.Series([[dict(zip(("kind", "instance", "start", "end", "patterns"), o)) for o in f] for f in found], dtype=object)


def learn_patterns(graph: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8) -> DataFrame:
    """(pattern, kind) of the trusted contexts of a graph with rows (pattern, instance, kind or null).

    Seeds, the instances with a kind, have score 1. Each round scores every pattern by the mean
    score of its distinct instances, trusts those with a mean of ``confidence`` and a score sum of
    ``support`` or more, and gives each instance the chance that one of its trusted patterns is
    right. A pattern takes the kind that weighs most among its instances, ties by name. Null
    patterns or instances are ignored; repeated rows count once; an empty graph has no patterns.
    """
    edges = materialise(
        graph.where("pattern is not null and instance is not null").groupBy("pattern", "instance").agg(F.min("kind").alias("kind")), "pii_graph"
    )
    scores = edges.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("score"))
    for turn in range(rounds):
        met = edges.select("pattern", "instance").join(scores, "instance", "left")
        by_kind = met.groupBy("pattern", "kind").agg(F.count("*").alias("n"), F.sum("score").alias("s"))
        best = F.max(F.struct(F.when(F.col("kind").isNotNull(), F.col("s")).alias("s"), F.col("kind").alias("kind")))
        judged = by_kind.groupBy("pattern").agg(F.sum("n").alias("n"), F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"), best.alias("best"))
        trusted = materialise(
            judged.where((F.col("s") >= support) & (F.col("s") >= confidence * F.col("n"))).select(
                "pattern", F.col("best.kind").alias("kind"), F.least(F.col("s") / (F.col("n") + 1), F.lit(0.999)).alias("trust")
            ), "pii_patterns",
        )
        if turn + 1 < rounds:
            found = edges.where("kind is null").select("pattern", "instance").join(trusted, "pattern")
            new = found.groupBy("instance").agg(F.max_by("kind", F.struct("trust", "kind")).alias("kind"), (1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"))
            seeds = edges.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("score"))
            scores = seeds.unionByName(new.join(seeds.select("instance"), "instance", "left_anti"))
    return trusted.select("pattern", "kind")


def in_order(spans: Column) -> Column:
    """Spans by kind as listed, then start, then end."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.transform(spans, lambda s: F.struct(F.array_position(kinds, s.kind).alias("rank"), s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")))
    return F.transform(F.array_sort(ranked), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))


def is_kind(kind: str):
    """A test of spans, for ``filter``."""
    return lambda span: span.kind == kind


def digest(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))


def find_pii(
    df: DataFrame, text: str = "text", name: str = "pii", rounds: int = 3, support: int = 3, confidence: float = 0.8, least_length: int = 6
) -> DataFrame:
    """Add a struct ``base`` and ``spans``: arrays of (kind, start, end), code points, end exclusive, in kind and start order.

    Base spans are the rule-based ones of ``KINDS``. They are the seeds of a graph between
    contexts and the tokens with a digit that stand in them; tokens of at least ``least_length``
    characters in contexts trusted by ``learn_patterns`` are added to ``spans`` unless they overlap
    a span. Null and empty texts have none. Rows keep their number, repeated ones included, and all
    columns; ``name`` must be new. Copies do not strengthen a context, as instances count once.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {name} exists")
    # A text is known by its hash and length: what is learned about it is small and is joined back to the rows.
    each = df.where(F.col(text).isNotNull()).select(
        F.xxhash64(text).alias("id"), F.octet_length(text).alias("size"), F.inline(F.pandas_udf(_seen, OCCURRENCES)(F.col(text)))
    )
    contexts = materialise(each.where("size(patterns) > 0"), "pii_seen").select("id", "size", "kind", "instance", "start", "end", F.explode("patterns").alias("pattern"))
    patterns = learn_patterns(contexts.select("pattern", "instance", "kind"), rounds, support, confidence)
    added = (
        contexts.where(F.col("kind").isNull() & (F.length("instance") >= least_length)).drop("kind").join(patterns, "pattern")
        .groupBy("id", "size").agg(F.collect_set(F.struct("start", "end", "kind")).alias("new"))
    )
    # Two contexts of one token may differ in kind: the first by name stays.
    one = F.filter(F.array_sort("new"), lambda s, i: (i == 0) | (s.start != F.get(F.array_sort("new"), i - 1).start))
    extra = F.transform(one, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    base, same, long, more = fresh(df, "base", "text id", "text size", "extra spans")
    added = materialise(added.select(F.col("id").alias(same), F.col("size").alias(long), extra.alias(more)), "pii_added")
    known = (F.xxhash64(text) == F.col(same)) & (F.octet_length(text) == F.col(long))
    out = df.withColumn(base, F.pandas_udf(_base, SPANS)(F.col(text))).join(added, known, "left")
    spans = F.concat(F.col(base), F.coalesce(more, F.array().cast(SPANS)))
    return out.select(*df.columns, F.struct(F.col(base).alias("base"), in_order(spans).alias("spans")).alias(name))


def _redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, found in zip(texts, spans):
        if text is not None and len(found):
            parts, at = [], 0
            for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
                at = max(at, s["end"])
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pd.Series(out, dtype=object)


def redact(df: DataFrame, text: str = "text", **how) -> DataFrame:
    """The same rows and columns with every span of the text replaced by its kind in brackets; overlapping spans become one mark."""
    (name,) = fresh(df, "pii")
    found = find_pii(df, text, name, **how)
    return found.withColumn(text, F.pandas_udf(_redacted, "string")(F.col(text), F.col(f"{name}.spans"))).drop(name)
