"""Toxicity by two Kneser-Ney models, of toxic and of ordinary texts, over shared backoff counts.

A model counts contexts, not occurrences: N(.w) is the number of different words that stand before w in its texts, so a text
that is copied counts once. An expression p is a beginning of words, of up to ``SPELLED`` characters, or a whole word of any length with its end
mark; N(p) is the sum of N(.w) over the words it begins. In scripts without blanks every character is a word. P(p) = (N(p) - D)+ / N + D * types / N * S(p), where S(p), shared by both models, pools their counts: what
is rare in both says nothing about the class.

The log-ratio of a word is that of its longest kept expression. An expression is kept if its share among
the continuations of the next shorter one differs between the models by ``DEVIATIONS`` standard deviations; all others
say no more than their beginning does. All labelled texts are counted, exactly; only the kept expressions are broadcast, all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.store import materialise, materialise_counted

#: Characters of scripts written without blanks: Thai, kana, Han.
_ALONE = "\u0e00-\u0e7f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
TOKEN = re.compile(rf"[{_ALONE}]|[^\W\d_{_ALONE}]+")
WINDOW = 8
#: Characters of the beginnings of words that are expressions; whole words are, whatever their length.
SPELLED = 12
END = "$"
DEVIATIONS = 3.0
LEAST = 3
EVIDENCE = 7


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def word_hash(word: str) -> int:
    """A word's 64 bits, as a signed number."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace")) - (1 << 63)


def _contexts(labelled: DataFrame) -> DataFrame:
    """(toxic, word, kinds): how many different words stand before each word, by the hash of the word, in the texts of each class."""

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            if len(known) > 100_000:
                known.clear()
            for toxic in (0, 1):
                before, word = [], []
                for text in batch["text"][batch["label"] == toxic]:
                    h = []
                    for w in tokens(text):
                        x = known.get(w)
                        if x is None:
                            x = known[w] = word_hash(w)
                        h.append(x)
                    if len(h) > 1:
                        h = np.array(h, np.int64)
                        before.append(h[:-1])
                        word.append(h[1:])
                if word:
                    b, w = np.concatenate(before), np.concatenate(word)
                    order = np.lexsort((b, w))
                    b, w = b[order], w[order]
                    new = np.concatenate([[True], (b[1:] != b[:-1]) | (w[1:] != w[:-1])])
                    yield pd.DataFrame({"toxic": np.int8(toxic), "before": b[new], "word": w[new]})

    pairs = labelled.select("text", "label").mapInPandas(pair, "toxic byte, before long, word long").distinct()
    return pairs.groupBy("toxic", "word").agg(F.count("*").alias("kinds"))


def _vocabulary(labelled: DataFrame) -> DataFrame:
    """(spelling, word): the distinct words of the texts and their hashes."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given: set[str] = set()
        for batch in batches:
            if len(given) > 100_000:
                given.clear()
            new = {w for text in batch["text"] for w in tokens(text)} - given
            given |= new
            found = sorted(new)
            yield pd.DataFrame({"spelling": found, "word": np.array([word_hash(w) for w in found], np.int64)}).astype({"spelling": object})

    return labelled.select("text").mapInPandas(spell, "spelling string, word long").distinct()


@dataclass
class Model:
    """Log-ratios of the kept expressions, and the calibration."""

    ratios: dict[str, float]
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None


def expressions(labelled: DataFrame) -> DataFrame:
    """(start, ratio, deviation) of all expressions of rows (text, label), ordered by nothing: the log-ratio of an expression,
    and by how many standard deviations its share below its beginning differs between the models."""
    before = materialise(_contexts(labelled), "toxicity_words")
    stats = before.agg(*[
        F.coalesce(f(F.when(F.col("toxic") == c, x)), F.lit(0)).cast("double").alias(f"{n}{c}")
        for c in (0, 1) for n, f, x in (
            ("total", F.sum, F.col("kinds")), ("types", F.count, F.lit(1)),
            ("once", F.count, F.when(F.col("kinds") == 1, 1)), ("twice", F.count, F.when(F.col("kinds") == 2, 1)),
        )
    ]).first()
    spelled = before.join(_vocabulary(labelled), "word").select("toxic", "kinds", F.concat("spelling", F.lit(END)).alias("s"))
    starts = F.transform(F.sequence(F.lit(0), F.least(F.length("s"), F.lit(SPELLED))), lambda k: F.substring("s", F.lit(1), k))
    starts = F.when(F.length("s") > SPELLED, F.array_append(starts, F.col("s"))).otherwise(starts)
    counts = spelled.select("toxic", "kinds", F.explode(starts).alias("start")).groupBy("start").agg(
        *[F.sum(F.when(F.col("toxic") == c, F.col("kinds")).otherwise(0)).cast("double").alias(f"n{c}") for c in (0, 1)]
    )
    counts = materialise(counts, "toxicity_expressions")
    above = counts.select(F.col("start").alias("above"), F.col("n0").alias("a0"), F.col("n1").alias("a1"))
    met = counts.where("start <> ''").join(above, F.expr(f"left(start, least(length(start) - 1, {SPELLED})) = above"))
    pooled = (F.col("n0") + F.col("n1")) / max(1.0, stats.total0 + stats.total1)

    def chance(c: int) -> Column:
        total, once, twice = (stats[f"{x}{c}"] for x in ("total", "once", "twice"))
        if not total:
            return pooled
        d = once / (once + 2 * twice) if once else 0.5
        return F.greatest(F.col(f"n{c}") - d, F.lit(0.0)) / total + d * stats[f"types{c}"] / total * pooled

    share = (F.col("n0") + F.col("n1")) / (F.col("a0") + F.col("a1"))
    expected = F.col("a1") * share
    deviation = (F.col("n1") - expected) / F.sqrt(expected * (1 - F.col("a1") / (F.col("a0") + F.col("a1"))) + 0.25)
    return met.select("start", (F.log(chance(1)) - F.log(chance(0))).alias("ratio"), deviation.alias("deviation"), "n0", "n1")


def count_model(labelled: DataFrame) -> Model:
    """A model of rows (text, label), without calibration. The driver receives all kept expressions and nothing else."""
    known = expressions(labelled).where((F.abs("deviation") >= DEVIATIONS) & (F.col("n0") + F.col("n1") >= LEAST))
    kept = known.select("start", "ratio").toArrow()
    return Model(dict(zip(kept["start"].to_pylist(), kept["ratio"].to_pylist())))


def word_ratio(ratios: dict[str, float], word: str) -> float:
    """The log-ratio of a word: that of its longest kept expression, 0 if it has none."""
    marked = word + END
    for k in (len(marked), *range(min(len(marked) - 1, SPELLED), 0, -1)):
        if (found := ratios.get(marked[:k])) is not None:
            return found
    return 0.0


def evidence(r: np.ndarray) -> list[float]:
    """Log-likelihood ratios per word: of the whole text, of its best window, of its best, second and third best word, of its 8 best; and the log of the length."""
    if not len(r):
        return [0.0] * EVIDENCE
    width = min(WINDOW, len(r))
    sums = np.concatenate([[0.0], np.cumsum(r)])
    top = np.sort(np.partition(r, -8)[-8:]) if len(r) > 8 else np.concatenate([np.zeros(8 - len(r)), np.sort(r)])
    best = float((sums[width:] - sums[:-width]).max() / width)
    return [float(r.mean()), best, float(top[-1]), float(top[-2]), float(top[-3]), float(top.mean()), float(np.log(len(r)))]


class Reader(dict):
    """Evidence of texts; remembers the ratios of words it has met, a bounded number of them."""

    def __init__(self, ratios: dict[str, float], most: int = 150_000):
        super().__init__()
        self.ratios, self.most = ratios, most

    def __missing__(self, word: str) -> float:
        value = self[word] = word_ratio(self.ratios, word)
        return value

    def evidence(self, text: str | None) -> list[float]:
        if len(self) > self.most:
            self.clear()
        words = tokens(text)
        return evidence(np.fromiter(map(self.__getitem__, words), np.float64, len(words)))


def calibrate(model: Model, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Model:
    """Fit a logistic curve over the evidence by Newton steps; without rows of both classes the score is the smoothed share of toxic rows."""
    x = x.reshape(-1, EVIDENCE)
    model.shift = x.mean(0) if len(x) else np.zeros(EVIDENCE)
    model.scale = np.maximum(x.std(0), 1e-9) if len(x) else np.ones(EVIDENCE)
    w = np.zeros(EVIDENCE + 1)
    if 0 < y.sum() < len(y):
        z = np.column_stack([np.ones(len(x)), (x - model.shift) / model.scale])
        penalty = np.diag([1e-6] + [ridge] * EVIDENCE)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
    else:
        w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 1.0))
    model.weights = w
    return model


def _score_udf(model):
    """(evidence, score) of each text, from a broadcast model."""

    @F.pandas_udf("evidence array<double>, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = model.value
        reader = Reader(m.ratios)
        for texts in batches:
            found = np.array([reader.evidence(t) for t in texts], np.float64).reshape(-1, EVIDENCE)
            p = np.full(len(found), np.nan)
            if m.weights is not None:
                z = m.weights[0] + ((found - m.shift) / m.scale) @ m.weights[1:]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pd.DataFrame({"evidence": list(found), "score": p})

    return score


def labelled_texts(df: DataFrame, labels: DataFrame, broadcast_rows: int = 4_000_000) -> DataFrame:
    """Rows (text, label, part) of the texts with a label, from frames (key, text) and (key, label, part).

    One label per key, the largest; null keys and labels are left out. The labels are broadcast up to ``broadcast_rows`` keys, as
    the write of them counts, so that texts are not shuffled for the sake of labels; more of them are joined by a shuffle, with the same rows.
    """
    one = labels.where("key is not null and label is not null").groupBy("key").agg(F.max("label").alias("label"), F.first("part").alias("part"))
    stored, keys = materialise_counted(one, "toxicity_labels")
    return df.join(F.broadcast(stored) if keys <= broadcast_rows else stored, "key").select("text", "label", "part")


def fit(labelled: DataFrame, calibration_rows: int = 50_000) -> Model:
    """A model of the rows (text, label) with part 0, calibrated on those with part 1.

    All rows of part 0 are counted. The logistic curve over seven numbers is fitted to at most
    ``calibration_rows`` rows of part 1, those with the smallest text hash; this bound is the only sample.
    """
    model = count_model(labelled.where("part = 0"))
    shared = labelled.sparkSession.sparkContext.broadcast(model)
    scored = labelled.where("part = 1").select("label", F.xxhash64("text").alias("at"), _score_udf(shared)(F.col("text")).getField("evidence").alias("evidence"))
    found = scored.orderBy("at", "label").limit(calibration_rows).toArrow()
    x = np.array(found["evidence"].to_pylist(), np.float64)
    return calibrate(model, x, np.array(found["label"].to_pylist(), np.float64))


def fold(key: Column) -> Column:
    """One of five folds, fixed by the key's text; null for a null key, from which nothing is learnt."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(5))


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labels of all rows whose ``fold`` is not 0; fold 4 calibrates, the others are counted."""
    part = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).withColumn("fold", fold(F.col("key")))
    part = part.where("fold <> 0").select("key", "label", (F.col("fold") == 4).cast("int").alias("part"))
    return fit(labelled_texts(df.select(F.col(key).alias("key"), F.col(text).alias("text")), part))


def score(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A column: the chance that a text is toxic, from the text alone. Null and empty texts get the curve's value at no evidence.

    Repeated rows score alike, other columns are not read, and a frame without rows stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    return _score_udf(shared)(F.col(text)).getField("score")
