"""Quality rules: ordered threshold conjunctions learned by sequential covering, as one Spark conditional.

Everything is column expressions; the driver sees only counts per feature and threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, let, text_or_empty, words
from riskloom.sources.store import materialise

#: What rules may test; each is a ratio or a count of the columns of ``measured``.
FEATURES = (
    "n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "mark_share", "digit_share", "letter_share",
)


def repeated_words(w: Column) -> Column:
    """Words of an array inside 3-word windows that occur twice or more in it.

    Equal hashes pick the texts worth sorting; there the windows themselves are compared.
    """
    places = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    grams = F.array_sort(F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("p"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(x.g == F.get(s, j - 1).g, F.lit(False)) | F.coalesce(x.g == F.get(s, j + 1).g, F.lit(False)))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last"))
        return F.aggregate(F.array_sort(F.transform(twice, lambda x: x.p)), start, step, lambda a: a.n)

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(grams, covered)))
    )


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def measured(df: DataFrame, text: str = "text", name: str = "measured") -> DataFrame:
    """Add a struct of counts of a text; a null text counts as empty."""
    t = text_or_empty(text)
    left = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    counts = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")))
    return df.withColumn(name, F.struct(
        counts.alias("w"),
        left(r"[\x20\x09-\x0D]+").cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        repeated_lines(t).cast("long").alias("n_dup_lines"),
        (F.length(t) - F.length(F.regexp_replace(t, "\n", ""))).alias("n_breaks"),
        left("[^A-Z]+").alias("n_upper"), left("[^!?~^_=+]+").alias("n_marks"), left("[^0-9]+").alias("n_digits"), left(r"[^\p{L}]+").alias("n_letters"),
    ))


def feature(m: Column, name: str) -> Column:
    n = F.greatest(m.w.n_words, F.lit(1))
    chars = F.greatest(m.word_chars, F.lit(1))
    return {
        "n_words": m.w.n_words.cast("double"), "mean_word_chars": m.word_chars / n, "symbols_per_word": m.n_symbols / n,
        "dup_line_share": m.n_dup_lines / (m.n_breaks + 1), "repeat_share": m.w.n_repeat_words / n, "upper_share": m.n_upper / chars,
        "mark_share": m.n_marks / chars, "digit_share": m.n_digits / chars, "letter_share": m.n_letters / chars,
    }[name]


@dataclass(frozen=True)
class Test:
    """``feature > threshold`` or, not above, ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self, values: dict[str, Column]) -> Column:
        value = values[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects a text, with its rejected and kept rows in the pruning part."""

    tests: tuple[Test, ...]
    bad: int
    good: int

    def column(self, values: dict[str, Column]) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & t.column(values)
        return out


def _conjunction(tests, values: dict[str, Column]) -> Column:
    return Rule(tuple(tests), 0, 0).column(values)


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def learn(
    labelled: DataFrame, label: str, key: str, measured_name: str = "measured", cuts: int = 16, most_tests: int = 3, most_rules: int = 12,
    precision: float = 0.75, least_rows: int = 5,
) -> list[Rule]:
    """Learn an ordered list of rejecting rules from labelled rows (label 0 is to be rejected).

    Two thirds of the rows, by a hash of the key, grow each rule test by test with the highest information gain among
    ``cuts`` quantiles of every feature; the last third prunes it to its best prefix. A rule that is right for
    fewer than ``precision`` of its pruning rows, or covers fewer than ``least_rows`` bad growing rows, ends the
    list. Rows with a null label are left out; without rows of both kinds there are no rules. The driver
    holds one count per feature, threshold and class.
    """
    rows = labelled.where(F.col(label).isNotNull()).select(
        (F.col(label) == 0).alias("bad"), (F.pmod(F.xxhash64(key), F.lit(3)) < 2).alias("grow"),
        *[feature(F.col(measured_name), f).alias(f) for f in FEATURES],
    )
    rows = materialise(rows, "quality_rows")
    values = {f: F.col(f) for f in FEATURES}
    at = F.array(*[F.lit((i + 1) / (cuts + 1)) for i in range(cuts)])
    quantiles = rows.agg(*[F.percentile(f, at).alias(f) for f in FEATURES]).first()
    if quantiles[0] is None:
        return []
    limits = {f: sorted(set(quantiles[f])) for f in FEATURES}
    # The bin of a value is the number of limits below it: value > limits[i] exactly when bin > i.
    bins = [sum(((F.col(f) > x).cast("int") for x in limits[f]), F.lit(0)) for f in FEATURES]
    rows = materialise(rows.withColumn("bins", F.array(*bins)), "quality_bins")

    def counts(where: Column) -> dict[tuple[int, int], tuple[int, int]]:
        each = rows.where(where).select("bad", F.posexplode("bins").alias("f", "b"))
        found = each.groupBy("f", "b").agg(F.sum(F.col("bad").cast("long")), F.count("*")).collect()
        return {(r[0], r[1]): (r[2], r[3] - r[2]) for r in found}

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < most_rules:
        tests: list[Test] = []
        while len(tests) < most_tests:
            table = counts(F.col("grow") & left & _conjunction(tests, values))
            p0 = sum(v[0] for (f, _), v in table.items() if f == 0)
            n0 = sum(v[1] for (f, _), v in table.items() if f == 0)
            if not p0 or not n0:
                break
            best = (0.0, None)
            for i, f in enumerate(FEATURES):
                p = n = 0
                for b, limit in enumerate(limits[f]):
                    p, n = (x + y for x, y in zip((p, n), table.get((i, b), (0, 0))))
                    for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                        if pp >= least_rows and (gain := _gain(pp, nn, p0, n0)) > best[0] + 1e-9:
                            best = (gain, Test(f, above, limit))
            if best[1] is None:
                break
            tests.append(best[1])
        if not tests:
            break
        prefixes = [_conjunction(tests[: i + 1], values) for i in range(len(tests))]
        sums = [F.sum(F.when(c & (F.col("bad") == b), 1).otherwise(0)) for c in prefixes for b in (True, False)]
        s = [x or 0 for x in rows.where(~F.col("grow") & left).agg(*sums).first()]
        score = [(s[2 * i] - s[2 * i + 1]) / max(1, s[2 * i] + s[2 * i + 1]) for i in range(len(tests))]
        keep = max(range(len(tests)), key=lambda i: (score[i], -i))
        bad, good = s[2 * keep], s[2 * keep + 1]
        if bad < precision * (bad + good) or not bad:
            break
        rules.append(Rule(tuple(tests[: keep + 1]), bad, good))
        left = left & ~rules[-1].column(values)
    return rules


def decision(rules: list[Rule], measured_name: str = "measured") -> tuple[Column, Column]:
    """The list as ordered conditionals: whether a row is kept, and the number of the rule that rejects it (null for none)."""
    values = {f: feature(F.col(measured_name), f) for f in FEATURES}
    which = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        which = F.when(rules[i].column(values), F.lit(i)).otherwise(which)
    return which.isNull(), which


def labelled_rows(df: DataFrame, labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """Rows of ``df`` with a label: of all labelled keys the ``most`` with the smallest hash, one label per key.

    A key with several labels takes the smallest; keys and labels that are null are left out.
    """
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("label_key")).agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("label_key"), "label_key").limit(most)
    )
    return df.join(F.broadcast(chosen), F.col(key) == F.col("label_key"))


def apply_rules(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 20000
) -> tuple[DataFrame, list[Rule]]:
    """All rows with a struct ``measured``, ``kept`` and ``rule`` (number of the rejecting rule), and the rules.

    The rules are learned from at most ``sample`` labelled rows (see ``labelled_rows``), the same at every size of
    the data; measures and decisions cover every row. Null and empty texts are measured as empty, repeated rows keep
    their number, an empty table or one without labels keeps everything. Columns named like the three
    added ones, or like those of the labels, are not touched before the end: pass only the key and the text.
    """
    plain = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = labelled_rows(plain, labels.select(F.col(key).alias("key"), F.col(label).alias("label_value")), "key", "label_value", sample)
    rules = learn(measured(known.select("key", "text", "label")), "label", "key")
    out = measured(plain)
    kept, which = decision(rules)
    return out.select(F.col("key").alias(key), "measured", kept.alias("kept"), which.alias("rule")), rules
