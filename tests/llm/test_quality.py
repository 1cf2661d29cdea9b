"""Counts against plain loops; learned lists on planted data; the native path."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F
from riskloom.llm import quality


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(2)
    pick = lambda: rng.choice(["a", "b", "c", "É", "d#", "x|y", "n n", "😀"])
    made = ["".join(pick() + rng.choice([" ", " ", "\n", "\t", "\r\n", "  "]) for _ in range(rng.choice([0, 1, 2, 3, 4, 9, 60]))) for _ in range(150)]
    return made + [None, "", "a a a a", "a b c a b c", "\n\nx\nx\n \n \n", "w " * 20000, " ".join(map(str, range(20000))) + " 1 2 3"]


def test_counts(docs):
    given = texts()
    m = F.col("measured")
    rows = quality.measured(docs(list(enumerate(given)))).select("doc_id", m.w.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.w.n_repeat_words)
    assert {r[0]: tuple(r[1:]) for r in rows.collect()} == {i: plain(t) for i, t in enumerate(given)}


def planted(n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(60, 90))]
        kind = i % 4
        if kind == 0:
            words = [x + "###" for x in words]
        if kind == 1:
            words = words[:5] * 15
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if kind < 2 else 1))
    return rows, labels


def test_planted_junk_is_rejected_natively(spark, docs):
    rows, labels = planted()
    df, rules = quality.apply_rules(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.doc_id: (r.kept, r.rule) for r in df.collect()}
    assert all(got[i][0] == bool(q) for i, q in labels)
    assert all((r is None) == kept for kept, r in got.values()) and len(rules) >= 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_first_matching_rule_decides(spark):
    rules = [quality.Rule((quality.Test("n_words", True, 3.0),), 1, 0), quality.Rule((quality.Test("n_words", True, 1.0),), 1, 0)]
    df = quality.measured(spark.createDataFrame([("a b c d",), ("a b",), ("a",)], "text string"))
    assert [tuple(r) for r in df.select(*quality.decision(rules)).collect()] == [(False, 0), (False, 1), (True, None)]


def test_edges(spark, docs):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    df = docs([(1, None), (1, None), (None, "a"), (2, "")])
    out, rules = quality.apply_rules(df, labels)
    assert rules == [] and sorted((r.doc_id is None, r.kept) for r in out.collect()) == [(False, True)] * 3 + [(True, True)]
    out, rules = quality.apply_rules(docs([]), labels)
    assert rules == [] and out.collect() == []
    out, rules = quality.apply_rules(df, labels.where(F.lit(False)))
    assert rules == [] and out.count() == 4
    clash = df.withColumn("measured", F.lit(1)).withColumn("label", F.lit(2)).withColumn("text_", F.lit(3))
    assert quality.apply_rules(clash, labels)[0].count() == 4
