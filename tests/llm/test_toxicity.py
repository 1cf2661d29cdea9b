"""The models against plain counts, and held-out accuracy on planted words."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskloom.llm import toxicity as T

TEXTS = [("you awful thing, awful day", 1), ("you awful man", 1), ("a good day for you", 0), ("a good man you know", 0), ("a good man you know", 0), ("day", 0), (None, 1), ("", 0)]


def plain_expressions(texts):
    pairs, before, n = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for text, c in texts:
        w = T.tokens(text)
        pairs[c].update(zip(w, w[1:]))
    for c in (0, 1):
        before[c].update(w for _, w in pairs[c])
        for w, k in before[c].items():
            for p in {(w + T.END)[:size] for size in range(T.SPELLED + 1)} | {w + T.END}:
                n[c][p] += k
    out = {}
    total = [sum(before[c].values()) for c in (0, 1)]
    for p in {*n[0], *n[1]} - {""}:
        chances = []
        for c in (0, 1):
            once, twice = (sum(1 for k in before[c].values() if k == x) for x in (1, 2))
            d = once / (once + 2 * twice) if once else 0.5
            chances.append(max(n[c][p] - d, 0) / total[c] + d * len(before[c]) / total[c] * (n[0][p] + n[1][p]) / sum(total))
        up = p[: min(len(p) - 1, T.SPELLED)]
        expected = n[1][up] * (n[0][p] + n[1][p]) / (n[0][up] + n[1][up])
        out[p] = (math.log(chances[1] / chances[0]), (n[1][p] - expected) / math.sqrt(expected * n[0][up] / (n[0][up] + n[1][up]) + 0.25))
    return out


def test_expressions_against_plain_counts(spark):
    got = {r.start: (r.ratio, r.deviation) for r in T.expressions(spark.createDataFrame(TEXTS, "text string, label int").repartition(3)).collect()}
    want = plain_expressions(TEXTS)
    assert set(got) == set(want)
    for p in want:
        assert got[p] == pytest.approx(want[p], rel=1e-9, abs=1e-9)


def test_a_word_says_what_its_longest_kept_expression_does():
    ratios = {"a": 0.5, "awf": 2.0, "awful$": 3.0}
    assert [T.word_ratio(ratios, w) for w in ("awful", "awfully", "axe", "b")] == [3.0, 2.0, 0.5, 0.0]


def test_words_are_read_whole(spark):
    """Words that share far more than the spelled beginning, words of any length, and scripts without blanks."""
    long = "unmistakablylongword"
    texts = [(f"the {long}bad of day", 1), (f"a {long}good day", 0), (f"a {long}good man", 0), ("x" * 5000 + " y " + "x" * 4999 + "z you", 1), ("你好世界 你坏", 0)]
    got = {r.start: (r.ratio, r.deviation) for r in T.expressions(spark.createDataFrame(texts, "text string, label int").repartition(2)).collect()}
    want = plain_expressions(texts)
    assert set(got) == set(want) and f"{long}bad$" in got and f"{long}good$" in got
    for p in want:
        assert got[p] == pytest.approx(want[p], rel=1e-9, abs=1e-9)
    assert T.tokens("ab你好c d_e1f ไทย Ünï") == ["ab", "你", "好", "c", "d", "e", "f", "ไ", "ท", "ย", "ünï"]
    ratios = {long[: T.SPELLED]: 0.5, f"{long}bad$": 2.0}
    assert [T.word_ratio(ratios, w) for w in (f"{long}bad", f"{long}good", long[:5])] == [2.0, 0.5, 0.0]


def test_words_with_equal_32_bit_hashes_stay_apart():
    import xxhash

    assert T.word_hash("a") == xxhash.xxh64_intdigest("a") - 2**63 and -(2**63) <= T.word_hash("zzz") < 2**63


def corpus(n=700):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('klmnp')}{rng.choice('aeiou')}" for _ in range(rng.randrange(20, 90))]
        bad = i % 3 == 0
        for _ in range(4 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["vile", "nasty", "grimzix", "grimzoo", "grimzap"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus()
    df = docs(rows)
    model = T.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r[0]: r[1] for r in df.select("doc_id", T.score(df, model)).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == bool(labels[i][1]) for i in held) >= 0.95 * len(held)
    # The labels of held-out rows are not read.
    other = [(i, 1 - y if i in held else y) for i, y in labels]
    again = T.train(df, spark.createDataFrame(other, "doc_id long, toxic int"))
    assert again.ratios == model.ratios and np.allclose(again.weights, model.weights)


def test_one_label_per_key(spark, docs):
    df = docs([(1, "a b"), (1, "a b"), (2, None), (None, "c")]).toDF("key", "text")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 0, 1), (None, 1, 0), (9, 1, 1)], "key long, label int, part int")
    for most in (100, 0):  # broadcast, shuffled
        got = sorted(map(tuple, T.labelled_texts(df, labels, most).collect()), key=str)
        assert got == [("a b", 1, 0), ("a b", 1, 0), (None, 0, 1)]


def test_edges(spark, docs):
    df = docs([(1, None), (1, ""), (None, "word " * 50000)], "doc_id long, text string").withColumn("label", F.lit(3)).withColumn("score", F.lit(1))
    for labels in ([], [(1, 1)], [(None, 1), (1, None)]):
        model = T.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores = [r[0] for r in df.select(T.score(df, model)).collect()]
        assert len(scores) == 3 and all(0 <= s <= 1 for s in scores)
    assert docs([]).select(T.score(docs([]), model)).collect() == []


def test_all_telling_expressions_are_kept(docs, monkeypatch):
    """Also the least telling one, whatever their number."""
    monkeypatch.setattr(T, "KEPT", 3, raising=False)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    rows = [(" ".join(f"{rng.choice(words)} {rng.choice(words[c * 30 : c * 30 + 30])}" for _ in range(60)), c) for c in (0, 1) for _ in range(60)]
    labelled = docs(rows, "text string, label int")
    telling = T.expressions(labelled).where((F.abs("deviation") >= T.DEVIATIONS) & (F.col("n0") + F.col("n1") >= T.LEAST))
    expected = {r.start for r in telling.collect()}
    assert len(expected) > 3 and set(T.count_model(labelled).ratios) == expected
