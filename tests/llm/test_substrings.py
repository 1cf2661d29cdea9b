"""Removed words against a plain count of windows."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskloom.llm import substrings as S


def plain(texts, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    word = lambda: rng.choice(["é", "A", "a"]) + str(rng.randrange(vocabulary))
    shared = [[word() for _ in range(rng.randrange(8, 90))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += rng.choice(shared) if rng.random() < 0.4 else [word() for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.1:
            parts = parts[:3] * 40
        texts.append("".join(w + rng.choice([" ", "\n", " \t"]) for w in parts))
    return texts + texts[:5] * 3 + [None, "", "w " * 300, "once " + " ".join(map(str, range(200)))]


def check(docs, texts, width, **how):
    df = docs(list(enumerate(texts)), partitions=4)
    got = S.remove_repeats(df, width=width, **how).select("doc_id", "substrings.*").collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == dict(enumerate(plain(texts, width)))
    return got


@pytest.mark.parametrize("seed,width,vocabulary,hot", [(1, 35, 400, 5000), (2, 12, 30, 5000), (3, 12, 30, 3), (4, 35, 3, 1)])
def test_against_plain_counts(docs, seed, width, vocabulary, hot):
    check(docs, corpus(seed, vocabulary=vocabulary), width, hot=hot)


@pytest.mark.parametrize("words", [1, 3, 20, 500])
def test_repeats_inside_one_text(docs, words):
    texts = [" ".join(str(i % words) for i in range(36 + words))]
    assert check(docs, texts, 35)[0].n_removed > 0
    check(docs, ["a " * 35, "b " * 36], 35)


def test_long_texts_are_read_in_parts(docs, monkeypatch):
    monkeypatch.setattr(S, "PART", 50)
    monkeypatch.setattr(S, "INDEX_WORDS", 300)
    check(docs, corpus(7), 12)


def test_text_and_gaps(docs):
    part = " ".join(f"p{i}" for i in range(5))
    df = docs([(1, f"a b {part} c"), (2, f"{part}  z"), (None, "x\ty")]).withColumn("id", F.lit(1)).withColumn("size", F.lit("s")).withColumn("anchor", F.lit(0))
    got = {r.doc_id: r for r in S.remove_repeats(df, width=5, with_text=True).collect()}
    assert got[1].substrings.kept == "a b c" and got[1].substrings.removed == [2, 7] and got[2].substrings.kept == "z" and got[None].substrings.kept == "x y"
    assert set(got[1].asDict()) == {*df.columns, "substrings"}
    assert S.remove_repeats(docs([])).collect() == []
    with pytest.raises(ValueError):
        S.remove_repeats(df, name="ID")


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 400).astype(np.uint64)
    twice = np.concatenate([h[:100], h[30:90], h[100:]])
    a, c, first, n, several = S.anchored_pieces(twice, 35)
    at = {int(s) + i: int(x) for x, s, k in zip(a, first, n) for i in range(k)}
    assert len(at) == len(twice) - 34 and all(at[30 + i] == at[100 + i] for i in range(26)) and n.max() <= 28 and not several.any()


def test_blocks_without_repeats(docs, monkeypatch):
    monkeypatch.setattr(S, "INDEX_WORDS", 20)
    same = " ".join(f"s{i}" for i in range(20))
    check(docs, [f"{' '.join(f'x{k}_{i}' for i in range(40))} {same} {' '.join(f'y{k}_{i}' for i in range(40))}" for k in range(12)], 35)


def test_clashing_columns(docs):
    names = ["found ranges", "ranges", "id", "size", "packed", "anchor", "piece"]
    df = docs([(i, " ".join(f"w{k}" for k in range(60)), *names) for i in range(2)], "doc_id long, text string" + "".join(f", `{n}` string" for n in names))
    rows = S.remove_repeats(df).collect()
    assert {tuple(r)[2:-1] for r in rows} == {tuple(names)} and {r.substrings.n_removed for r in rows} == {60}
