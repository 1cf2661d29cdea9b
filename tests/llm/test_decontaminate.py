"""Benchmark windows in texts against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F
from riskloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text, items, size):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    spans = [m.span() for m in WORD.finditer(low)]
    words = [low[a:b] for a, b in spans]
    hit, ids = set(), set()
    for item, t in items:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            part = w[i : i + size]
            for at in range(len(words) - len(part) + 1):
                if words[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids), [spans[i] for i in sorted(hit)]


def make(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "Beta", "gämma", "x1", "2024", "ñu", "to"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 6, 9])))) for i in range(8)] + [(99, None), (3, "alpha, beta; x1")]
    texts = ["".join(word() + rng.choice([" ", "\n", ", ", "--", "é "]) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(40)]
    return items, texts + [None, "", "zz " + items[4][1].upper() + "!", "lone " * 50000 + (items[5][1] or "")]


@pytest.mark.parametrize("block", [64 << 20, 60])
def test_against_brute_force(spark, docs, block):
    items, texts = make(5)
    df = decontaminate.find_items(
        docs(list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string"), size=4, block_bytes=block
    ).withColumn("n_hit", decontaminate.hit_words())
    for r in df.collect():
        n, hit, ids, spans = plain(r.text, items, 4)
        assert (r.found.n_words, r.n_hit, list(r.found.items)) == (n, hit, ids)
        inside = list(zip(r.found.spans[::2], r.found.spans[1::2]))
        assert all(any(a <= s and e <= b for a, b in inside) for s, e in spans)
        assert sum(len(WORD.findall(r.text[a:b].lower())) for a, b in inside) == hit


def test_edges(spark, docs):
    tests = spark.createDataFrame([(None, "a b c"), (7, "")], "item_id long, text string")
    df = docs([(1, "a b c", "x"), (None, None, "y"), (1, "a b c", "x")], "doc_id long, text string, found string")
    with pytest.raises(ValueError):
        decontaminate.find_items(df, tests)
    assert sorted(map(str, decontaminate.clean_rows(df, tests).collect())) == sorted(map(str, df.collect()))
    tests = spark.createDataFrame([(7, "b C"), (7, "b C")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.clean_rows(df, tests).collect()] == [(None, None, "y")]
    assert decontaminate.clean_rows(docs([]), tests).columns == ["doc_id", "text"]
    assert decontaminate.find_items(docs([(1, "b c")]), tests.where(F.lit(False))).first().found.items == []
