"""One row of each SimHash component against brute force."""

import random

from riskloom.llm import simhash
from test_simhash import plain_components, plain_fingerprint, texts


def brute(rows, budget=2):
    """Keys and texts that stay: per component the smallest key, null keys last."""
    prints = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(set(prints), budget)
    best = {}
    for at, (row, p) in enumerate(zip(rows, prints)):
        mark = (row[0] is None, row[0] or 0)
        if root[p] not in best or mark < best[root[p]][0]:
            best[root[p]] = (mark, at)
    return sorted((rows[at][0] is None, rows[at][0] or 0) for _, at in best.values())


def kept(df, **how):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in simhash.keep_one(df, **how).collect())


def test_one_of_each_component_stays(docs):
    rows = list(enumerate(texts(4, 200)))
    random.Random(1).shuffle(rows)
    assert kept(docs(rows)) == brute(rows)
    assert kept(docs(rows), budget=6, leaf=5) == brute(rows, 6)


def test_nulls_ties_and_repeats(docs):
    rows = [(7, "a b c"), (7, "a b c"), (None, "a b c"), (None, "z"), (None, "z"), (3, None), (2, ""), (9, "q " * 40000)]
    assert kept(docs(rows)) == [(False, 2), (False, 7), (False, 9), (True, 0)]
    assert simhash.keep_one(docs([])).collect() == []


def test_clashing_columns_come_back(docs):
    names = ["fingerprint", "number", "chosen", "fp", "root", "best", "low", "node", "copies", "row node"]
    df = docs([(1, "a b c", *"0123456789"), (2, "a b c", *"abcdefghij")], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = simhash.keep_one(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, "a b c", *"0123456789")]


def test_a_large_group_of_copies_leaves_one(docs):
    rows = [(i, "same words in every one of these texts") for i in range(3000)] + [(5000, "something else altogether here")]
    assert kept(docs(rows, partitions=8)) == [(False, 0), (False, 5000)]
