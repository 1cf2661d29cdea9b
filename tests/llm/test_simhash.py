"""Fingerprints and their links against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from riskloom.llm import simhash


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, budget):
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= budget:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {v: top(v) for v in values}


def check(df, budget=2, **kw):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(set(prints), budget)
    low = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            low[root[p]] = min(d, low.get(root[p], d))
    want = Counter((d, p, low.get(root[p])) for (d, _), p in zip(rows, prints))
    got = Counter((r[0], r[1] & (2**64 - 1), r[2]) for r in simhash.near_duplicates(df, budget=budget, **kw).collect())
    assert got == want


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split()
            if words:
                words[rng.randrange(len(words))] = rng.choice(["Alpha", "é", "x"])
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(9)) for _ in range(rng.choice([0, 1, 2, 5, 300]))))
    return out


def test_against_brute_force(docs):
    check(docs([(i, t) for i, t in enumerate(texts(1, 160))]))


def test_nulls_ties_repeats_and_long_texts(docs):
    long = "lorem ipsum dolor " * 30000
    rows = [(5, None), (3, ""), (4, " \t\n"), (None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (1, long), (2, long + "x"), (None, None)]
    check(docs(rows))


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []


def test_clashing_columns_are_ignored(docs):
    df = docs([(1, "a b c", 7), (2, "a b c", 8)], "doc_id long, text string, fp int").withColumnRenamed("fp", "root")
    assert {tuple(r)[2] for r in simhash.near_duplicates(df).collect()} == {1}


@pytest.mark.parametrize("leaf,levels", [(2, 3), (7, 5)])
def test_large_nodes_are_split(spark, leaf, levels):
    rng = random.Random(3)
    values = {0}
    for _ in range(150):  # a ball around zero: every trie has one hot node
        v = rng.choice(sorted(values))
        for _ in range(rng.choice([1, 2, 3])):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r.u & (2**64 - 1), r.v & (2**64 - 1)) for r in simhash.hamming_links(df, 2, leaf, levels).collect()]
    assert all((u ^ v).bit_count() > 0 for u, v in links)
    root = plain_components(values, 2)
    assert all(root[u] == root[v] for u, v in links)
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for u, v in links:
        parent[top(u)] = top(v)
    assert len({top(v) for v in values}) == len(set(root.values()))


def test_node_pairs_met_in_one_task():
    rng = np.random.default_rng(0)
    values = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64) & np.uint64(0xFF000000000000F0))
    i, j = simhash.meet(values, np.array([[0, 60, 0, 60]]), 3)
    found = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    assert found == {(a, b) for a in range(60) for b in range(a + 1, 60) if int(values[a] ^ values[b]).bit_count() <= 3}
