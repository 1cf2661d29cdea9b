"""Budgets against all subsets, targets against plain sharing, and the mix as a whole."""

import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from riskloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def best_distance(lengths, counts, budget):
    sums = {0}
    for x, n in zip(lengths, counts):
        sums = {s + x * i for s in sums for i in range(n + 1)}
    return min(abs(s - budget) for s in sums)


def test_closest_sums_are_optimal():
    rng = random.Random(0)
    for _ in range(300):
        lengths = rng.sample(range(1, 40), rng.randrange(1, 7))
        counts = [rng.randrange(1, 5) for _ in lengths]
        words = sum(x * n for x, n in zip(lengths, counts))
        budget = rng.randrange(words + 1)
        taken = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= n for t, n in zip(taken, counts))
        assert abs(int((taken * lengths).sum()) - budget) == best_distance(lengths, counts, budget)


def test_large_budgets_are_met_and_shared_by_length():
    rng = np.random.default_rng(1)
    for room in (64, 1000):
        lengths = np.unique(rng.integers(1, 30, 60)) * (1 if room == 64 else 3) + 1
        counts = rng.integers(1, 4000, len(lengths))
        budget = int((lengths * counts).sum() // 3)
        taken = mixing.fit(lengths, counts, budget, room)
        assert (taken <= counts).all() and abs(int((taken * lengths).sum()) - budget) <= 1
        large = counts > 500
        assert np.abs(taken[large] / counts[large] - 1 / 3).max() < 0.2


def test_documents_longer_than_the_room():
    assert mixing.fit([10**6, 10**6 + 1], [5, 5], 3 * 10**6 + 2, room=100).tolist() == [1, 2]
    assert mixing.fit([2 * 10**8], [3], 5 * 10**8).sum() in (2, 3)
    assert mixing.fit([], [], 0).tolist() == [] and mixing.fit([7], [2], 100).tolist() == [2]


def plain_targets(sizes, most=3):
    """Shares by weight; sources above their stop are stopped, the rest is shared again."""
    weight = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    stopped = {}
    while True:
        left = sum(sizes.values()) - sum(stopped.values())
        open_ = [s for s in sizes if s not in stopped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**share, **stopped}
        stopped |= {s: float(most * sizes[s]) for s in over}


def test_targets(spark):
    rng = random.Random(2)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i:02}": rng.choice([0, 1, 5, 400, 90000]) for i in range(n)} | {"\U0001f600": 50, "\ufffd": 70}
        ordered = dict(sorted(sizes.items(), key=lambda x: x[0].encode())) | {None: 33}
        rows = list(ordered.items())
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "source string, source_size long").repartition(5)
        got = {r.source: r.target for r in mixing.with_targets(df).collect()}
        want = plain_targets(ordered)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def table(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "Z", "é"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 17, 17, 17, rng.randrange(1, 300)])) or rng.choice([None, "", " \n"]), source))
    return rows


def test_the_mix_meets_its_targets(docs):
    rows = table(3, 400)
    got = mixing.mix(docs(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == list(range(400))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    ordered = {s: sizes[s] for s in [*sorted((s for s in sizes if s is not None), key=str.encode), None]}
    want, taken = plain_targets(ordered), Counter()
    for r in got:
        assert r.size == len((rows[r.doc_id][1] or "").split()) and r.source_size == sizes[r.source] and 0 <= r.copies <= 3
        assert abs(r.target - want[r.source]) < 1e-6 and (r.size or not r.copies)
        taken[r.source] += r.size * r.copies
    for s in sizes:
        of = [len((t or "").split()) for _, t, x in rows if x == s and (t or "").split()]
        lengths = Counter(of)
        passes = min(round(want[s]) // sizes[s], 3)
        more = round(want[s]) - passes * sizes[s] if passes < 3 else 0
        sums = {0}
        for x, n in lengths.items():
            sums = {a + x * i for a in sums for i in range(n + 1) if a + x * i <= more + 400}
        assert abs(taken[s] - round(want[s])) == min(abs(a - more) for a in sums)


def test_reruns_agree_whatever_the_partitioning(spark, docs):
    rows = table(4, 300)
    once = {r.doc_id: r.copies for r in mixing.mix(docs(rows, SCHEMA)).collect()}
    again = {r.doc_id: r.copies for r in mixing.mix(docs(rows[::-1], SCHEMA, 7)).collect()}
    other = {r.doc_id: r.copies for r in mixing.mix(docs(rows, SCHEMA), seed=12).collect()}
    assert once == again and other != once


def test_nulls_repeats_empty_tables_and_clashes(docs):
    rows = [(None, "a b c", "x"), (None, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", "x"), (2, None, None), (3, "d " * 50000, "y")]
    names = ["size", "copies", "part", "place", "draw", "target", "key", "mixed key"]
    df = docs([(*r, *names) for r in rows], SCHEMA + "".join(f", `{n}` string" for n in names))
    got = mixing.mix(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert {r.source: r.target for r in got} == {"x": 36.0, "y": 50012.0 - 36.0, None: 0.0}
    assert {r.doc_id: r.copies for r in got if r.source != "y"} == {None: 3, 1: 3, 2: 0}
    assert mixing.mix(docs([], SCHEMA)).collect() == []
    unique = df.where("doc_id > 1")
    out = mixing.mixed_rows(unique)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [3]


def test_rows_come_as_often_as_they_are_taken(docs):
    rows = table(5, 120)
    df = docs(rows, SCHEMA).withColumn("copies", F.lit("c"))
    want = {r.doc_id: r.copies for r in mixing.mix(df).collect() if r.copies}
    assert Counter(r.doc_id for r in mixing.mixed_rows(df).collect()) == Counter(want)


def test_every_length_pattern():
    for counts in itertools.product(range(3), repeat=3):
        lengths = [x for x, n in zip((2, 5, 11), counts) if n]
        used = [n for n in counts if n]
        for budget in range(sum(x * n for x, n in zip(lengths, used)) + 1):
            taken = mixing.fit(lengths, used, budget, room=8)
            assert all(0 <= t <= n for t, n in zip(taken, used)) and abs(int((taken * lengths).sum()) - budget) <= 11
