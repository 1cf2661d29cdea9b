"""Boundaries against all choices, and batches that hold every token."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from riskloom.llm import packing


def padding(histogram, ends):
    return sum((min(e for e in ends if e >= n) - n) * c for n, c in histogram.items())


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(0, 40): rng.randrange(1, 9) for _ in range(9)}
    top = max(histogram)
    for k in (1, 2, 3, 20):
        plan = packing.plan_buckets(histogram, k)
        ways = [(*c, top) for m in range(min(k, len(histogram))) for c in itertools.combinations(sorted(histogram)[:-1], m)]
        assert padding(histogram, plan.boundaries) == plan.padding == min(padding(histogram, w) for w in ways)
        assert len(plan.boundaries) <= k and plan.boundaries[-1] == top


def test_every_token_is_packed_once(docs):
    rng = random.Random(1)
    rows = [(i, " ".join(f"t{i}_{j}" for j in range(rng.choice([1, 2, 5, 17, 40, 130])))) for i in range(60)]
    rows += [(None, "a b"), (7, None), (8, ""), (9, "same same"), (9, "same same")]
    df = docs(rows, partitions=4).withColumn("bucket", F.lit("x")).withColumn("key", F.lit(0))
    out, plan = packing.pack(df, context=32, budget=64, buckets=3, with_tokens=True)
    got = out.collect()
    assert sorted(t for r in got for t in r.tokens) == sorted(t for _, text in rows for t in (text or "").split())
    assert all(r.n_tokens == len(r.tokens) <= 32 and r.padded_to >= r.n_tokens and r.start == 32 * r.piece for r in got)
    assert all(r.padded_to == plan.boundaries[r.bucket] and (r.bucket == 0 or plan.boundaries[r.bucket - 1] < r.n_tokens) for r in got)
    assert sum(r.padded_to - r.n_tokens for r in got) == plan.padding
    for b, end in enumerate(plan.boundaries):
        holds = max(1, 64 // max(end, 1))
        places = sorted((r.batch, r.place) for r in got if r.bucket == b)
        assert places == [divmod(i, holds) for i in range(len(places))]
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.piece)):
        by_doc.setdefault(r.doc_id, []).extend(r.tokens)
    assert all(by_doc[i] == text.split() for i, text in rows[:60] if i not in (7, 8, 9))


def test_other_tokens_and_no_rows(docs):
    df = docs([(1, "abc")])
    out, _ = packing.pack(df, tokens=F.split("text", ""), context=2)
    assert sorted(r.n_tokens for r in out.collect()) == [1, 2]
    out, plan = packing.pack(docs([]))
    assert out.collect() == [] and plan == packing.Plan((1,), 0)
