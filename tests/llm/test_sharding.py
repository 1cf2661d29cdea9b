"""Shards against a plain race, movement on growth, and gapless slots."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from riskloom.llm import sharding, slots


def plain(key, weights):
    text = "\u0000null" if key is None else str(key)
    scores = []
    for i, w in enumerate(weights):
        u = (int(hashlib.md5(f"{text}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        if w > 0:
            scores.append((-math.log(u) / w, i))
    return min(scores)[1]


def test_against_a_plain_race(docs):
    df = docs([(i, "") for i in range(400)] + [(None, "x"), (-1, None)])
    for weights in ([1.0] * 16, [1, 0, 3.5], [2.0]):
        got = sharding.assign_shards(df, "doc_id", weights).collect()
        assert all(r.shard == plain(r.doc_id, weights) for r in got) and len(got) == 402


def test_growth_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(20000)
    rows = df.select(sharding.shard_of(F.col("id"), [1] * 16).alias("a"), sharding.shard_of(F.col("id"), [1] * 17).alias("b")).collect()
    moved = [r for r in rows if r.a != r.b]
    assert all(r.b == 16 for r in moved) and 0.045 < len(moved) / len(rows) < 0.075
    share = Counter(r.a for r in rows)
    assert len(share) == 16 and max(share.values()) < 1.2 * 20000 / 16


def test_weights_are_shares(spark):
    n = Counter(r[0] for r in spark.range(20000).select(sharding.shard_of(F.col("id"), [1, 3])).collect())
    assert 0.72 < n[1] / 20000 < 0.78
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [0, 0])


def test_slots_are_gapless(spark, docs):
    rows = [(i % 3, "same") for i in range(60)] + [(None, None)] * 7 + [(0, "same")] * 200
    df = docs(rows, partitions=5).withColumn("part", F.lit(9)).withColumn("first", F.lit(None).cast("int"))
    got = slots.with_slot(df, "doc_id")
    assert got.columns == ["doc_id", "text", "part", "first", "slot"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.slot)
    want = Counter(d for d, _ in rows)
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(n)) for k, n in want.items()}
    assert slots.with_slot(docs([]), "doc_id").collect() == []


def test_shards_are_written(spark, docs, tmp_path):
    df = docs([(i, str(i)) for i in range(50)] + [(None, None)])
    sharding.write_shards(df, "doc_id", [1, 1, 1], str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 51
    with pytest.raises(ValueError):
        sharding.assign_shards(df, "doc_id", [1], "TEXT")
