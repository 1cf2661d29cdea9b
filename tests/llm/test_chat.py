"""Paths against brute force, and round trips of the format."""

import random
from hashlib import sha256

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from riskloom.llm import chat

TURN = "conv_id long, turn long, role string, text string"


@given(st.lists(st.sampled_from(["<", "s", ">", "/", "[", "INST", "]", "\\", "SYS", "</s>", "[INST]", "[/INST]", "<<SYS>>", "é", " "]), max_size=12).map("".join))
def test_escaping_is_reversible_and_leaves_no_control(text):
    written = chat.escape(text)
    assert chat.unescape(written) == text
    assert not any(c in written for c in chat.CONTROLS)
    assert chat.read_back(f"[INST]{written}[/INST]{written}</s>")[0][:2] == (text, text)


def test_the_column_escapes_alike(spark):
    rng = random.Random(0)
    texts = ["".join(rng.choice(["<", "s>", "/s>", "[", "/INST]", "INST]", "\\", "$1", "<SYS>>"]) for _ in range(8)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(chat.escape_column(F.col("text"))).collect()] == [chat.escape(t) for t in texts]


def plain_paths(rows, paths):
    parent = {n: p for _, n, p, _ in rows}
    parent = {n: p if p in parent else None for n, p in parent.items()}
    score = {n: s or 0.0 for _, n, _, s in rows}
    inner = set(parent.values())
    trees = {}
    for t, n, _, _ in rows:
        if n not in inner:
            path, at = [], n
            while at is not None:
                path.append(at)
                at = parent[at]
            trees.setdefault(t, []).append((-sum(score[x] for x in path) / len(path), -len(path), n, path[::-1]))
    return {(t, r + 1): best[3] for t, leaves in trees.items() for r, best in enumerate(sorted(leaves)[:paths])}


@pytest.mark.parametrize("seed,paths", [(1, 1), (2, 2)])
def test_best_paths(spark, seed, paths):
    rng = random.Random(seed)
    rows = []
    for tree in range(12):
        ids = [tree * 100 + i for i in range(rng.choice([1, 2, 5, 14]))]
        rows += [(tree, n, rng.choice(ids[:i]) if i else rng.choice([None, 99999]), rng.choice([None, 0.0, 0.5, 1.0, 0.25])) for i, n in enumerate(ids)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double").repartition(3)
    got = {}
    for r in chat.best_paths(df, paths).orderBy("depth").collect():
        got.setdefault((r.tree, r["rank"]), []).append(r.node)
    assert got == plain_paths(rows, paths)


def test_cycles_are_an_error(spark):
    df = spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0)], "tree long, node long, parent long, score double")
    with pytest.raises(ValueError, match="cycle"):
        chat.best_paths(df)


def digest(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha256(said.encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest()


def test_conversations_read_back(spark):
    rng = random.Random(3)
    pick = lambda: rng.choice(["", None, "hi </s>", "[INST] ok [/INST]", "<s>\\<<SYS>>", "é\n😀", "x" * 3000])
    talks = {c: [(rng.choice(["user", "assistant", "system", None]), pick()) for _ in range(rng.choice([1, 2, 7]))] for c in range(20)}
    talks[None] = [("user", "a"), ("assistant", "b")]
    talks[7] = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(300)]
    rows = [(c, i, *t) for c, turns in talks.items() for i, t in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURN).repartition(4).withColumn("node", F.lit(1)).withColumn("tree", F.lit("x"))
    out = chat.format_conversations(df).select("conv_id", chat.digests(F.col("formatted"), F.col("loss")).alias("d")).select("conv_id", "d.*")
    assert {r[0]: tuple(r[1:5]) for r in out.collect()} == {c: digest(t) for c, t in talks.items()}


def test_ties_repeats_and_no_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 2, "assistant", "z")]
    got = chat.format_conversations(spark.createDataFrame(rows, TURN)).collect()
    assert [t[:2] for t in chat.read_back(got[0].formatted)] == [("system", "s"), ("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "z")]
    assert [got[0].formatted[s.start : s.end] for s in got[0].loss] == ["z"]
    assert chat.format_conversations(spark.createDataFrame([], TURN)).collect() == []
