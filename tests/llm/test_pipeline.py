"""The pipeline on planted documents, stage by stage and as a whole."""

import random

import corpus_pipeline
from riskloom.llm import decontaminate, toxicity
from riskloom.sources.store import scratch_path
from test_simhash import plain_components, plain_fingerprint

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    texts = [[word() for _ in range(rng.randrange(60, 140))] for _ in range(260)]
    toxic = set(range(0, 200, 4))
    for i in toxic:
        for _ in range(6):
            texts[i][rng.randrange(len(texts[i]))] = rng.choice(["scumbag", "vermin", "imbecile"])
    items = [[word() for _ in range(15)] for _ in range(5)]
    texts[201][10:10] = items[0]
    texts[202] = ["mail", "me@some.example.org", *texts[202]]
    texts += [list(texts[203]), [*texts[204][:30], "changed", *texts[204][30:]]]  # an exact copy, and one too far in bits
    docs = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)] + [(900, None, None, None, None), (901, "", "en", "s", 0)]
    path = scratch_path(spark, "pipeline_tables")
    spark.createDataFrame(docs, DOCUMENT).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(200)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, toxic


def stay(kept, rows):
    """The smallest id of each component of fingerprints at most two bits apart."""
    prints = {d: plain_fingerprint(t) for d, t, *_ in rows if d in kept}
    root = plain_components(set(prints.values()), 2)
    return {min(d for d in prints if root[prints[d]] == r) for r in set(root.values())}


def test_stages_take_effect_and_keep_clean_documents(spark):
    path, rows, toxic = tables(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    sets, texts = [], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = docs.collect()
        sets.append({r.doc_id for r in kept})
        texts = {r.doc_id: r.text for r in kept}
    clean = {r[0] for r in rows} - toxic
    assert not sets[0] & toxic and len(clean - sets[0]) <= 2
    assert {203, 260} & sets[1] == {203} and sets[1] == stay(sets[0], rows)
    assert sets[1] - sets[2] == {201}
    assert sets[3] == sets[2] and texts[202].startswith("mail [EMAIL] ") and texts[210] == rows[210][1]
    packed = corpus_pipeline.run(spark, path)
    by = {}
    for r in sorted(packed.collect(), key=lambda r: (r.doc_id, r.piece)):
        by.setdefault(r.doc_id, []).extend(r.text.split())
    assert by == {d: (t or "").split() for d, t in texts.items()}


def test_rows_against_a_brute_force_pipeline(spark):
    """From the model's scores on: plain sets and loops instead of fingerprints, automata and patterns."""
    path, rows, _ = tables(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    scores = dict(docs.select("doc_id", toxicity.score(docs, model)).collect())
    left = [(d, t or "") for d, t, *_ in rows if scores[d] < 0.5]
    ids = stay({d for d, _ in left}, rows)
    kept = [(d, t) for d, t in left if d in ids]
    items = [r.text for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    windows = [set(decontaminate.item_windows([("i", x)], 10)) for x in items]
    pure = [(d, t) for d, t in kept if not any(w in f" {t} ".encode() for ws in windows for w in ws)]
    want = sorted((d, t.replace("me@some.example.org", "[EMAIL]").split()) for d, t in pure)
    got = {}
    for r in sorted(corpus_pipeline.run(spark, path).collect(), key=lambda r: r.piece):
        got.setdefault(r.doc_id, []).extend(r.text.split())
    assert sorted(got.items()) == want


def test_an_empty_table_passes_through(spark):
    path, *_ = tables(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.collect() == []
