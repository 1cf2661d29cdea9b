"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import alignment, chat, clustering, decontaminate, mixing, packing, pii, quality, sharding, simhash, slots, substrings, toxicity, wrapper
from riskloom.llm.common import small_batches
from riskloom.sources.tables import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NORMAL_WORDS = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_NORMAL_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_NORMAL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS pos FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[pos:pos + least(len(w), 10) - 1], ' ') AS s FROM p),
lens AS (SELECT DISTINCT n FROM win),
dp AS (SELECT r, n, w, unnest(range(1, greatest(len(w) - n + 2, 1))) AS pos FROM d, lens),
occ AS (SELECT DISTINCT r, dp.n, pos, item FROM dp JOIN win ON dp.n = win.n AND array_to_string(w[pos:pos + dp.n - 1], ' ') = s),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS x FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


@query("op6_benchmark_decontamination", DECONTAMINATION_SQL)
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.find_items(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "found.n_words", decontaminate.hit_words().alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"), (F.size("found.items") > 0).alias("contaminated"),
    )


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.col("pii.base")
    counts = [F.size(F.filter(base, pii.is_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("pii.spans")).alias("spans"))


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    judged, _ = quality.apply_rules(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    n, repeated = F.col("measured.w.n_words"), F.col("measured.w.n_repeat_words")
    failed = (n < 50) | (100 * repeated > 50 * n)
    return judged.select(
        "doc_id", n.alias("n_words"), "measured.word_chars", "measured.n_symbols", "measured.n_dup_lines", repeated.alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"), "rule",
    )


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    # Nothing is learnt from documents without an id: they are held out.
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(True))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


SHARDS = 16


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    placed = sharding.assign_shards(docs, "doc_id", [1.0] * SHARDS)
    digests = placed.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard",
        sharding.shard_of(F.col("doc_id"), [1.0] * (SHARDS + 1)).alias("grown_shard"),
    )
    return slots.with_slot(digests, "shard")


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed, _ = packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))
    return packed


@query("op8_chat_formatting")
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    formatted = chat.format_conversations(turns.unionByName(probe))
    return formatted.select("conv_id", chat.digests(F.col("formatted"), F.col("loss")).alias("d")).select("conv_id", "d.*")


@query("op9_html_extraction")
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wrapper.main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "substrings.n_words", "substrings.n_removed", "substrings.kept_sha256")


CENTROIDS, ROUNDS, DIMENSION = 8, 10, 64


def _clustering_sql() -> str:
    """The rounds one after the other, as common table expressions over (row, component, integer)."""
    rounds = []
    for at in range(ROUNDS + 1):
        rounds.append(
            f"d{at} AS (SELECT r, cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{at} c USING (i) GROUP BY r, cluster),\n"
            f"a{at} AS MATERIALIZED (SELECT r, cluster, d FROM d{at} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1)"
        )
        if at < ROUNDS:
            rounds.append(
                f"m{at} AS (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM a{at} JOIN v USING (r) GROUP BY cluster, i),\n"
                f"c{at + 1} AS MATERIALIZED (SELECT cluster, i, CASE WHEN n IS NULL THEN x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x "
                f"FROM c{at} LEFT JOIN m{at} USING (cluster, i))"
            )
    return (
        f"WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSION} "
        "AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = len(embedding)),\n"
        f"v AS MATERIALIZED (SELECT r, i, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM e, range(1, {DIMENSION + 1}) t(i)),\n"
        f"f AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM e QUALIFY cluster < {CENTROIDS}),\n"
        "c0 AS MATERIALIZED (SELECT cluster, i, x FROM f JOIN v USING (r)),\n" + ",\n".join(rounds) + ",\n"
        f"h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)\n"
        "SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,\n"
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{ROUNDS} JOIN e USING (r) JOIN h USING (cluster)"
    )


@query("op13_centroid_clustering", _clustering_sql())
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return clustering.with_inertia(clustering.cluster(vectors, k=CENTROIDS, rounds=ROUNDS, dimension=DIMENSION))


@query("op11_mixing")
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


TOKENIZERS = "/opt/tokenizers"


@query("op12_cross_tokenizer_alignment")
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    aligned, _ = alignment.align_corpus(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return aligned
