"""A training corpus from raw documents: five stages over the table ``documents``, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from riskloom.llm import decontaminate, packing, pii, simhash, toxicity
from riskloom.llm.common import small_batches
from riskloom.sources.store import materialise
from riskloom.sources.tables import read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject, at a score of 0.5."""
    small_batches(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return docs.where(toxicity.score(docs, model) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, fingerprints at most two bits apart."""
    small_batches(spark)
    return simhash.keep_one(docs, k=3, budget=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    small_batches(spark)
    return decontaminate.clean_rows(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; the number of characters follows the new text."""
    small_batches(spark)
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length-bucketed batches of the texts' pieces, with their text."""
    small_batches(spark)
    packed, _ = packing.pack(docs, with_text=True)
    return packed


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL has neither the models nor the fingerprints; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder of tables."""
    docs = read(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialise(docs, f"corpus_{name}")
    return docs
