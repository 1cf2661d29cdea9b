"""Stored models: written once, digested, registered, and loaded by later runs.

Each model is a folder of its own; the registry is a published table beside them, so registering and activating are
all or nothing, and of two writers at one time one is told to try again. A model is loaded only if its
files still have the digest that was registered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.load import model_metadata
from riskloom.sources.published import publish, version
from riskloom.sources.store import path_exists, remove_path

REGISTRY = (
    "model_version string, model_type string, model_hash string, folder string, features array<string>, feature_version string, "
    "dataset_version string, trained_at string, training_rows bigint, is_active boolean"
)


class ModelStore:
    """Models and their registry below one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    @property
    def _table(self) -> str:
        return f"{self.path}/registry"

    def registry(self) -> DataFrame:
        """One row per model; empty where nothing is registered."""
        held = version(self.spark, self._table)
        return held.read(self.spark) if held is not None else self.spark.createDataFrame([], REGISTRY)

    def save(
        self, model: PipelineModel, name: str, features: Sequence[str], trained_at: str, training_rows: int,
        versions: Mapping[str, str] | None = None, active: bool = True,
    ) -> Row:
        """Write a fitted pipeline and register it under a new version name, as the active one unless told otherwise."""
        held = version(self.spark, self._table)
        folder = f"{self.path}/models/{name}"
        if path_exists(self.spark, folder):
            raise ValueError(f"model {name} exists")
        model.write().save(folder)
        try:
            known = {"feature_version": "v2_safe", "dataset_version": "v1.0"} | dict(versions or {})
            kind = type(model.stages[-1]).__name__
            facts = model_metadata(self.spark, folder, list(features), kind, trained_at, known["feature_version"], known["dataset_version"])
            row = facts.select(
                F.lit(name).alias("model_version"), "model_type", "model_hash", F.lit(folder).alias("folder"), "features", "feature_version",
                "dataset_version", "trained_at", F.lit(training_rows).cast("bigint").alias("training_rows"), F.lit(active).alias("is_active"),
            )
            others = self.registry().withColumn("is_active", F.col("is_active") & F.lit(not active))
            publish(others.unionByName(row).coalesce(1), self._table, after=held.number if held else 0)
        except BaseException:
            remove_path(self.spark, folder)
            raise
        return self.row(name)

    def activate(self, name: str) -> None:
        """Make a registered model the only active one."""
        held = version(self.spark, self._table)
        self.row(name)
        publish(self.registry().withColumn("is_active", F.col("model_version") == name).coalesce(1), self._table, after=held.number if held else 0)

    def row(self, name: str | None = None) -> Row:
        """The registry's row of a model, or of the active one."""
        wanted: Column = F.col("is_active") if name is None else F.col("model_version") == name
        found = self.registry().where(wanted).collect()
        if len(found) != 1:
            raise ValueError("no active model in the registry" if name is None else f"model {name} is not registered")
        return found[0]

    def load(self, name: str | None = None) -> tuple[PipelineModel, Row]:
        """A model, by default the active one, and its row; files that have changed since it was registered are an error."""
        row = self.row(name)
        found: dict[str, Any] = model_metadata(self.spark, row.folder, row.features, row.model_type, row.trained_at, "", "").first().asDict()
        if found["model_hash"] != row.model_hash:
            raise ValueError(f"model {row.model_version} has changed since it was registered")
        return PipelineModel.load(row.folder), row

