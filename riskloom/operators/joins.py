"""Equi-joins, lookups and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import dbl


def customer_feature_view(customers: DataFrame, features: DataFrame) -> DataFrame:
    """Customers with their features; customers without features are left out."""
    return customers.join(features.withColumnRenamed("created_at", "feature_created_at"), "customer_id")


def dataset_view(df: DataFrame, name: str) -> DataFrame:
    """Register a frame under a name and read it back through SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def active_model(registry: DataFrame) -> Column:
    """Version of the active model as a scalar, NULL when none is; the lowest version if several are."""
    return registry.where("is_active").agg(F.min("model_version")).scalar()


def with_active_model(df: DataFrame, registry: DataFrame, fallback: str | None = K.UNKNOWN_MODEL) -> DataFrame:
    """Rows stamped with the active model; without one, the fallback or (``None``) an error."""
    version = active_model(registry)
    missing = F.raise_error("no active model in the registry") if fallback is None else F.lit(fallback)
    return df.withColumn("model_version", F.coalesce(version, missing.cast("string")))


def score_lookup(ids: DataFrame, features: DataFrame) -> DataFrame:
    """Stored score per requested id, 0 where there is none."""
    scores = features.select("customer_id", "risk_score")
    return ids.join(scores, "customer_id", "left").withColumn("risk_score", F.coalesce("risk_score", dbl(0.0)))


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row; child rows without a key reference nothing."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def features_with_attributes(features: DataFrame, attributes: DataFrame) -> DataFrame:
    """Features next to the raw attributes the rules need."""
    return features.join(attributes, "customer_id")
