"""Readers of the driver tables; only the named columns reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.schemas import TABLES


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    df = reader.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
