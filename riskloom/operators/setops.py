"""Unions and removal of empty rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_frames(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_all_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna(how="all", subset=columns)
