"""Aggregates of a whole frame as constants of later plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constants(aggregated: DataFrame) -> dict[str, Column]:
    """Numbers of a one-row aggregate as typed literals.

    What comes to the driver is one row, its width fixed by the query. Later plans
    hold plain constants: no subquery is planned again for every place that uses one.
    """
    row = aggregated.first()
    return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in aggregated.schema.fields}
