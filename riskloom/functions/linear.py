"""Scores that are bounded weighted sums, with their weights known to operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class BoundedLine:
    """A model whose ``score`` is ``constant`` and ``slopes`` times the features, bounded to 0..1; features that are no finite numbers count as 0."""

    score: Callable[[DataFrame], Column]
    constant: float
    slopes: Mapping[str, float]

    def __call__(self, df: DataFrame) -> Column:
        return self.score(df)
