"""Trained tree ensembles as column expressions: scoring without vectors, inside generated code.

Splits only ask on which side of a threshold a feature lies. So each feature is placed among the thresholds of all
trees once, by a balanced conditional as deep as the logarithm of their number, and the places name one cell of a
grid on which the ensemble is constant. The cells' sums are an array constant that generated code reads by
reference: its size does not grow with the number of trees. Trees whose common grid would be too large are
dealt to several grids, and a tree too large for one of its own becomes nested conditionals.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.numeric import dbl

#: Cells of one grid.
CELLS = 1 << 16


@dataclass(frozen=True)
class Node:
    """A leaf with its ``value``, or a split: rows whose ``feature`` is at most ``threshold`` go ``left``; missing numbers (NaN) go right."""

    value: float
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None

    def splits(self) -> list[tuple[int, float]]:
        if self.left is None or self.right is None:
            return []
        return [(self.feature, self.threshold), *self.left.splits(), *self.right.splits()]


@dataclass(frozen=True)
class Ensemble:
    """Trees over numbered features, and the weight of each in the sum."""

    features: int
    trees: tuple[Node, ...]
    weights: tuple[float, ...]

    def column(self, inputs: Sequence[Column], cells: int = CELLS) -> Column:
        """The weighted sum of the trees for the given feature columns, which must not be null."""
        if len(inputs) != self.features:
            raise ValueError(f"{self.features} feature columns are needed")
        total = None
        for group in self._groups(cells):
            part = self._grid(group, inputs) if _size(self._thresholds(group)) <= cells else self._nested(group[0], inputs)
            total = part if total is None else total + part
        return dbl(0.0) if total is None else total

    def _thresholds(self, group: Sequence[int]) -> list[list[float]]:
        found: list[set[float]] = [set() for _ in range(self.features)]
        for t in group:
            for feature, threshold in self.trees[t].splits():
                found[feature].add(threshold)
        return [sorted(s) for s in found]

    def _groups(self, cells: int) -> list[list[int]]:
        """Trees in order, as many to a group as share a grid of at most so many cells."""
        groups: list[list[int]] = []
        for t in range(len(self.trees)):
            if groups and _size(self._thresholds([*groups[-1], t])) <= cells:
                groups[-1].append(t)
            else:
                groups.append([t])
        return groups

    def _grid(self, group: Sequence[int], inputs: Sequence[Column]) -> Column:
        thresholds = self._thresholds(group)
        shape = tuple(len(t) + 1 for t in thresholds)
        places = np.indices(shape).reshape(self.features, -1)
        sums = np.zeros(places.shape[1])
        for t in group:
            sums += self.weights[t] * _evaluate(self.trees[t], thresholds, places)
        at = F.lit(0)
        for x, known, size in zip(inputs, thresholds, shape):
            at = at * size + _place(x, known, 0, len(known))
        # A JSON text is folded into one array constant.
        return F.get(F.from_json(F.lit(json.dumps(sums.tolist())), "array<double>"), at)

    def _nested(self, t: int, inputs: Sequence[Column]) -> Column:
        def column(node: Node) -> Column:
            if node.left is None or node.right is None:
                return dbl(node.value)
            return F.when(inputs[node.feature] <= dbl(node.threshold), column(node.left)).otherwise(column(node.right))

        return dbl(self.weights[t]) * column(self.trees[t])


def _size(thresholds: Sequence[Sequence[float]]) -> int:
    return int(np.prod([float(len(t) + 1) for t in thresholds]))


def _evaluate(node: Node, thresholds: Sequence[Sequence[float]], places: np.ndarray) -> np.ndarray:
    """Values of a tree in cells, of which ``places`` holds the number of thresholds below each feature."""
    if node.left is None or node.right is None:
        return np.full(places.shape[1], node.value)
    left = places[node.feature] <= bisect_left(thresholds[node.feature], node.threshold)
    return np.where(left, _evaluate(node.left, thresholds, places), _evaluate(node.right, thresholds, places))


def _place(x: Column, thresholds: Sequence[float], low: int, high: int) -> Column:
    """How many of the sorted thresholds are below x, by halves; NaN is above all."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(x <= dbl(thresholds[middle]), _place(x, thresholds, low, middle)).otherwise(_place(x, thresholds, middle + 1, high))


def from_rows(features: int, rows: Sequence[tuple], weights: Sequence[float]) -> Ensemble:
    """An ensemble from node rows (tree, node, value, left, right, feature, thresholds); inner nodes have a feature of 0 or more."""
    held = {(r[0], r[1]): r for r in rows}

    def node(tree: int, at: int) -> Node:
        _, _, value, left, right, feature, thresholds = held[tree, at]
        if feature < 0:
            return Node(value)
        if len(thresholds) != 1:
            raise ValueError("splits by categories are not supported")
        return Node(value, feature, thresholds[0], node(tree, left), node(tree, right))

    return Ensemble(features, tuple(node(t, 0) for t in range(len(weights))), tuple(weights))
