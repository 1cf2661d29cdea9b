"""Integer k-means whose candidate centroids are filtered by an n-simplex projection.

Some fixed vectors serve as pivots. The distances of a vector to all pivots are the edges
of a simplex over the pivots' base; its apex is the vector's place inside the pivots' span
and its height above it. Apexes are computed once and cached with the vectors. For two apexes with places p, q and heights g, h
the true distance lies between the roots of |p - q|² + (g - h)² and |p - q|² + (g + h)².
A centroid whose lower bound exceeds the smallest upper bound is not the nearest one; only the
others are compared with the vector, in exact integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.sources.store import materialise

#: Components up to this size have differences, squares and sums of up to 256 squares inside 64 bits.
SMALL = 1 << 26
#: Bits of the lower half of a component sum; each half is summed as a decimal.
HALF = 60
#: Bases of a larger condition number would blow rounding errors up towards the margin of the bounds.
STEADY = 1000.0


def _integers(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, exactly: int64, or Python integers where some are large."""
    scaled = rows * float(scale)
    if not len(rows) or np.abs(scaled).max() <= SMALL:
        return np.floor(scaled).astype(np.int64)
    # A double of 2**53 or more is an integer itself; below, scaling by a power of two keeps every bit.
    exact = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in rows.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(rows.shape)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer arrays of one shape."""
    apart = a - b
    return (apart * apart).sum(axis=1)


def _doubles(exact: np.ndarray) -> np.ndarray:
    """Exact integers as doubles, those beyond all doubles as infinity."""
    return exact.astype(float) if exact.dtype != object else np.array([float(x) if x.bit_length() < 1000 else math.inf for x in map(int, exact)])


def _narrow(values: np.ndarray) -> np.ndarray:
    """Integers as int64 where all are small enough for exact squares."""
    small = values.dtype == object and all(abs(x) <= SMALL for x in values.ravel().tolist())
    return values.astype(np.int64) if small else values


@dataclass(frozen=True)
class Simplex:
    """Pivots, and the base that their mutual distances span: row i holds pivot i's place by the axes before it and its height."""

    pivots: np.ndarray
    base: np.ndarray

    @classmethod
    def over(cls, vectors: np.ndarray) -> Simplex:
        """The simplex over some integer vectors; a vector (almost) inside the span of those before it is left out."""
        kept: list[np.ndarray] = []
        base = np.zeros((0, 0))
        for v in vectors:
            edges = np.sqrt(np.concatenate([_doubles(_squared(v[None], p[None])) for p in kept])) if kept else np.zeros(0)
            place, height = cls(np.array(kept), base)._apex(edges[None, :]) if kept else (np.zeros((1, 0)), np.zeros(1))
            if kept and not height[0] > edges.max() / STEADY:
                continue
            grown = np.zeros((len(kept) + 1, len(kept)))
            if kept:
                grown[:-1, :-1] = base
                grown[-1, :-1], grown[-1, -1] = place[0], height[0]
                if np.linalg.cond(grown[1:]) > STEADY:
                    continue
            kept.append(v)
            base = grown
        return cls(np.array(kept), base)

    def _apex(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and heights of points from their distances to the pivots, one axis after the other."""
        n = len(self.base)
        place, first = np.zeros((len(edges), max(n - 1, 0))), edges[:, 0] ** 2
        for i in range(1, n):
            corner = self.base[i, :i]
            # |x - pivot 0|² - |x - pivot i|² = 2 x·corner - |corner|², and pivot 0 is the origin.
            known = place[:, : i - 1] @ corner[: i - 1]
            place[:, i - 1] = ((first - edges[:, i] ** 2 + corner @ corner) / 2 - known) / corner[i - 1]
        return place, np.sqrt(np.maximum(first - (place * place).sum(axis=1), 0.0))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """One row per vector: its place, then its height."""
        edges = np.sqrt(np.column_stack([_doubles(_squared(vectors, p[None, :])) for p in self.pivots]))
        place, height = self._apex(edges)
        return np.column_stack([place, height])


def candidates(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centres (columns) may be nearest to which points (rows), from apexes alone.

    Solving the triangular base loses at most its condition number of the 16 digits, far less than the margin of a millionth of
    the largest squares involved, so no nearest centre, nor one equally near, is ever filtered. What is not a number filters nothing.
    """
    place = (points[:, None, :-1] - centres[None, :, :-1]) ** 2
    flat = place.sum(axis=2)
    g, h = points[:, None, -1], centres[None, :, -1]
    margin = 1e-6 * ((points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1).max() + 1.0)
    upper = (flat + (g + h) ** 2).min(axis=1)[:, None]
    return ~(flat + (g - h) ** 2 - margin > upper + margin)


def nearest(vectors: np.ndarray, points: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector, the smaller number of equally near ones, and its exact squared distance."""
    row, col = np.nonzero(candidates(points, centres))
    exact = _squared(vectors[row], centroids[col])
    # Rows come in order, columns in order inside them, and the sort is stable: the first of a row is its nearest.
    order = np.lexsort((exact, row)) if exact.dtype != object else np.array(sorted(range(len(row)), key=lambda i: (row[i], exact[i])), dtype=np.int64)
    first = order[np.searchsorted(row[order], np.arange(len(vectors)))]
    return col[first], exact[first]


def usable(vector: Column, dimension: int) -> Column:
    """Vectors with exactly so many components, none of them null, NaN or infinite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dimension) & finite, F.lit(False))


def _stacked(rows: pd.Series, width: int) -> np.ndarray:
    return np.stack([np.asarray(r, dtype=float) for r in rows]) if len(rows) else np.zeros((0, width))


def _sums(stored: DataFrame, scale: int, centroids: np.ndarray, centres: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per cluster the number of vectors nearest to its centroid and their componentwise exact sums.

    Every task returns one row per cluster and component, whatever the number of its vectors, and Spark adds them up.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            vectors = _integers(_stacked(batch["vector"], centroids.shape[1]), scale)
            to, _ = nearest(vectors, _stacked(batch["apex"], centres.shape[1]), centroids, centres)
            for c in np.unique(to).tolist():
                members = vectors[to == c]
                total[c] = total.get(c, 0) + members.sum(axis=0).astype(object)
                count[c] = count.get(c, 0) + len(members)
        rows = [(c, at, count[c], str(int(x) >> HALF), str(int(x) & ((1 << HALF) - 1))) for c, sums in total.items() for at, x in enumerate(sums)]
        yield pd.DataFrame(rows, columns=["cluster", "component", "n", "high", "low"])

    parts = stored.select("vector", "apex").mapInPandas(partial, "cluster int, component int, n long, high string, low string")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), *exact).orderBy("cluster", "component").collect():
        out.setdefault(r.cluster, (r.n, []))[1].append((int(r.high) << HALF) + int(r.low))
    return out


@dataclass(frozen=True)
class Clusters:
    """``rows``: the kept rows with ``cluster`` and ``distance`` (squared, a long); ``centroids``: their integer components."""

    rows: DataFrame
    centroids: list[list[int]]


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, dimension: int = 64, scale: int = 1024, pivots: int = 16,
    salt: str = "3",
) -> Clusters:
    """Integer k-means of the vectors with ``dimension`` finite components, each taken as floor(scale * x).

    The first centroids are the ``k`` vectors whose ``salt:key`` has the smallest SHA-256, fewer if there are no more; the first
    ``pivots`` vectors in that order are the pivots. Every round reads the cached apexes and vectors once and
    brings ``k`` times ``dimension`` sums to the driver, however many vectors there are; an empty cluster keeps its centroid.

    Rows whose vector is null, of another length, or has a null, NaN or infinite component are left out. Null keys come last in
    the choice of first centroids; equal keys (repeated rows) are ordered by their vectors. Equally near centroids: the smaller number.
    Components are exact whatever their size (any float; doubles up to 2**130, beyond which a sum is an error); a squared distance beyond a long is null.
    ``scale`` is a power of two. Other columns come back as they are. An empty frame gives no rows and no centroids.
    """
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    mark, apex, place, far = fresh(df, "vector", "apex", "cluster", "distance")
    if (place, far) != ("cluster", "distance"):
        raise ValueError("columns cluster and distance must not exist")
    kept = df.where(usable(F.col(vector), dimension))
    name = F.concat(F.lit(f"{salt}:"), F.col(key).cast("string"))
    order = [F.sha2(name, 256).asc_nulls_last(), F.col(vector).asc()]
    seeds = [r[0] for r in kept.orderBy(*order).select(F.col(vector).cast("array<double>")).limit(max(k, pivots)).collect()]
    if not seeds:
        return Clusters(kept.withColumns({"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("long")}), [])
    seeds = _narrow(_integers(np.array(seeds, dtype=float), scale))
    simplex, centroids = Simplex.over(seeds[:pivots]), seeds[:k]

    @F.pandas_udf("array<double>")
    def apex_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(simplex.apexes(_integers(_stacked(vectors, dimension), scale))), dtype=object)

    cached = kept.withColumn(mark, F.col(vector).cast("array<double>")).withColumn(apex, apex_of(F.col(mark)))
    stored = materialise(cached.drop(mark), "apexes").withColumn(mark, F.col(vector).cast("array<double>"))
    inner = stored.select(F.col(mark).alias("vector"), F.col(apex).alias("apex"))
    for _ in range(rounds):
        sums = _sums(inner, scale, centroids, simplex.apexes(centroids))
        moved = [[s // sums[c][0] for s in sums[c][1]] if c in sums else list(map(int, centroids[c])) for c in range(len(centroids))]
        moved = _narrow(np.array(moved, dtype=object))
        if np.array_equal(moved, centroids):
            break  # every later round would repeat this one
        centroids = moved
    centres = simplex.apexes(centroids)

    @F.pandas_udf("cluster int, distance string")
    def assigned(vectors: pd.Series, apexes: pd.Series) -> pd.DataFrame:
        to, apart = nearest(_integers(_stacked(vectors, dimension), scale), _stacked(apexes, centres.shape[1]), centroids, centres)
        return pd.DataFrame({"cluster": to.astype(np.int32), "distance": [str(int(d)) for d in apart]})

    found = fresh(df, "found")[0]
    placed = stored.withColumn(found, assigned(F.col(mark), F.col(apex)))
    distance = F.expr(f"try_cast(`{found}`.distance AS BIGINT)").alias("distance")
    rows = placed.select(*df.columns, F.col(f"`{found}`.cluster").alias("cluster"), distance)
    return Clusters(rows, [list(map(int, c)) for c in centroids])


def with_inertia(found: Clusters, key: str = "vec_id") -> DataFrame:
    """Key, cluster, distance, and the sums of distances over the ``cluster_inertia`` and over all rows, ``inertia`` (null where one is beyond a long).

    The assignment is written once; the sums are one row per centroid, which become constants.
    """
    rows = materialise(found.rows.select(key, "cluster", "distance"), "assigned")
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = dict(rows.groupBy("cluster").agg(whole).collect())

    def constant(value: int | None) -> Column:
        return F.lit(value if value is not None and value < 1 << 63 else None).cast("long")

    def by_cluster(values: list[Column]) -> Column:
        return F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)

    digests = [F.lit(centroid_digest(c)) for c in found.centroids]
    each = [constant(int(sums[c]) if sums.get(c) is not None else None) for c in range(len(found.centroids))]
    total = None if None in sums.values() else int(sum(sums.values()))
    return rows.withColumns({
        "cluster_inertia": by_cluster(each).cast("long"), "inertia": constant(total), "centroid_sha256": by_cluster(digests).cast("string"),
    })


def centroid_digest(centroid: Sequence[int]) -> str:
    """SHA-256 of the components as decimal integers, comma-joined."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
