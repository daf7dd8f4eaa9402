"""Centroid clustering of integer vectors by n-simplex projection.

Lloyd rounds in exact integer arithmetic; which centroids a vector is compared
with is decided by bounds.

1. A few well-spread starting centroids are the pivots. Their mutual distances
   fix a simplex in as many dimensions, less one; the distances of any vector to
   the pivots fix an apex over it: its coordinates in the simplex' space and its
   altitude. Apexes are computed once per vector and written with it.
2. Let ``y`` be the coordinates and ``h`` the altitudes of two apexes. The
   distance of the vectors lies between the root of ``|y - y'|^2 + (h - h')^2``
   and that of ``|y - y'|^2 + (h + h')^2``.
3. In each round the centroids (a table of fixed size) get apexes too. A
   centroid whose lower bound exceeds the least upper bound, or the distance of
   the centroid with the least lower bound, is dropped; the rest are compared by their squared distances in 64-bit integers, ties to the
   smaller number. Bounds are widened by SLACK of their scale, far above what
   rounding can do.
4. Tasks send one sum per cluster and component; means are floors of exact
   quotients. Only the sums (centroids times components) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import saved

PIVOTS = 40
SPREAD = 0.3            # least altitude of a pivot over those before it, relative to its distance
SLACK = 1e-4
BOUND = 1 << 27         # components below it: squared distances fit 64 bits
_ROWS = 4096
_PAIRS = 1 << 16


class Simplex:
    """Base simplex of pivots (integer vectors)."""

    def __init__(self, candidates: np.ndarray, most: int = PIVOTS):
        """Takes pivots from ``candidates`` in order, those that lie well off the
        simplex so far."""
        self.pivots = candidates[:1]
        self.base = np.zeros((0, 0))
        for c in candidates[1:]:
            if len(self.pivots) == most:
                break
            apex = self.apex(c[None])[0]
            if apex[-1] > 0 and apex[-1] >= SPREAD * np.sqrt(apex @ apex):
                size = len(self.base)
                grown = np.zeros((size + 1, size + 1))
                grown[:size, :size] = self.base
                grown[size] = apex
                self.base, self.pivots = grown, np.vstack([self.pivots, c[None]])

    def apex(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates, and the altitude last, of integer vectors (rows)."""
        squared = np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1).astype(float)
        out = np.zeros((len(vectors), len(self.pivots)))
        if len(self.base):
            right = (squared[:, :1] + (self.base ** 2).sum(axis=1) - squared[:, 1:]) / 2
            out[:, :-1] = np.linalg.solve(self.base, right.T).T
        out[:, -1] = np.sqrt(np.maximum(squared[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest centroid of each vector, and
    how many exact distances that took."""
    a, c = (apexes ** 2).sum(axis=1)[:, None], (centroid_apexes ** 2).sum(axis=1)[None]
    lower = a + c - 2 * apexes @ centroid_apexes.T
    upper = lower + 4 * apexes[:, -1:] * centroid_apexes[:, -1][None]
    slack = SLACK * (a + c)
    likely = vectors - centroids[lower.argmin(axis=1)]               # its exact distance is an upper bound too
    most = np.minimum((upper + slack).min(axis=1), np.einsum("ij,ij->i", likely, likely))
    row, number = np.nonzero(lower - slack <= most[:, None])
    squared = np.empty(len(row), np.int64)
    for i in range(0, len(row), _PAIRS):
        apart = vectors[row[i:i + _PAIRS]] - centroids[number[i:i + _PAIRS]]
        squared[i:i + _PAIRS] = np.einsum("ij,ij->i", apart, apart)
    first = np.searchsorted(row, np.arange(len(vectors)))
    least = np.minimum.reduceat(squared, first)
    hit = np.flatnonzero(squared == least[row])          # in order of row, then centroid
    return number[hit[np.searchsorted(row[hit], np.arange(len(vectors)))]], least, len(row)


def _rows(batches: Iterator[pa.RecordBatch]):
    """(ids, vectors, apexes) of bounded runs of rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            part = batch.slice(i, _ROWS)
            ids, vectors = part.column(0), part.column(1).flatten().to_numpy().astype(np.int64).reshape(part.num_rows, -1)
            yield ids, vectors, part.column(2).flatten().to_numpy().reshape(part.num_rows, -1) if part.num_columns > 2 else None


def _assign(simplex: Simplex, centroids: np.ndarray):
    mine = simplex.apex(centroids)

    def run(batches):
        for ids, vectors, apexes in _rows(batches):
            number, squared, compared = nearest(vectors, apexes, centroids, mine)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), pa.array(squared)],
                                             names=["id", "cluster", "distance"])
    return run


def _sums(simplex: Simplex, centroids: np.ndarray):
    """Per task: sums of each cluster's components, and its count after them."""
    mine = simplex.apex(centroids)

    def run(batches):
        sums = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for _, vectors, apexes in _rows(batches):
            number, _, _ = nearest(vectors, apexes, centroids, mine)
            for k in np.unique(number):
                sums[k, :-1] += vectors[number == k].sum(axis=0)
                sums[k, -1] += (number == k).sum()
        k, j = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(sums[k, j])],
                                         names=["cluster", "place", "value"])
    return run


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, vector``: rows with ``dims`` components, none of them null, not
    finite or beyond BOUND after scaling, each as ``floor(scale * x)``."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    # no NULL outcome: a null vector or component is out
    good = F.coalesce((F.size(x) == dims) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < BOUND / scale)), F.lit(False))
    return df.where(good).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda v: F.floor(v * scale).cast("int")).alias("vector"))


def centroid_clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5,
                      dims: int = 64, scale: int = 256, seed: str = "2", pivots: int = PIVOTS
                      ) -> tuple[DataFrame, list[dict]]:
    """(``id, cluster, distance`` of each vector, one entry per centroid).

    Centroids start as the ``k`` vectors with the smallest sha256 of ``seed:id``
    (rows of one id by their components; all vectors if there are fewer) and
    move ``rounds`` times to the floors of their vectors' means; a centroid
    without vectors stays. ``distance`` is the squared one to the final
    centroid. Vectors of other sizes, null or with null or non-finite components
    are left out, and so are components of 2^27 / scale and more, for which
    squared distances would not fit. Entries hold ``cluster, vector, inertia``
    (its vectors' distances added up). An empty table gives no rows and no
    entries. Other columns are neither read nor returned.
    """
    spark = df.sparkSession
    chosen = integer_vectors(df, id_col, vector_col, dims, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = [r["vector"] for r in chosen.orderBy(order, "vector").limit(k).collect()]    # k rows
    shape = "id bigint, cluster int, distance bigint"
    if not start:
        return spark.createDataFrame([], shape), []
    centroids = np.array(start, np.int64)
    simplex = Simplex(centroids, pivots)

    def with_apex(batches):
        for ids, vectors, _ in _rows(batches):
            apexes = simplex.apex(vectors)
            offsets = pa.array(np.arange(len(vectors) + 1) * apexes.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * dims, pa.int32()),
                                               pa.array(vectors.ravel().astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(apexes.ravel()))], names=["id", "vector", "apex"])

    points = saved(chosen.mapInArrow(with_apex, "id bigint, vector array<int>, apex array<double>"), "apexes")
    for _ in range(rounds):
        sums = points.mapInArrow(_sums(simplex, centroids), "cluster int, place int, value bigint") \
            .groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect()    # k * (dims + 1) rows
        total = np.zeros((len(centroids), dims + 1), object)
        for r in sums:
            total[r["cluster"], r["place"]] = r["value"]
        moved = [[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(total, centroids.tolist())]
        centroids = np.array(moved, np.int64)
    assigned = saved(points.mapInArrow(_assign(simplex, centroids), shape), "assigned")
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}        # k rows
    return assigned, [{"cluster": i, "vector": c, "inertia": inertia.get(i, 0)} for i, c in enumerate(centroids.tolist())]


def centroid_digest(vector: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, vector)).encode()).hexdigest()
