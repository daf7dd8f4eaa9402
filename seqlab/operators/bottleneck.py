"""I5 for wide vectors: a linear bottleneck without a d x d matrix anywhere.

1. Range finder: a random block of d x width directions is multiplied by the
   covariance again and again, each time one pass over the rows in which every
   task adds up its own d x width block; the blocks, made orthonormal, span a
   Krylov space that holds the leading directions.
2. Tree QR: each task reduces its projected rows to one triangular factor, groups
   of tasks stack and reduce theirs, and the driver reduces what is left. The
   singular vectors of the last factor rotate the basis to the components.

The driver holds d x (width * rounds) numbers and a small triangle.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.session import saved

_BLOCK = 1 << 20        # cells of a block of rows


def _blocks(batches, d: int):
    rows = max(1, _BLOCK // d)
    for pdf in batches:
        for i in range(0, len(pdf), rows):
            yield np.array(pdf["x"].iloc[i:i + rows].tolist(), dtype="float64").reshape(-1, d)


def _means(vectors: DataFrame, d: int) -> tuple[int, np.ndarray]:
    def partial(batches):
        total, n = np.zeros(d), 0
        for x in _blocks(batches, d):
            total, n = total + x.sum(axis=0), n + len(x)
        if n:
            yield pd.DataFrame({"i": np.arange(-1, d), "s": [float(n), *total]})

    sums = {r["i"]: r["s"] for r in vectors.mapInPandas(partial, "i int, s double").groupBy("i").agg(
        F.sum("s").alias("s")).collect()}       # d + 1 numbers
    n = int(sums.get(-1, 0))
    return n, np.array([sums.get(i, 0.0) for i in range(d)]) / max(n, 1)


def _times_covariance(vectors: DataFrame, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Xc' Xc basis, one pass; each task emits d rows once."""
    d, width = basis.shape

    def partial(batches):
        total = np.zeros((d, width))
        for x in _blocks(batches, d):
            x -= mean
            total += x.T @ (x @ basis)
        yield pd.DataFrame({"i": np.arange(d), **{f"z{j}": total[:, j] for j in range(width)}})

    cols = [f"z{j}" for j in range(width)]
    sums = vectors.mapInPandas(partial, ", ".join(["i int", *[f"{c} double" for c in cols]])).groupBy("i").agg(
        *[F.sum(c).alias(c) for c in cols]).collect()                  # d rows
    out = np.zeros((d, width))
    for r in sums:
        out[r["i"]] = [r[c] for c in cols]
    return out


def _triangle(vectors: DataFrame, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """R of the QR factors of Xc basis, by a tree of three levels."""
    d, width = basis.shape
    schema = "task int, r array<double>"

    def reduce(parts: list) -> np.ndarray:
        return np.linalg.qr(np.vstack(parts), mode="r")

    def rows(task, r):
        return pd.DataFrame({"task": [task] * len(r), "r": [list(v) for v in r]})

    def leaves(batches):
        from pyspark import TaskContext
        r = np.zeros((0, width))
        for x in _blocks(batches, d):
            r = reduce([r, (x - mean) @ basis])
        if len(r):          # a split may hold no row; an empty list column has no type
            yield rows(TaskContext.get().partitionId(), r)

    def inner(pdf):
        return rows(int(pdf["task"].iloc[0]), reduce([np.array(pdf["r"].tolist())]))

    found = vectors.mapInPandas(leaves, schema)
    fan = max(1, math.isqrt(vectors.rdd.getNumPartitions()))
    found = found.groupBy((F.col("task") % fan).alias("g")).applyInPandas(inner, schema)
    last = [r["r"] for r in found.collect()]                           # about fan triangles
    return reduce([np.array(last)]) if last else np.zeros((0, width))


def principal_directions(df: DataFrame, features: str, k: int, width: int | None = None, rounds: int = 8,
                         tolerance: float = 1e-9, seed: int = 123) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean [d], components [d, k], variances [k]) of an array column, largest
    variance first. Vectors that are NULL, of another size than the first, or hold
    NULL or non-finite cells are left out; with fewer than ``k`` independent rows
    there are as many components. ``rounds`` passes are made at most; they end
    when the leading ``k`` variances settle within ``tolerance`` of their sum, or
    when the space is exhausted (then the components are exact)."""
    first = df.where(F.col(features).isNotNull()).select(F.size(features)).head()
    if first is None:
        return np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    d = int(first[0])
    x = F.transform(F.col(features), lambda v: v.cast("double"))
    good = (F.size(x) == d) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    vectors = saved(df.where(F.coalesce(good, F.lit(False))).select(x.alias("x")), "vectors")
    n, mean = _means(vectors, d)
    width = min(d, width or k + 10)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    basis, before = np.zeros((d, 0)), None
    for _ in range(rounds):
        basis = np.hstack([basis, block])
        image = _times_covariance(vectors, mean, block)
        for _ in range(2):                                             # twice is enough
            image -= basis @ (basis.T @ image)
        left, sizes, _ = np.linalg.svd(image, full_matrices=False)
        triangle = _triangle(vectors, mean, basis)
        variance = (np.linalg.svd(triangle, compute_uv=False)[:k] ** 2).sum()
        block = left[:, sizes > 1e-12 * max(variance, 1e-300)][:, :d - basis.shape[1]]
        if not block.shape[1] or (before is not None and variance - before <= tolerance * variance):
            break
        before = variance
    _, sizes, right = np.linalg.svd(triangle, full_matrices=False)
    keep = [i for i in range(min(k, len(sizes))) if sizes[i] > 1e-12 * max(sizes[0], 1e-300)]
    return mean, basis @ right[keep].T, sizes[keep] ** 2 / max(n - 1, 1)


def bottleneck_errors(df: DataFrame, features: str, mean: np.ndarray, components: np.ndarray, name: str = "score"
                      ) -> DataFrame:
    """``df`` with the mean squared difference of each vector and its
    reconstruction; NULL for NULL vectors and those of another size."""
    @F.pandas_udf("double")
    def error(xs: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(xs), dtype="float64")
        fit = np.array([v is not None and len(v) == len(mean) for v in xs], bool)
        step = max(1, _BLOCK // max(len(mean), 1))
        where = np.flatnonzero(fit)
        for i in range(0, len(where), step):
            part = where[i:i + step]
            c = np.array(xs.iloc[part].tolist(), dtype="float64") - mean
            out.iloc[part] = ((c - c @ components @ components.T) ** 2).mean(axis=1)
        return out
    return df.withColumn(name, error(F.col(features).cast("array<double>")))
