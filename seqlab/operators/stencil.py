"""I6 with neighbourhoods: one 3x3 stencil shared by all cells of a grid.

The next value of a cell is a weighted sum of the cell and its eight neighbours
(0 beyond the edge) plus a bias. All cells of all rows give one regression of ten
coefficients, whose normal equations are sums over the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 9 + 1        # nine cells of a patch, row by row, and the constant
_CELLS = 1 << 18    # cells expanded to patches at a time


def patches(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """[n, height * width] flat grids -> [n * height * width, 10] patches."""
    grid = np.pad(x.reshape(-1, height, width), ((0, 0), (1, 1), (1, 1)))
    parts = [grid[:, r:r + height, c:c + width].reshape(-1) for r in range(3) for c in range(3)]
    return np.column_stack([*parts, np.ones(x.size)])


def patch_gram(pairs: DataFrame, x: str, y: str, height: int, width: int) -> DataFrame:
    """Mean products over all cells of all rows as (kind, i, j, value): ``xx`` of
    the ten patch columns (both triangles), ``xy`` of them with the cell's target
    (j = 0). ``x`` and ``y`` are arrays of height * width cells; rows with another
    size, NULL cells or NaN are left out. Each task emits its sums once."""
    size = height * width

    def partial(batches):
        xx, xy, n = np.zeros((SIZE, SIZE)), np.zeros(SIZE), 0
        step = max(1, _CELLS // size)
        for pdf in batches:
            for i in range(0, len(pdf), step):
                part = pdf.iloc[i:i + step]
                p = patches(np.array(part["x"].tolist(), dtype="float64"), height, width)
                t = np.array(part["y"].tolist(), dtype="float64").reshape(-1)
                xx, xy, n = xx + p.T @ p, xy + p.T @ t, n + len(t)
        if n:
            i, j = np.indices((SIZE, SIZE))
            yield pd.DataFrame({"kind": ["xx"] * i.size + ["xy"] * SIZE, "i": np.concatenate([i.ravel(), np.arange(SIZE)]),
                                "j": np.concatenate([j.ravel(), np.zeros(SIZE, int)]),
                                "s": np.concatenate([xx.ravel(), xy]), "n": n})

    whole = lambda c: (F.size(c) == size) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v))
    cells = pairs.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("array<double>").alias("y"))
    parts = cells.where(F.coalesce(whole(F.col("x")) & whole(F.col("y")), F.lit(False))).mapInPandas(
        partial, "kind string, i int, j int, s double, n long")
    return parts.groupBy("kind", "i", "j").agg((F.sum("s") / F.sum("n")).alias("value"))


def fit_stencil(pairs: DataFrame, x: str, y: str, height: int, width: int, ridge: float = 0.0
                ) -> tuple[np.ndarray, float]:
    """(3x3 stencil, bias) by least squares; ``ridge`` is added to the diagonal,
    the bias aside."""
    xx, xy = np.zeros((SIZE, SIZE)), np.zeros(SIZE)
    for r in patch_gram(pairs, x, y, height, width).collect():      # 110 numbers
        if r["kind"] == "xx":
            xx[r["i"], r["j"]] = r["value"]
        else:
            xy[r["i"]] = r["value"]
    xx[np.arange(SIZE - 1), np.arange(SIZE - 1)] += ridge
    beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
    return beta[:-1].reshape(3, 3), float(beta[-1])


def stencil_step(stencil: np.ndarray, bias: float, height: int, width: int):
    """Rollout step of the fitted stencil (the state is the last output)."""
    beta = np.append(np.asarray(stencil, float).ravel(), bias)

    def step(state, x):
        y = (patches(np.asarray(x, dtype="float64"), height, width) @ beta).reshape(np.shape(x))
        return y, y
    return step
