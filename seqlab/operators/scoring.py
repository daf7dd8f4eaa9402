"""Scoring (J1-J3)."""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlab.functions.columns import dot, squared_error


def predict(model, df: DataFrame) -> DataFrame:
    """Batch prediction with a fitted Spark ML model (distributed transform)."""
    return model.transform(df)


def linear_scores(df: DataFrame, features: str, weights: list[float], bias: float = 0.0,
                  name: str = "score") -> DataFrame:
    """J1 with fixed weights as a column expression: sigmoid(w . x + b)."""
    z = dot(features, weights) + F.lit(float(bias))
    return df.withColumn(name, 1.0 / (1.0 + F.exp(-z)))


def reconstruction_score(df: DataFrame, x: str, xhat: str, name: str = "score") -> DataFrame:
    """Mean squared difference between a row and its reconstruction."""
    return df.withColumn(name, squared_error(x, xhat))


def linear_step(weights: np.ndarray, bias: np.ndarray):
    """Default rollout step: y_next = W @ y + b (state is the last output).
    Works on one sample (shape [d]) or on a block of samples ([n, d])."""
    W = np.asarray(weights, dtype="float64")
    b = np.asarray(bias, dtype="float64")

    def step(state, x):
        y = np.asarray(x, dtype="float64") @ W.T + b
        return y, y
    return step


def _forecast(ids, state, y, id_col, step_fn, horizon, offset) -> pd.DataFrame:
    """Forecast rows of samples whose warm-up ended with ``state`` and output ``y``."""
    preds = []
    for _ in range(int(horizon) + int(offset)):
        preds.append(y)
        state, y = step_fn(state, y)
    p = np.stack(preds[int(offset):], axis=1)                       # [n, horizon, d]
    n, h, d = p.shape
    return pd.DataFrame({id_col: np.repeat(ids, h * d),
                         "k": np.tile(np.repeat(np.arange(h, dtype="int64"), d), n),
                         "cell": np.tile(np.arange(d, dtype="int32"), n * h), "prediction": p.reshape(-1)})


def rollout(df: DataFrame, id_col: str, step: str, cells: list[str], step_fn: Callable, horizon: int,
            offset: int = 1, start: int | None = None, length: int | None = None) -> DataFrame:
    """Warm-up then autoregressive rollout, sequential within a sample and
    parallel across samples.

    All steps of a sample are fed in order; ``start`` and ``length`` restrict
    the warm-up to steps ``start .. start + length - 1``. Rows are
    hash-partitioned by id and sorted, and each partition is streamed through
    ``mapInPandas``: samples that lie whole in an Arrow batch advance together
    (vectorised over samples of one length); of a sample that continues in the
    next batch only the state is kept, so memory is bounded by the batch
    however long a sample is.

    ``step_fn(state, X) -> (state, Y)`` gets a block of samples ([n, d]);
    state starts as None. The output for the last warm-up step predicts the
    next step; with ``offset=1`` (reference) forecast k is the (k+2)-th
    prediction, with ``offset=0`` the (k+1)-th. Rows with a NULL id are dropped.
    Output: (id, k, cell, prediction).
    """
    warm = df.where(F.col(id_col).isNotNull())
    if start is not None:
        warm = warm.where(F.col(step) >= int(start))
    if length is not None:
        warm = warm.where(F.col(step) < int(start or 0) + int(length))
    out_schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("k", T.LongType()),
                               T.StructField("cell", T.IntegerType()),
                               T.StructField("prediction", T.DoubleType())])

    def run(batches):
        open_id = state = y = None          # a sample that may go on in the next batch
        for pdf in batches:
            if pdf.empty:
                continue
            ids = pdf[id_col].to_numpy()
            x = pdf[cells].to_numpy(dtype="float64")
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            last = np.concatenate([first[1:], [len(ids)]])
            begin = 0
            if open_id is not None:
                if ids[0] == open_id:       # feed what the batch adds to it
                    for t in range(last[0]):
                        state, y = step_fn(state, x[t:t + 1])
                    begin = 1
                if begin < len(first) or ids[0] != open_id:
                    yield _forecast([open_id], state, y, id_col, step_fn, horizon, offset)
                    open_id = None
            whole = np.arange(begin, len(first) - 1)
            lengths = (last - first)[whole]
            for n in np.unique(lengths):
                rows = first[whole[lengths == n]]
                s = out = None
                for t in range(int(n)):
                    s, out = step_fn(s, x[rows + t])
                yield _forecast(ids[rows], s, out, id_col, step_fn, horizon, offset)
            if begin < len(first):          # the last sample of the batch stays open
                open_id, state, y = ids[first[-1]], None, None
                for t in range(first[-1], len(ids)):
                    state, y = step_fn(state, x[t:t + 1])
        if open_id is not None:
            yield _forecast([open_id], state, y, id_col, step_fn, horizon, offset)

    clustered = warm.select(id_col, step, *cells).repartition(id_col).sortWithinPartitions(id_col, step)
    return clustered.select(id_col, *cells).mapInPandas(run, out_schema)
