"""J3 with kept state: a table of one state per sample, so that a rollout goes on
where the last one ended.

``advance`` feeds the steps after a sample's kept step and returns the new table;
steps already fed are skipped, so feeding the same rows again changes nothing.
``save_states`` writes a table as a new version beside the older ones; a version
counts only when its write has finished, so a run that failed is repeated from
the last whole one.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlab.operators.scoring import _forecast
from seqlab.sources.readers import _fs, path_exists


def smoothing_step(rate: float, slope: float, bias: float):
    """Exponential smoothing: the state is ``rate * before + (1 - rate) * x``, the
    output ``slope * state + bias``."""
    def step(state, x):
        x = np.asarray(x, dtype="float64")
        state = (1 - rate) * x + (0.0 if state is None else rate * np.asarray(state))
        return state, slope * state + bias
    return step


def state_schema(id_type: T.DataType, id_col: str) -> T.StructType:
    values = T.ArrayType(T.DoubleType())
    return T.StructType([T.StructField(id_col, id_type), T.StructField("last_step", T.LongType()),
                         T.StructField("state", values), T.StructField("output", values)])


def advance(df: DataFrame, id_col: str, step: str, cells: list[str], step_fn: Callable,
            kept: DataFrame | None = None) -> DataFrame:
    """State table (``id, last_step, state, output``) after feeding the rows of
    ``df`` in step order, each sample from its row in ``kept`` on (from no state
    where it has none). Rows up to the kept step are skipped; samples without new
    rows stay as they are; NULL ids and steps are dropped; NULL cells are NaN; of
    rows with the same step the one with the smallest cells is fed.
    ``step_fn(state, X) -> (state, Y)`` works on blocks [n, d] as in ``rollout``.

    Rows of a sample are fed by one task in order, batch by batch; between batches
    only its state is held. Samples of equal length in a batch advance together.
    """
    schema = state_schema(df.schema[id_col].dataType, id_col)
    none = F.lit(None).cast("array<double>")
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cells])
    rows = df.where(F.col(id_col).isNotNull() & F.col(step).isNotNull()).select(
        F.col(id_col), F.col(step).cast("long").alias("__at"), F.lit(True).alias("__new"), x.alias("__x"), none.alias("__s"))
    if kept is not None:
        # a kept row sorts before the row of its own step, which is skipped
        rows = kept.select(F.col(id_col), F.col("last_step").alias("__at"), F.lit(False).alias("__new"),
                           F.col("output").alias("__x"), F.col("state").alias("__s")).unionByName(rows)
        if [f.dataType for f in kept.select(id_col).schema] != [schema[id_col].dataType]:
            raise ValueError("the kept ids are of another type")
    rows = rows.repartition(id_col).sortWithinPartitions(id_col, F.col("__new").asc(), "__at", "__x")

    def stack(values):
        return np.array(values.tolist(), dtype="float64")

    def table(ids, at, states, outputs):
        return pd.DataFrame({id_col: ids, "last_step": at, "state": [list(s) for s in states],
                             "output": [list(y) for y in outputs]})

    def run(batches):
        now = None                         # [id, last step, state, output] of a sample that may go on
        for pdf in batches:
            again = (pdf[id_col] == pdf[id_col].shift()) & (pdf["__at"] == pdf["__at"].shift()) & pdf["__new"].shift(fill_value=False)
            pdf = pdf[~again]
            if pdf.empty:
                continue
            ids, at, new = pdf[id_col].to_numpy(), pdf["__at"].to_numpy(), pdf["__new"].to_numpy()
            xs, kept_states = pdf["__x"].to_numpy(), pdf["__s"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            ends = [*first[1:].tolist(), len(ids)]
            jobs: dict = {}
            for i, (a, z) in enumerate(zip(first.tolist(), ends)):
                begun = None
                if i == 0 and now is not None:
                    if ids[0] == now[0]:
                        begun = now
                    else:
                        yield table([now[0]], [now[1]], [now[2]], [now[3]])
                    now = None
                if begun is None and not new[a]:
                    begun, a = [ids[a], int(at[a]), kept_states[a], xs[a]], a + 1
                if begun is not None:       # steps that the state has seen already
                    a += int(np.searchsorted(at[a:z], begun[1], side="right"))
                if z - a == 0 and begun is not None:
                    if i == len(first) - 1:
                        now = begun
                    else:
                        yield table([begun[0]], [begun[1]], [begun[2]], [begun[3]])
                    continue
                last = i == len(first) - 1
                jobs.setdefault((z - a, begun is not None, last), []).append((a, begun, ids[first[i]]))
            for (n, has, last), group in jobs.items():
                start = np.array([a for a, _, _ in group])
                state = np.stack([np.asarray(b[2], float) for _, b, _ in group]) if has else None
                y = None
                for t in range(n):
                    state, y = step_fn(state, stack(xs[start + t]))
                if last:
                    now = [group[0][2], int(at[start[0] + n - 1]), state[0], y[0]]
                else:
                    yield table([i for _, _, i in group], at[start + n - 1], state, y)
        if now is not None:
            yield table([now[0]], [now[1]], [now[2]], [now[3]])

    return rows.mapInPandas(run, schema)


def forecast(kept: DataFrame, id_col: str, step_fn: Callable, horizon: int, offset: int = 1) -> DataFrame:
    """``id, k, cell, prediction``: ``horizon`` steps fed with their own outputs
    from each kept state on; ``offset`` as in ``rollout``."""
    out = T.StructType([kept.schema[id_col], T.StructField("k", T.LongType()), T.StructField("cell", T.IntegerType()),
                        T.StructField("prediction", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            for i in range(0, len(pdf), 1024):
                part = pdf.iloc[i:i + 1024]
                state, y = (np.array(part[c].tolist(), dtype="float64") for c in ("state", "output"))
                yield _forecast(part[id_col].to_numpy(), state, y, id_col, step_fn, horizon, offset)
    return kept.mapInPandas(run, out)


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest finished version below ``path``; 0 without one."""
    if not path_exists(spark, path):
        return 0
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [int(n[8:]) for n in names if n.startswith("version=") and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return max(done, default=0)


def save_states(states: DataFrame, path: str, version: int) -> DataFrame:
    """Write ``states`` as ``version`` unless that version is finished; returns
    what is stored. Older versions stay and may be read by number."""
    place = f"{path.rstrip('/')}/version={version}"
    if not path_exists(states.sparkSession, f"{place}/_SUCCESS"):
        states.write.mode("overwrite").parquet(place)
    return load_states(states.sparkSession, path, version)


def load_states(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The states of ``version`` (default: the newest finished one), or None."""
    version = version or latest_version(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/version={version}") if version else None
