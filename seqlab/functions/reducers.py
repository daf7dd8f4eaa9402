"""User reducers with accept / combine / get (L1), run as a two-phase aggregate.

A grouped-aggregate pandas UDF receives a whole group in one call, so a key
with a third of the rows would land in one task. A reducer written as
``accept`` (rows -> partial state), ``combine`` (states -> state) and
``get`` (state -> outputs) is instead run like Spark's own partial and final
aggregation:

1. map side (``mapInPandas``): every task folds its rows into one partial
   state per key (per Arrow batch, then combined across the task's batches,
   flushed every ``FLUSH_STATES`` states so memory stays bounded);
2. reduce side (``applyInPandas`` per key): the partial states of a key -
   at most one per map task, never one per row - are combined and finished.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


FLUSH_STATES = 200_000


@dataclass
class Reducer:
    """``accept(pdf) -> dict`` over one key's rows, ``combine(pdf) -> dict`` over
    partial states (one row each), ``get(dict) -> dict`` of outputs. State
    values are doubles named in ``state``; outputs are typed by ``output``
    (a DDL field list such as ``"lat double, lon double"``)."""
    state: list[str]
    accept: Callable[[pd.DataFrame], dict]
    combine: Callable[[pd.DataFrame], dict]
    get: Callable[[dict], dict]
    output: str


def reduce_by_key(df: DataFrame, keys: list[str], cols: list[str], reducer: Reducer) -> DataFrame:
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    state_schema = T.StructType(key_fields + [T.StructField(s, T.DoubleType()) for s in reducer.state])
    out_schema = T.StructType(key_fields + list(T.StructType.fromDDL(reducer.output).fields))

    def combine_parts(parts):
        allp = pd.concat(parts, ignore_index=True)
        rows = [dict(zip(keys, k if isinstance(k, tuple) else (k,)), **reducer.combine(g))
                for k, g in allp.groupby(keys, sort=False, dropna=False)]
        return pd.DataFrame(rows, columns=keys + reducer.state)

    def partial(batches):
        parts, held = [], 0
        for pdf in batches:
            if pdf.empty:
                continue
            rows = [dict(zip(keys, k if isinstance(k, tuple) else (k,)), **reducer.accept(g))
                    for k, g in pdf.groupby(keys, sort=False, dropna=False)]
            parts.append(pd.DataFrame(rows))
            held += len(rows)
            if held >= FLUSH_STATES:
                # bounded memory with many distinct keys: emit what is held;
                # the per-key combine accepts any number of partial states
                yield combine_parts(parts)
                parts, held = [], 0
        if parts:
            yield combine_parts(parts)

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        state = reducer.combine(pdf)
        out = reducer.get(state)
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(out)
        return pd.DataFrame([row], columns=[f.name for f in out_schema.fields])

    states = df.select(*keys, *cols).mapInPandas(partial, state_schema)
    return states.groupBy(*keys).applyInPandas(final, out_schema)


def geo_average_reducer(lat: str = "lat", lon: str = "lon", decimals: int = 6) -> Reducer:
    """The reference's coordinate averaging written as a user reducer: sums of
    unit vectors and a count, combined by addition, finished with atan2."""
    def accept(pdf):
        la, lo = np.radians(pdf[lat].to_numpy(float)), np.radians(pdf[lon].to_numpy(float))
        return {"sx": float(np.sum(np.cos(la) * np.cos(lo))), "sy": float(np.sum(np.cos(la) * np.sin(lo))),
                "sz": float(np.sum(np.sin(la))), "n": float(len(pdf))}

    def combine(states):
        return {c: float(states[c].sum()) for c in ("sx", "sy", "sz", "n")}

    def get(st):
        x, y, z = st["sx"] / st["n"], st["sy"] / st["n"], st["sz"] / st["n"]
        return {"n": int(st["n"]),
                "lat": round(float(np.degrees(np.arctan2(z, np.sqrt(x * x + y * y)))), decimals),
                "lon": round(float(np.degrees(np.arctan2(y, x))), decimals)}

    return Reducer(["sx", "sy", "sz", "n"], accept, combine, get, "n long, lat double, lon double")
