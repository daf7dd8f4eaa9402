"""Recurrent state over ordered rows: ``s = a * s_before + b`` per component.

The maps ``s -> a * s + b`` compose to maps of the same form, so a running state
is an associative scan: chunks of the sorted rows are scanned independently and
only one map per chunk is chained. A sequence may fill any number of chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlab.operators.ordering import BROADCAST_BYTES, _num_ranges
from seqlab.session import saved

_GROUP, _CHUNK, _AT, _DECAY, _INPUT, _SCALE, _STATE = (f"__{n}" for n in (
    "group", "chunk", "at", "decay", "input", "scale", "state"))


def scan_maps(scale: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Composition of the maps of all rows up to and including each ([n, d]
    arrays), in log2(n) whole-array steps."""
    scale, shift, reach = scale.copy(), shift.copy(), 1
    while reach < len(scale):
        shift[reach:] += scale[reach:] * shift[:-reach]
        scale[reach:] = scale[reach:] * scale[:-reach]
        reach *= 2
    return scale, shift


def _local_states(n_keep: int):
    """States inside a chunk that starts from zero, and what a state carried into
    the chunk is multiplied by at each row (zero after the first key). Columns:
    the kept ones, group hash, chunk, decays, inputs."""
    def run(batches):
        group, scale, state, at = None, None, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(n_keep).to_numpy(zero_copy_only=False)
            a, b = (batch.column(n_keep + k).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for k in (2, 3))
            fresh = np.concatenate([[group is not None and g[0] != group], g[1:] != g[:-1]])
            a = np.where(fresh[:, None], 0.0, a)
            a, b = scan_maps(a, b)
            if group is None:
                scale, state = np.ones(a.shape[1]), np.zeros(a.shape[1])
            a, b = a * scale, a * state + b
            group, scale, state = g[-1], a[-1], b[-1]
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * a.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(n_keep + 2)], pa.array(np.arange(at, at + n)),
                 pa.ListArray.from_arrays(offsets, pa.array(a.ravel())),
                 pa.ListArray.from_arrays(offsets, pa.array(b.ravel()))],
                [*batch.schema.names[:n_keep + 2], _AT, _SCALE, _STATE])
            at += n
    return run


def _carries(batches):
    """Chunks in order (chunk, first and last group, the last group's map) -> the
    state carried into each chunk's first group."""
    group = state = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            carry = state if group == r["first"] else None
            out.append(carry)
            scale, shift = np.array(r["scale"]), np.array(r["state"])
            state = list(shift if carry is None else scale * np.array(carry) + shift)
            group = r["last"]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], ["__c", "__carry"])


def affine_states(df: DataFrame, by: list[str], order: list, decay: Column, inputs: Column, name: str = "state",
                  num_ranges: int | None = None) -> DataFrame:
    """Add ``name array<double>``: per row ``decay * state before + inputs``,
    component by component, within each ``by`` group in ``order``; the state
    before the first row is zero. ``decay`` and ``inputs`` are array columns of
    one length for all rows; both may differ from row to row (a gate). NULL and
    NaN inputs count as 0, NULL and NaN decays as 1 (the state stays). NULL keys
    are a group of their own; ties in ``order`` must be broken by it.

    One range partitioning by (key, order) and one written copy; the rows are not
    moved again. Chunk edges (one row per chunk) are chained by one streaming
    task, and the carried states are broadcast up to BROADCAST_BYTES, else
    joined by chunk.
    """
    names, ranges = list(df.columns), _num_ranges(df, num_ranges)
    key = [F.col(b) for b in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    group = F.xxhash64(*by) if by else F.lit(0).cast("long")

    def clean(col, default):
        return F.transform(col.cast("array<double>"), lambda v: F.coalesce(F.nanvl(v, F.lit(default)), F.lit(default)))

    ranged = df.repartitionByRange(ranges, *key).sortWithinPartitions(*key).select(
        *names, group.alias(_GROUP), F.spark_partition_id().cast("long").alias(_CHUNK),
        clean(decay, 1.0).alias(_DECAY), clean(inputs, 0.0).alias(_INPUT))
    arrays = T.ArrayType(T.DoubleType())
    schema = T.StructType([*ranged.schema.fields[:-2], T.StructField(_AT, T.LongType()), T.StructField(_SCALE, arrays),
                           T.StructField(_STATE, arrays)])
    chunks = saved(ranged.mapInArrow(_local_states(len(names)), schema), "states")
    edges = chunks.groupBy(_CHUNK).agg(
        F.min_by(_GROUP, _AT).alias("first"),
        F.max_by(F.struct(F.col(_GROUP).alias("g"), _SCALE, _STATE), _AT).alias("e")).select(
        _CHUNK, "first", F.col("e.g").alias("last"), F.col(f"e.{_SCALE}").alias("scale"), F.col(f"e.{_STATE}").alias("state"))
    carried = edges.coalesce(1).sortWithinPartitions(_CHUNK).mapInArrow(_carries, "__c bigint, __carry array<double>")
    width = chunks.select(F.size(_STATE)).head()
    if ranges * 8 * (width[0] if width else 0) <= BROADCAST_BYTES:
        carried = F.broadcast(carried)
    joined = chunks.join(carried, F.col(_CHUNK) == F.col("__c"), "left")
    total = F.when(F.col("__carry").isNull(), F.col(_STATE)).otherwise(
        F.zip_with(_STATE, F.zip_with(_SCALE, "__carry", lambda a, c: a * c), lambda s, c: s + c))
    return joined.select(*names, total.alias(name))


def decayed_features(df: DataFrame, id_col: str, step: str, values: list[str], rates: list[float],
                     gate: Column | None = None, num_ranges: int | None = None) -> DataFrame:
    """Recurrent features per step. For every value and rate ``r`` the
    state ``<value>_r<k>``, ``r * before + (1 - r) * value``; with ``gate`` (0 to 1
    per step) also ``<value>_gate``, which forgets as much as the gate lets in."""
    zero = F.lit(0.0)
    cell = {v: F.coalesce(F.nanvl(F.col(v).cast("double"), zero), zero) for v in values}
    names, decay, inputs = [], [], []
    for v in values:
        for k, r in enumerate(rates):
            names.append(f"{v}_r{k}")
            decay.append(F.lit(float(r)))
            inputs.append(cell[v] * (1 - float(r)))
        if gate is not None:
            names.append(f"{v}_gate")
            decay.append(1 - gate)
            inputs.append(gate * cell[v])
    out = affine_states(df, [id_col], [step], F.array(*decay), F.array(*inputs), "__state_of", num_ranges)
    return out.select(*df.columns, *[F.col("__state_of")[i].alias(n) for i, n in enumerate(names)])


def last_states(features: DataFrame, id_col: str, step: str, cols: list[str]) -> DataFrame:
    """The features of each sequence's last step, and its length ``len``."""
    last = F.max_by(F.struct(*cols), step).alias("__last")
    return features.groupBy(id_col).agg(F.count(F.lit(1)).cast("double").alias("len"), last).select(
        id_col, "len", "__last.*")
