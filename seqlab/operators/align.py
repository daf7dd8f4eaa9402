"""Joins and alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def positional_zip(frames: list[DataFrame], on: str = "row_no") -> DataFrame:
    """Row i of each frame forms one record (inner: the excess of longer
    frames is dropped). Each frame already carries a dense row number."""
    return reduce(lambda a, b: a.join(b, on=on, how="inner"), frames)


def join_samples(features: DataFrame, labels: DataFrame, on) -> DataFrame:
    """Match features and labels by sample (and step). Plain inner equi-join:
    AQE broadcasts the label side when it is small at run time, and splits a
    skewed sample's partition otherwise."""
    return features.join(labels, on=on, how="inner")


def _lengths(df: DataFrame, id_col: str, batch_id: str, step: str) -> DataFrame:
    lens = df.groupBy(id_col, batch_id).agg((F.max(step) + 1).cast("long").alias("seq_len"))
    tmax = lens.groupBy(batch_id).agg(F.max("seq_len").alias("batch_len"))
    return lens.join(tmax, on=batch_id, how="inner")


def align_end(df: DataFrame, id_col: str, step: str, batch_id: str, dense: bool = False,
              value_cols: list[str] | None = None) -> DataFrame:
    """D3: ALIGN_END. Inside a batch, T = the longest sequence; each step moves
    to ``pos = step + (T - len)`` so that all sequences end together.

    Sparse output keeps only real steps (mask 1). Dense output has every
    position 0..T-1 of every sequence: since sequences are end-aligned, the
    padding is exactly positions 0..T-len-1, generated per sequence (value 0,
    mask 0) and appended to the shifted real rows; no join with a position
    grid. Sequence lengths come from partial+final aggregates.
    """
    lens = _lengths(df, id_col, batch_id, step)
    sparse = df.join(lens, on=[id_col, batch_id], how="inner").withColumn(
        "pos", (F.col(step) + F.col("batch_len") - F.col("seq_len")).cast("long"))
    if not dense:
        return sparse.withColumn("mask", F.lit(1))
    value_cols = value_cols or [c for c in df.columns if c not in (id_col, step, batch_id)]
    real = sparse.select(id_col, batch_id, "pos", *value_cols, F.lit(1).alias("mask"))
    pad = lens.where(F.col("batch_len") > F.col("seq_len")).select(
        id_col, batch_id,
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("batch_len") - F.col("seq_len") - 1)).alias("pos"))
    pad = pad.select(id_col, batch_id, "pos",
                     *[F.lit(0).cast(df.schema[c].dataType).alias(c) for c in value_cols],
                     F.lit(0).alias("mask"))
    return real.unionByName(pad)
