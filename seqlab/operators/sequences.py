"""Sequence building and reduction.

Canonical form is the long table ``(seq_id, step, ...)``: a sequence is
never gathered into one record (a nested row would hold a whole, possibly
huge, sequence in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions.columns import geo_xyz, minmax, xyz_geo
from seqlab.operators.ordering import ordered_index


def to_sequences(df: DataFrame, id_col: str, ts_col: str, tiebreak: str | None = None,
                 step: str = "step", length: str | None = "seq_len") -> DataFrame:
    """Number the rows of each id in ascending time order (0-based ``step``).

    The skew-safe ordered index numbers a hot id in many tasks and carries its
    length back over them, so the rows are exchanged once. Rows with a NULL id
    are one sequence.
    """
    order = [ts_col] + ([tiebreak] if tiebreak else [])
    return ordered_index(df, [id_col], order, name=step, count=length)


def sequence_stats(df: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    """Positions, first, last and span of time per id (no sequence is built)."""
    t = F.col(ts_col)
    return df.groupBy(id_col).agg(
        F.count(t).alias("num_positions"),
        F.min(t).alias("min_time"),
        F.max(t).alias("max_time"),
    ).withColumn("total_time", F.col("max_time") - F.col("min_time"))


def geo_average(lat, lon, decimals: int | None = 6) -> tuple[Column, Column]:
    """E4 as aggregate expressions: mean of unit vectors -> (lat, lon) degrees.

    Three ``avg`` aggregates are combinable, so Catalyst plans partial and
    final aggregation (the accept/combine/get of a custom reducer)."""
    x, y, z = geo_xyz(lat, lon)
    la, lo = xyz_geo(F.avg(x), F.avg(y), F.avg(z))
    if decimals is not None:
        la, lo = F.round(la, decimals), F.round(lo, decimals)
    return la, lo


def window_reduce(df: DataFrame, id_col: str, ts_col: str, every: str = "1 hour",
                  aggs: list[Column] | None = None) -> DataFrame:
    """Reduce each id's rows per tumbling, epoch-aligned window (start
    inclusive). Empty windows never appear. Output: id, window_start,
    n_points, first_ts, then ``aggs``."""
    w = F.window(F.col(ts_col), every)
    agg = df.groupBy(F.col(id_col), w.alias("w")).agg(
        F.count(F.col(ts_col)).alias("n_points"),
        F.min(F.col(ts_col)).alias("first_ts"),
        *(aggs or []),
    )
    rest = [c for c in agg.columns if c not in (id_col, "w")]
    return agg.select(F.col(id_col), F.col("w.start").alias("window_start"), *rest)


def hourly_geo_windows(df: DataFrame, id_col: str, ts_col: str, lat: str, lon: str,
                       geo_mode: str = "reference", every: str = "1 hour") -> DataFrame:
    """E3+E4: per (id, window) count, first time and geo-averaged position.

    ``geo_mode="reference"`` scales lat/lon to [0, 1] first and averages the
    scaled numbers as if they were degrees (what the reference computes);
    ``"geodesic"`` averages degrees and scales the result.
    """
    if geo_mode == "reference":
        slat, slon = minmax(lat, -90, 90), minmax(lon, -180, 180)
        la, lo = geo_average(slat, slon)
    elif geo_mode == "geodesic":
        la, lo = geo_average(lat, lon, decimals=None)
        la, lo = F.round(minmax(la, -90, 90), 6), F.round(minmax(lo, -180, 180), 6)
    else:
        raise ValueError(f"unknown geo_mode {geo_mode!r}")
    return window_reduce(df, id_col, ts_col, every, [la.alias("lat"), lo.alias("lon")])
