"""Projection and filter operators.

All of these are narrow (no shuffle) except ``min_length`` and
``last_valid_step``, which aggregate per sequence with a map-side partial
aggregate before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_columns(df: DataFrame, *names: str) -> DataFrame:
    """B1: drop every column but ``names`` (column pruning reaches the scan)."""
    return df.select(*names)


def column_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """B2: columns ``first..last`` by position, both ends inclusive."""
    return df.select(*df.columns[int(first): int(last) + 1])


def drop_outside(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Remove rows where any bounded column is outside [lo, hi] (inclusive
    bounds stay). NULL and NaN values are removed as well (decision Q24)."""
    cond = None
    for c, (lo, hi) in bounds.items():
        col = F.col(c)
        term = col.isNotNull() & ~F.isnan(col) & col.between(float(lo), float(hi))
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


def min_length(df: DataFrame, id_col: str, more_than: int = 7) -> DataFrame:
    """Keep the rows of sequences that have more than ``more_than`` rows.

    Lengths come from a partial+final aggregate (a hot id is pre-counted on
    the map side), then a left-semi join; AQE splits a skewed join partition
    and broadcasts the passing ids when they are small at run time.
    """
    keep = df.groupBy(id_col).count().where(F.col("count") > int(more_than)).select(id_col)
    return df.join(keep, on=id_col, how="left_semi")


def index_range(df: DataFrame, id_col: str, lo: int, hi: int) -> DataFrame:
    """Sample ids ``lo..hi`` inclusive (pushed to the scan as a range)."""
    return df.where(F.col(id_col).between(int(lo), int(hi)))


def step_slice(df: DataFrame, step_col: str, lo: int, hi: int) -> DataFrame:
    """Half-open time-step interval [lo, hi)."""
    return df.where((F.col(step_col) >= int(lo)) & (F.col(step_col) < int(hi)))


def last_valid_step(df: DataFrame, id_col: str, step_col: str, mask_col: str | None = None,
                    name: str = "last_step") -> DataFrame:
    """C11: last step whose mask is non-zero per sequence; without a mask, the last step."""
    if mask_col is None:
        expr = F.max(step_col)
    else:
        expr = F.max(F.when(F.col(mask_col) != 0, F.col(step_col)))
    return df.groupBy(id_col).agg(expr.cast("long").alias(name))
