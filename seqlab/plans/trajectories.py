"""E5 flagship: hourly vessel trajectories.

scan -> keep 4 columns -> drop outliers -> min-max -> (id, 1-hour window)
reduce with geo averaging -> number the windows per id -> keep ids with more
than ``more_than`` windows.

Plan shape: partial HashAggregate on (id, window) before the first
exchange, so a vessel with a third of all positions is collapsed on the map
side; the second exchange (on id, for step numbers and lengths) sees at
most one row per (id, hour), which is bounded by the time span, not by the
number of positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seqlab.operators.projection import drop_outside
from seqlab.operators.sequences import hourly_geo_windows

GEO_BOX = {"lat": (-90.0, 90.0), "lon": (-180.0, 180.0)}


def hourly_trajectories(positions: DataFrame, id_col: str = "mmsi", ts_col: str = "ts",
                        lat: str = "lat", lon: str = "lon", geo_mode: str = "reference",
                        more_than: int = 7, every: str = "1 hour") -> DataFrame:
    pos = positions.select(id_col, ts_col, lat, lon)
    pos = drop_outside(pos, {lat: GEO_BOX["lat"], lon: GEO_BOX["lon"]})
    pos = pos.where(F.col(ts_col).isNotNull())
    hourly = hourly_geo_windows(pos, id_col, ts_col, lat, lon, geo_mode=geo_mode, every=every)
    w_ord = Window.partitionBy(id_col).orderBy("window_start")
    w_all = Window.partitionBy(id_col)
    seq = hourly.select(
        id_col,
        (F.row_number().over(w_ord) - 1).cast("long").alias("step"),
        "window_start", "n_points", "first_ts", "lat", "lon",
        F.count(F.lit(1)).over(w_all).alias("seq_len"),
    )
    return seq.where(F.col("seq_len") > int(more_than))
