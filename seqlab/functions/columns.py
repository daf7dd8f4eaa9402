"""Column expressions (C1-C10, J2): everything here is a Catalyst expression
and costs no Python per row. Higher-order functions over arrays (one-hot, grids,
dot products) run on the JVM but outside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- C1 -----
def minmax(col, lo: float, hi: float, new_lo: float = 0.0, new_hi: float = 1.0) -> Column:
    """Min-max normalise with *given* bounds: (x-lo)/(hi-lo)*(new_hi-new_lo)+new_lo."""
    c = _c(col)
    return (c - F.lit(float(lo))) / F.lit(float(hi) - float(lo)) * F.lit(
        float(new_hi) - float(new_lo)) + F.lit(float(new_lo))


# ---------------------------------------------------------------- C2 -----
def to_text(col, decimals: int | None = 6) -> Column:
    """Number -> string. Fixed decimals give text that is stable across engines;
    ``decimals=None`` is a plain cast."""
    c = _c(col)
    if decimals is None:
        return c.cast("string")
    return F.format_string(f"%.{int(decimals)}f", c)


# ---------------------------------------------------------------- C3 -----
def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def parse_time(col, pattern: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    """Text (wall-clock time in UTC) -> timestamp instant; unparseable text -> NULL.

    The text is read with an explicit ``+0000`` offset, so the result does not
    depend on the session time zone. ``yyyy`` (year of era) is used; the
    week-year ``YYYY`` is rejected by Spark."""
    return F.try_to_timestamp(F.concat(_c(col), F.lit(" +0000")), F.lit(pattern + " XX"))


def parse_time_millis(col, pattern: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    """Text -> epoch milliseconds (the reference's Time column is a long)."""
    return F.unix_millis(parse_time(col, pattern))


def parse_time_ntz(col, pattern: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    """Text -> wall-clock timestamp without zone (UTC wall clock)."""
    return from_epoch_millis(parse_time_millis(col, pattern))


def epoch_micros(col) -> Column:
    """Zone-less timestamp (UTC wall clock) -> epoch microseconds, from its
    fields (days since 1970-01-01, hour, minute, seconds with fraction), so
    no session time zone (and no daylight-saving gap) is involved."""
    c = _c(col)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.hour(c).cast("long") * 3600 + F.minute(c).cast("long") * 60
    frac = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return (days * 86400 + secs) * 1_000_000 + frac


def epoch_millis(col) -> Column:
    """Zone-less timestamp (UTC wall clock) -> epoch milliseconds (floor)."""
    return F.floor(epoch_micros(col) / 1000).cast("long")


def from_epoch_micros(col) -> Column:
    """Epoch microseconds -> zone-less timestamp (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", _c(col), _epoch_ntz())


def from_epoch_millis(col) -> Column:
    """Epoch milliseconds -> zone-less timestamp (UTC wall clock)."""
    return F.timestamp_add("MILLISECOND", _c(col), _epoch_ntz())


# ---------------------------------------------------------------- C4 -----
def concat_text(sep: str, *cols) -> Column:
    return F.concat_ws(sep, *[_c(c) for c in cols])


# ---------------------------------------------------------------- C5 -----
def split_doubles(col, sep: str = ",", arity: int | None = None, strict: bool = False) -> Column:
    """Split delimited text into array<double>; a cell that is not a number is NULL.

    With ``arity`` the array must have exactly that many parts: a wrong count
    gives NULL, or raises when ``strict`` (the reference throws).
    """
    parts = F.split(_c(col), _regex_quote(sep))
    arr = F.transform(parts, lambda x: x.try_cast("double"))
    if arity is None:
        return arr
    ok = F.size(parts) == F.lit(int(arity))
    if strict:
        return F.when(ok, arr).otherwise(
            F.raise_error(F.concat(F.lit("cannot parse coordinate text: "), _c(col))))
    return F.when(ok, arr)


def flatten_steps(col) -> Column:
    """array<array<double>> -> array<double> (per-step split + flatten)."""
    return F.flatten(_c(col))


def _regex_quote(sep: str) -> str:
    import re
    return re.escape(sep)


# ---------------------------------------------------------------- C6 -----
def geo_xyz(lat, lon) -> tuple[Column, Column, Column]:
    """Spherical degrees -> unit-sphere (x, y, z)."""
    la, lo = F.radians(_c(lat)), F.radians(_c(lon))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def xyz_geo(x, y, z) -> tuple[Column, Column]:
    """Mean vector -> (lat, lon) degrees."""
    x, y, z = _c(x), _c(y), _c(z)
    lat = F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
    lon = F.degrees(F.atan2(y, x))
    return lat, lon


# ---------------------------------------------------------------- C7 -----
def one_hot(col, k: int) -> Column:
    """Integer class -> array<int> of length k with a single 1 (all zero when out of range or NULL)."""
    c = _c(col)
    return F.transform(F.sequence(F.lit(0), F.lit(int(k) - 1)),
                       lambda i: F.coalesce(i == c, F.lit(False)).cast("int"))


# ---------------------------------------------------------------- C8 -----
def argmax(col) -> Column:
    """0-based index of the largest element, the first one on ties; NULL for an empty array."""
    c = _c(col)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


# ---------------------------------------------------------------- C10 ----
def to_grid(col, h: int, w: int) -> Column:
    """Flat row-major vector of h*w -> array of h rows of w values."""
    c = _c(col)
    return F.transform(F.sequence(F.lit(0), F.lit(int(h) - 1)),
                       lambda r: F.slice(c, r * int(w) + 1, int(w)))


def from_grid(col) -> Column:
    return F.flatten(_c(col))


# ---------------------------------------------------------------- J2 -----
def squared_error(x, xhat) -> Column:
    """Per-row mean squared difference of two equal-length arrays (anomaly score)."""
    x, xhat = _c(x), _c(xhat)
    sq = F.zip_with(x, xhat, lambda a, b: (a.cast("double") - b.cast("double")) *
                    (a.cast("double") - b.cast("double")))
    return F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v) / F.size(x)


def dot(x, weights: list[float]) -> Column:
    """Linear score of an array column against fixed weights (no bias)."""
    x = _c(x)
    w = F.array(*[F.lit(float(v)) for v in weights])
    prod = F.zip_with(x, w, lambda a, b: a.cast("double") * b)
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)
