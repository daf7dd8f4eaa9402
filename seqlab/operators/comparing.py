"""L3: ordering by a user's comparator, where no ordering column exists.

The comparator is turned into range splitters: a sample of keys is sorted with it
on the driver, every row finds its range by binary search among the splitters,
and each range is sorted by the comparator in a task of its own. Rows that compare
equal to a splitter need no sorting; they are a range of their own that is dealt
over many tasks, so a key that holds a third of all rows is no hot spot.
"""

from __future__ import annotations

from functools import cmp_to_key
from typing import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seqlab.operators.ordering import _num_ranges
from seqlab.session import saved

SAMPLE = 64             # sampled keys per range; they steer balance, not results


def _place(splitters: list, compare: Callable, key) -> int:
    """2 * i + 1 for a key equal to splitter i, 2 * i for one before it."""
    low, high = 0, len(splitters)
    while low < high:
        mid = (low + high) // 2
        c = compare(splitters[mid], key)
        if c == 0:
            return 2 * mid + 1
        low, high = (mid + 1, high) if c < 0 else (low, mid)
    return 2 * low


def comparator_order(df: DataFrame, keys: list[str], compare: Callable, name: str = "pos",
                     num_ranges: int | None = None, seed: int = 123) -> DataFrame:
    """``df`` with ``name``: the 0-based place of each row in the order that
    ``compare(a, b)`` (negative, zero, positive) gives to the tuples of its
    ``keys``. It must be a total preorder over all values, None included. Rows that
    compare equal stand by a hash of all their columns. A task holds the rows of
    one range; more ``num_ranges`` make them smaller."""
    ranges, names = _num_ranges(df, num_ranges), list(df.columns)
    rows = df.withColumn("__h", F.xxhash64(*names))
    n = df.count()
    share = min(1.0, SAMPLE * ranges / max(n, 1))
    sample = [tuple(r) for r in df.select(*keys).sample(False, share, seed).collect()]     # about SAMPLE * ranges keys
    sample.sort(key=cmp_to_key(compare))
    splitters: list = []
    for k in sample[SAMPLE // 2::max(1, len(sample) // ranges)]:
        if not splitters or compare(splitters[-1], k):
            splitters.append(k)

    @F.pandas_udf("long")
    def place(*cols: pd.Series) -> pd.Series:
        seen: dict = {}
        out = []
        for key in zip(*[[None if v is None or v is pd.NA else v for v in c.astype(object)] for c in cols]):
            if key not in seen:
                if len(seen) > 100_000:
                    seen.clear()
                seen[key] = _place(splitters, compare, key)
            out.append(seen[key])
        return pd.Series(out)

    equal = F.col("__part") % 2 == 1
    rows = rows.withColumn("__part", place(*[F.col(k) for k in keys])).withColumn(
        "__salt", F.when(equal, F.pmod(F.col("__h"), F.lit(ranges))).otherwise(0))

    def ordered(table: pa.Table) -> pa.Table:
        table = table.sort_by("__h")
        if table.num_rows and table["__part"][0].as_py() % 2 == 0:
            values = list(zip(*[table[k].to_pylist() for k in keys]))
            key = cmp_to_key(lambda a, b: compare(values[a], values[b]))
            table = table.take(pa.array(sorted(range(len(values)), key=key), pa.int64()))
        return table.append_column("__at", pa.array(range(table.num_rows), pa.int64()))

    schema = T.StructType([*rows.schema.fields, T.StructField("__at", T.LongType())])
    done = saved(rows.groupBy("__part", "__salt").applyInArrow(ordered, schema), "compared")
    sizes = done.groupBy("__part", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part", "__salt").rowsBetween(Window.unboundedPreceding, -1)     # a row per range and salt
    offsets = sizes.select(F.col("__part").alias("__p"), F.col("__salt").alias("__s"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    out = done.join(offsets, (F.col("__part") == F.col("__p")) & (F.col("__salt") == F.col("__s")))
    return out.select(*names, (F.col("__before") + F.col("__at")).alias(name))
