"""Skew-safe ordered numbering and prefix sums.

A ``row_number() OVER (PARTITION BY k ORDER BY o)`` sends every row of one
key to one task. When a single key may hold a third of all rows that task
becomes the whole job. ``ordered_prefix`` computes the same numbers with one
range partitioning, for inputs of every size:

1. rows are range-partitioned and sorted by (key, order), so a hot key is
   spread over as many tasks as its rows need; the boundaries live in the
   partitioner, not in the rows;
2. each task runs over its sorted rows once, Arrow batch by Arrow batch, and
   adds the prefix inside (chunk, key); only the running totals of the current
   key are held;
3. the chunks are written to the shared folder, which fixes them: both uses
   below, and any retried task, read the same chunks;
4. only the first key of a chunk can continue from an earlier chunk. One row
   per chunk (its first and last key, and the last key's total) gives the
   offsets; that table has as many rows as there are chunks. It is broadcast as
   long as it is small, so the rows are not moved again.

Totals of the whole key (``total``) come with the same exchange: a second sort
of each chunk, by falling place, lets a task carry the key's sum backwards, and
the table of edges adds what the other chunks hold of a chunk's first and last
key. Without keys a chunk is one group, so the edges alone give the total.

Keys are compared by a 64-bit hash inside a chunk, where rows are sorted by the
keys themselves. Sums of fractions may differ in the last bits with the number
of chunks; counts and sums of integers are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seqlab.session import saved

BROADCAST_BYTES = 64 << 20
_GROUP, _CHUNK, _AT, _W, _P, _T = "__group", "__chunk", "__at", "__weights", "__before", "__total"


def _num_ranges(df: DataFrame, num: int | None) -> int:
    return int(num) if num else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _local_prefix(n_keep: int):
    """Exclusive prefix sums inside (chunk, key) over a sorted partition.
    Columns: the kept ones, group hash, chunk, weights."""
    def run(batches):
        group, totals, at = None, 0.0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(n_keep).to_numpy(zero_copy_only=False)
            w = batch.column(n_keep + 2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            goes_on = group is not None and g[0] == group
            first = np.flatnonzero(np.concatenate([[not goes_on], g[1:] != g[:-1]]))
            start = np.zeros(n, np.int64)
            start[first] = first
            start = np.maximum.accumulate(start)          # first row of the key in this batch
            run_to = np.concatenate([np.zeros((1, w.shape[1])), np.cumsum(w, axis=0)])
            before = run_to[:-1] - run_to[start]
            if goes_on:
                before[:first[0] if len(first) else n] += totals
            group, totals = g[-1], before[-1] + w[-1]
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(n_keep + 3)], pa.array(np.arange(at, at + n)),
                 pa.ListArray.from_arrays(offsets, pa.array(before.ravel()))], [*batch.schema.names, _AT, _P])
            at += n
    return run


def _local_total(n_keep: int):
    """Sums over all rows of (chunk, key), for the rows of a chunk in falling
    order: the last row of a key knows them and hands them on to the others."""
    def run(batches):
        group, total = None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(n_keep).to_numpy(zero_copy_only=False)
            w, p = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                    for i in (n_keep + 2, n_keep + 4))
            goes_on = group is not None and g[0] == group
            last = np.flatnonzero(np.concatenate([[not goes_on], g[1:] != g[:-1]]))
            sums = p[last] + w[last]
            if goes_on:
                last, sums = np.concatenate([[0], last]), np.concatenate([total[None], sums])
            whole = np.repeat(sums, np.diff(np.concatenate([last, [n]])), axis=0)
            group, total = g[-1], sums[-1]
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(whole.ravel()))],
                [*batch.schema.names, _T])
    return run


def ordered_sums(df: DataFrame, by: list[str], order: list, weights, name: str = "before",
                 num_ranges: int | None = None, width: int | None = None, total: str | None = None) -> DataFrame:
    """Add ``name array<double>``: the *exclusive* prefix sums of the array
    column ``weights`` (one length for all rows, no NULLs) within each ``by``
    group in ``order``, and as ``total``, if named, the sums over the whole group.
    ``width`` is that length, if it is known. The offsets (at most two rows per
    chunk, of ``width`` numbers each) are broadcast up to BROADCAST_BYTES and
    joined by chunk beyond. See ``ordered_prefix``."""
    by, names, ranges = list(by), list(df.columns), _num_ranges(df, num_ranges)
    key = [F.col(b) for b in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    group = F.xxhash64(*by) if by else F.lit(0).cast("long")
    ranged = df.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    ranged = ranged.select(*names, group.alias(_GROUP), F.spark_partition_id().alias(_CHUNK),
                           weights.cast("array<double>").alias(_W))
    sums = T.ArrayType(T.DoubleType())
    schema = T.StructType([*ranged.schema.fields, T.StructField(_AT, T.LongType()), T.StructField(_P, sums)])
    numbered = ranged.mapInArrow(_local_prefix(len(names)), schema)
    if total and by:
        falling = numbered.sortWithinPartitions(F.col(_AT).desc())
        numbered = falling.mapInArrow(_local_total(len(names)), T.StructType([*schema.fields, T.StructField(_T, sums)]))
    chunks = saved(numbered, "ordered")

    # per chunk the totals of its first and of its last key: what of the key lies
    # in earlier chunks, and its sum over all
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    here = plus(_P, _W)
    first, last = (F.struct(F.col(_GROUP).alias("g"), v.alias("t")) for v in (F.col(_T) if total and by else here, here))
    edges = chunks.groupBy(_CHUNK).agg(F.min_by(first, _AT).alias("first"), F.max_by(last, _AT).alias("last"))
    if total and by:
        both = F.when(F.col("first.g") == F.col("last.g"), F.array("last")).otherwise(F.array("first", "last"))
        edges = edges.select(_CHUNK, F.explode(both).alias("e")).select(
            _CHUNK, "e.g", F.col("e.g").alias("first"), F.posexplode("e.t").alias("k", "t"))
    else:
        edges = edges.select(_CHUNK, F.col("last.g").alias("g"), F.col("first.g").alias("first"),
                             F.posexplode("last.t").alias("k", "t"))
    along = Window.partitionBy("k", "g").orderBy(_CHUNK)
    if total:
        edges = edges.withColumns({"all": F.sum("t").over(Window.partitionBy("k", "g")),
                                   "o": F.sum("t").over(along.rowsBetween(Window.unboundedPreceding, -1))})
        edges = edges.withColumn("o", F.coalesce("o", F.lit(0.0)))
    else:
        before = Window.partitionBy("k").orderBy(_CHUNK)   # as many rows as chunks
        edges = edges.withColumn("t", F.sum("t").over(along))
        edges = edges.withColumn("o", F.when(F.lag("g").over(before) == F.col("first"), F.lag("t").over(before)))
    column = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("k", c))), lambda x: x[c])
    offsets = edges.where(F.col("o").isNotNull()).groupBy(F.col(_CHUNK).alias("__c"), F.col("first").alias("__g")).agg(
        column("o").alias("__o"), *([column("all").alias("__all")] if total else []))
    if width is None:
        row = chunks.select(F.size(_P)).head()
        width = row[0] if row else 0
    if 8 * width * ranges * (4 if total else 1) <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    joined = chunks.join(offsets, (F.col(_CHUNK) == F.col("__c")) & (F.col(_GROUP) == F.col("__g")),
                         "left")
    out = [F.when(F.col("__o").isNull(), F.col(_P)).otherwise(plus(_P, "__o")).alias(name)]
    if total:
        out.append((F.coalesce("__all", _T) if by else F.col("__all")).alias(total))
    return joined.select(*names, *out)


def ordered_prefix(df: DataFrame, by: list[str], order: list, sums: dict[str, str],
                   num_ranges: int | None = None) -> DataFrame:
    """Add, for every row, the *exclusive* prefix sum of each column in ``sums``
    within its ``by`` group in ``order`` (ties must be broken by the order
    columns for a deterministic result). NULL keys are a group of their own;
    NULL and NaN weights count as 0.

    ``sums`` maps output name -> input column name; pass ``"__one"`` as the
    input to count rows. Outputs are doubles (exact for counts below 2**53).
    """
    zero = F.lit(0.0)
    weights = F.array(*[F.lit(1.0) if w == "__one" else F.coalesce(F.nanvl(F.col(w).cast("double"), zero), zero)
                        for w in sums.values()])
    out = ordered_sums(df, by, order, weights, "__sums", num_ranges, len(sums))
    return out.select(*df.columns, *[F.col("__sums")[k].alias(o) for k, o in enumerate(sums)])


def ordered_index(df: DataFrame, by: list[str], order: list, name: str = "idx",
                  num_ranges: int | None = None, count: str | None = None) -> DataFrame:
    """0-based position of each row within its ``by`` group (``by=[]``: global),
    and as ``count``, if named, the rows of the group; one exchange of the rows."""
    if not count:
        res = ordered_prefix(df, by, order, {name: "__one"}, num_ranges)
        return res.withColumn(name, F.col(name).cast("long"))
    res = ordered_sums(df, by, order, F.array(F.lit(1.0)), "__at0", num_ranges, 1, "__all0")
    return res.select(*df.columns, F.col("__at0")[0].cast("long").alias(name), F.col("__all0")[0].cast("long").alias(count))
