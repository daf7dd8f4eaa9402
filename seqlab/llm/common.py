"""Shared helpers: column selection, durable intermediate tables, Arrow slices."""

from __future__ import annotations

import ctypes
import uuid
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seqlab.operators.ordering import ordered_prefix
from seqlab.session import checkpoint_dir

SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, under fixed names, so that
    other columns of the input (whatever their names) never clash."""
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    lineage is cut, and a lost executor costs no recomputation of it."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_bytes(col: str = "text") -> Column:
    return F.octet_length(F.col(col)).cast("long")


def release_memory() -> None:
    """Give memory that earlier tasks of this worker have freed back to the system,
    so that stages of one session do not add up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library: nothing to trim
        pass


def text_slices(batches, column: int = 1, max_bytes: int = SLICE_BYTES):
    """Cut Arrow batches into slices of about ``max_bytes`` of text, so that
    what a task holds does not follow the batch size. A longer row is a slice
    of its own. Frees what the worker does not use, before and after."""
    release_memory()
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
    release_memory()


def id_ranges(rows: DataFrame, size: Column, target: int, name: str = "batch") -> tuple[DataFrame, list]:
    """``rows`` (column ``id``, never null) with a number ``name`` for contiguous
    id ranges that hold less than twice ``target`` of ``size``, wherever the ids
    lie; and the ``(first number, parts)`` of ids that were divided.

    Numbers ascend with the ids. The cuts follow running sums over distinct ids,
    so they are the same in every run. An id heavier than ``target`` gets odd
    numbers of its own, every other one from the first on; its rows are cut by
    running sums in the order of a hash of their columns (equal rows may be cut
    anywhere) and written once, so that every reader sees the same cuts.
    """
    sums = rows.groupBy("id").agg(F.sum(size.cast("long")).alias("__n"))
    chunks = saved(sums.repartitionByRange("id").withColumn("__chunk", F.spark_partition_id()), "id-sums")
    totals = sorted(tuple(r) for r in chunks.groupBy("__chunk").agg(F.sum("__n")).collect())   # one row per chunk
    offsets = dict(zip([c for c, _ in totals], accumulate((n for _, n in totals), initial=0)))
    within = Window.partitionBy("__chunk").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    if not offsets:
        return rows.withColumn(name, F.lit(0).cast("long")), []
    begin = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    at = chunks.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0)) + begin[F.col("__chunk")])
    heavy = F.col("__n") > target
    number = 2 * F.floor(F.col("__before") / target).cast("long") + heavy.cast("long")
    cuts = sorted(tuple(r) for r in at.groupBy(number.alias("number")).agg(   # one row per range
        F.min("id").alias("id"), F.max(F.floor(F.col("__n") / target)).cast("long").alias("parts")).collect())
    cuts = [(n, i, parts if n % 2 else 1) for n, i, parts in cuts]
    numbers, firsts, parts = (F.split(F.lit(",".join(map(str, c))), ",").cast("array<bigint>") for c in zip(*cuts))
    # binary search: how many ranges start at this id or before
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        F.get(firsts, n + step - 1) <= F.col("id"), n + step).otherwise(n))
    divided = [(n, p) for n, _, p in cuts if p > 1]
    out = rows.withColumn(name, F.get(numbers, found - 1))
    if divided:
        whole, odd = [*rows.columns, name], F.col(name) % 2 == 1
        cut = out.where(odd).withColumns({"__row": F.xxhash64(*rows.columns), "__size": size.cast("long"),
                                          "__place": F.monotonically_increasing_id()})
        cut = ordered_prefix(cut, [name], ["__row", "__place"], {"__before": "__size"})
        part = F.least(F.floor(F.col("__before") / target).cast("long"), F.get(parts, found - 1) - 1)
        out = out.where(~odd).unionByName(cut.withColumn(name, F.col(name) + 2 * part).select(*whole))
    return out, divided
