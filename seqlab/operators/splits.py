"""Splits and batches (B6 via projection, G1-G3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seqlab.operators.ordering import ordered_index


def hash_bucket(key) -> Column:
    """Deterministic 0..99 bucket from the first 32 bits of md5(key text)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(100))


def hash_split(df: DataFrame, key: str, train_pct: int = 80, name: str = "split") -> DataFrame:
    """G1: whole sequences (all rows of a key) go to 'train' when their hash
    bucket is below ``train_pct``, else to 'test'. Narrow, no shuffle, and
    stable across runs and partition counts (unlike an unseeded random split)."""
    return df.withColumn(name, F.when(hash_bucket(key) < int(train_pct), F.lit("train"))
                         .otherwise(F.lit("test")))


def batch_split(df: DataFrame, batch_id: str, order: list[str], frac: float = 0.8,
                name: str = "split") -> DataFrame:
    """Inside each batch the first ``floor(frac * size)`` rows (at least one)
    by ``order`` are 'train', the rest 'validation'. A batch is bounded by the
    batch size, so the per-batch window is bounded."""
    w = Window.partitionBy(batch_id).orderBy(*order)
    wall = Window.partitionBy(batch_id)
    n_train = F.greatest(F.floor(F.count(F.lit(1)).over(wall) * float(frac)), F.lit(1))
    return df.withColumn(name, F.when(F.row_number().over(w) <= n_train, F.lit("train"))
                         .otherwise(F.lit("validation")))


def mini_batches(df: DataFrame, order: list[str], size: int, name: str = "batch_id",
                 dense_id: str | None = None) -> DataFrame:
    """Consecutive fixed-size batches in ``order``; the last may be short.

    With a dense 0-based id column the batch is ``id div size`` (narrow).
    Otherwise a global position comes from the ordered index, so the input is
    never numbered by a single task."""
    if dense_id is not None:
        return df.withColumn(name, F.floor(F.col(dense_id) / int(size)).cast("long"))
    out = ordered_index(df, [], order, name="__pos")
    return out.withColumn(name, F.floor(F.col("__pos") / int(size)).cast("long")).drop("__pos")


def mini_batch_split(df: DataFrame, order: list[str], size: int, frac: float = 0.8,
                     batch: str = "batch_id", name: str = "split") -> DataFrame:
    """G3 and G2 in one exchange: consecutive batches of ``size`` rows in ``order``,
    and in each the first ``floor(frac * rows)`` (at least one) are 'train'. The
    place in a batch and the length of the last one follow from the row's
    position and the number of all rows."""
    size = int(size)
    out = ordered_index(df, [], order, name="__pos", count="__rows")
    number = F.floor(F.col("__pos") / size).cast("long")
    held = F.least(F.lit(size).cast("long"), F.col("__rows") - number * size)
    n_train = F.greatest(F.floor(held * float(frac)), F.lit(1))
    train = F.when(F.col("__pos") - number * size < n_train, F.lit("train")).otherwise(F.lit("validation"))
    return out.select(*df.columns, number.alias(batch), train.alias(name))


def index_split(df: DataFrame, id_col: str, train_hi, valid_hi=None, name: str = "split") -> DataFrame:
    """Ids <= train_hi are 'train', ids in (train_hi, valid_hi] 'validation'
    (everything above valid_hi, when given, is 'unused'). Bounds may be columns."""
    lo = F.col(id_col) <= (train_hi if isinstance(train_hi, Column) else F.lit(train_hi))
    out = F.when(lo, F.lit("train"))
    if valid_hi is None:
        out = out.otherwise(F.lit("validation"))
    else:
        hi = valid_hi if isinstance(valid_hi, Column) else F.lit(valid_hi)
        out = out.when(F.col(id_col) <= hi, F.lit("validation")).otherwise(F.lit("unused"))
    return df.withColumn(name, out)


def batch_transform(df: DataFrame, batch_id: str, fn, schema) -> DataFrame:
    """L2: apply a user's ``fn(pandas.DataFrame) -> pandas.DataFrame`` to every
    batch (all rows of one ``batch_id``; a NULL id is a batch of its own). Batches
    are independent and bounded by the batch size; ``schema`` names the columns
    that ``fn`` returns. An empty table gives an empty table."""
    names = df.columns

    def run(pdf):
        return fn(pdf[names].reset_index(drop=True))
    return df.groupBy(batch_id).applyInPandas(run, schema)
