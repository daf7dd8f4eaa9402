"""Lookup of single sequences in saved data.

``save_sequences`` sorts rows by (id, step) across files. A zone map, one row
per file with its first and last key and its rows, is written beside the data
the first time it is needed; a lookup opens only the files whose keys can cover
the ids asked for.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.sources.readers import _fs, path_exists, scratch_path


def zone_map(spark: SparkSession, path: str, id_col: str, step: str) -> DataFrame:
    """``file, first, last, rows`` of every file below ``path``; ``first`` and
    ``last`` are (id, step). NULL keys sort first.

    Kept in ``<path>.zones/<digest of the file names>``: part files of another
    write have other names, so a map never outlives its data, and a map left
    half written is not used. Only the two key columns are read to build it."""
    data = spark.read.parquet(path)
    names = "|".join([id_col, step, *sorted(data.inputFiles())])
    place = f"{path.rstrip('/')}.zones/{hashlib.sha1(names.encode()).hexdigest()[:16]}"
    if not path_exists(spark, f"{place}/_SUCCESS"):
        key = F.struct(F.col(id_col).alias("id"), F.col(step).alias("step"))
        own = scratch_path(spark, "zones")
        data.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows")).write.parquet(own)
        fs, target = _fs(spark, place)
        _, source = _fs(spark, own)
        fs.mkdirs(target.getParent())
        if not fs.exists(target):      # a map that another session finished first stays
            fs.rename(source, target)
    return spark.read.parquet(place)


def lookup_sequences(spark: SparkSession, path: str, ids: list, id_col: str, step: str, first: int | None = None,
                     last: int | None = None) -> DataFrame:
    """The rows of the sequences ``ids`` (and of steps ``first`` to ``last``,
    inclusive, if given), with all columns.

    Only files whose zone can hold one of the keys are opened: about one per id,
    more for a sequence that fills many files; inside them parquet statistics
    prune row groups. Ids that are not there give no rows, NULL finds nothing."""
    data = spark.read.parquet(path)
    kind = data.schema[id_col].dataType
    wanted = F.array(*[F.lit(i).cast(kind) for i in dict.fromkeys(ids) if i is not None]).cast(f"array<{kind.simpleString()}>")
    zones = zone_map(spark, path, id_col, step)

    def covers(i):
        from_key, to_key = F.col("first"), F.col("last")
        low = (to_key["id"] > i) | ((to_key["id"] == i) & (F.lit(True) if first is None else to_key["step"] >= first))
        high = from_key["id"].isNull() | (from_key["id"] < i) | (
            (from_key["id"] == i) & (F.lit(True) if last is None else from_key["step"] <= last))
        return F.coalesce(low & high, F.lit(False))

    files = [r["file"] for r in zones.where(F.exists(wanted, covers)).select("file").collect()]   # files to open
    if not files:
        return data.where(F.lit(False))
    rows = spark.read.schema(data.schema).option("basePath", path).parquet(*files)
    rows = rows.where(F.col(id_col).isin([i for i in dict.fromkeys(ids) if i is not None]))
    if first is not None:
        rows = rows.where(F.col(step) >= first)
    return rows if last is None else rows.where(F.col(step) <= last)
