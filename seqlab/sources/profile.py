"""A1 in one pass: column types, empty and unreadable cells of CSV text.

A column's type is the least one of a lattice that reads all of its cells. For
every type one flag per column says whether it has read all cells so far; flags
merge by "and", so types and counts come from one aggregate over one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# from the narrowest on; a column that none of them reads is text
LATTICE = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean")


def _reads(kind: str, cell: Column) -> Column:
    if kind == "decimal":
        return cell.rlike(r"^[+-]?[0-9]{1,38}$")
    if kind == "date":
        return cell.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & cell.try_cast("date").isNotNull()
    if kind == "boolean":
        return F.lower(cell).isin("true", "false")
    if kind == "double":
        # what a cast would also read, but no number format: a trailing type letter
        return cell.try_cast("double").isNotNull() & ~cell.rlike("[dDfF]$|^[^0-9]*$") | cell.isin("NaN", "Inf", "-Inf")
    return cell.try_cast(kind).isNotNull()


def profile_csv(spark: SparkSession, path: str, declared: dict[str, str] | None = None) -> DataFrame:
    """``column, place, type, cells, empty, bad`` of CSV text with a header line:
    the type that inference gives, cells with text, cells without, and cells that
    the type in ``declared`` (else the inferred one: none) cannot read. A column
    without text is ``string``. One job reads the header, one all text."""
    rows = spark.read.option("header", True).csv(path)
    declared = declared or {}
    aggs = []
    for i, name in enumerate(rows.columns):
        cell = F.col(f"`{name}`")
        full = cell.isNotNull() & (cell != "")
        aggs += [F.count_if(full).alias(f"n{i}"), F.count_if(~F.coalesce(full, F.lit(False))).alias(f"e{i}")]
        aggs += [F.bool_and(F.when(full, _reads(k, cell))).alias(f"{k}{i}") for k in LATTICE]
        aggs.append(F.max(F.when(full, F.length(F.regexp_replace(cell, "^[+-]", "")))).alias(f"w{i}"))
        bad = full & cell.try_cast(declared[name]).isNull() if name in declared else F.lit(False)
        aggs.append(F.count_if(bad).alias(f"b{i}"))
    found = rows.agg(*aggs)

    def kind(i):
        out = F.when(F.col(f"n{i}") == 0, "string")
        for k in LATTICE:
            named = F.concat(F.lit("decimal("), F.col(f"w{i}").cast("string"), F.lit(",0)")) if k == "decimal" else F.lit(k)
            out = out.when(F.col(f"{k}{i}"), named)
        return out.otherwise("string")

    return found.select(F.explode(F.array(*[F.struct(
        F.lit(name).alias("column"), F.lit(i).alias("place"), kind(i).alias("type"), F.col(f"n{i}").alias("cells"),
        F.col(f"e{i}").alias("empty"), F.col(f"b{i}").alias("bad")) for i, name in enumerate(rows.columns)])).alias("c")
    ).select("c.*")


def scan_csv_profiled(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the inferred types, the profile): the text is read once for the
    types and counts and once for the rows."""
    profile = profile_csv(spark, path).persist()
    kinds = {r["place"]: (r["column"], r["type"]) for r in profile.collect()}       # one row per column
    schema = T.StructType([T.StructField(n, T.DataType.fromDDL(k)) for _, (n, k) in sorted(kinds.items())])
    return spark.read.option("header", True).schema(schema).csv(path), profile
