"""Sources (A1-A5) and the sequence sink.

Row order inside files matters for the reference's readers (a line is a
time step, or row i of five files is one sample). Spark gives no order, so:

* a line number is rebuilt from (file, split, position in split) plus
  per-split offsets: a split is read by one task in offset order, and the
  offsets table has one row per split. Per-sample files (a line is a step)
  and large single files (a line is a record) are both read split-parallel.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seqlab.operators.ordering import ordered_prefix
from seqlab.session import checkpoint_dir, saved

# 23-column vessel position layout, applied by position (fixed values).
VESSEL_SCHEMA = T.StructType([
    T.StructField("Timestamp", T.StringType()), T.StructField("VesselType", T.StringType()),
    T.StructField("MMSI", T.StringType()), T.StructField("Lat", T.DoubleType()),
    T.StructField("Lon", T.DoubleType()), T.StructField("Status", T.StringType()),
    T.StructField("ROT", T.DoubleType()), T.StructField("SOG", T.DoubleType()),
    T.StructField("COG", T.DoubleType()), T.StructField("Heading", T.IntegerType()),
    T.StructField("IMO", T.StringType()), T.StructField("Callsign", T.StringType()),
    T.StructField("Name", T.StringType()), T.StructField("Shiptype", T.StringType()),
    T.StructField("Cargotype", T.StringType()), T.StructField("Width", T.IntegerType()),
    T.StructField("Length", T.IntegerType()), T.StructField("FixingDevice", T.StringType()),
    T.StructField("Draught", T.DoubleType()), T.StructField("Destination", T.StringType()),
    T.StructField("ETA", T.StringType()), T.StructField("SourceType", T.StringType()),
    T.StructField("end", T.StringType()),
])


BROADCAST_SPLITS = 1_000_000   # at 32 bytes each
LAYOUT_VERSION = 2             # of the code that writes derived layouts


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` when the session
    names one, else the context's checkpoint folder (set for local tests)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder."""
    return f"{shared_base(spark)}/seqlab-{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def staged(spark: SparkSession, name: str, sources: list[str], write) -> str:
    """Write a derived file layout once and reuse it: the folder name is keyed
    by the layout name and the sources' paths, sizes and modification times;
    a finished write leaves ``_SUCCESS``, so a half-written folder is redone.
    ``write(path)`` must overwrite ``path``."""
    import hashlib

    h = hashlib.sha1(f"{name}|{LAYOUT_VERSION}".encode())
    for src in sources:
        fs, p = _fs(spark, src)
        st = fs.getFileStatus(p)
        h.update(f"{src}|{st.getLen()}|{st.getModificationTime()}".encode())
    path = f"{shared_base(spark)}/seqlab-stage/{name}-{h.hexdigest()[:16]}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        # written under a name of its own, then renamed: a session that comes
        # second finds the finished folder and uses it
        own = scratch_path(spark, f"stage-{name}")
        write(own)
        fs, target = _fs(spark, path)
        fs.mkdirs(target.getParent())
        if not fs.exists(target):
            fs.rename(_fs(spark, own)[1], target)
    return path


# ------------------------------------------------------------ A1, A2 ------
def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, skip_prefix: str | None = None) -> DataFrame:
    """A1: header + inferred schema (``schema=None``), or A2: a positional schema
    over header-less lines, dropping the lines that start with ``skip_prefix``.

    A2 uses the CSV source with the schema applied by position (PERMISSIVE: a
    bad cell is NULL), so only the columns a query uses are converted. A line
    starts with the prefix exactly when its first cell does, as long as the
    prefix holds no separator or quote; otherwise the raw lines are
    filtered as text before parsing."""
    if schema is None:
        return spark.read.csv(path, header=header, inferSchema=True)
    if not skip_prefix:
        return spark.read.schema(schema).csv(path, header=False, mode="PERMISSIVE")
    if not any(ch in skip_prefix for ch in ',"'):
        df = spark.read.schema(schema).csv(path, header=False, mode="PERMISSIVE")
        first = F.col(schema.fields[0].name)
        return df.where(first.isNull() | ~first.startswith(skip_prefix))
    lines = spark.read.text(path).where(~F.col("value").startswith(skip_prefix))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select(F.from_csv(F.col("value"), ddl, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.*")


def bad_cells(spark: SparkSession, path: str, schema: T.StructType, skip_prefix: str | None = None) -> DataFrame:
    """A2: per column of ``schema`` how many cells hold text that its type cannot
    read (``column``, ``bad``). Such cells are NULL in ``scan_csv``; empty cells
    are missing, not bad. One scan, one row of counters."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = scan_csv(spark, path, text, skip_prefix=skip_prefix)
    counts = rows.agg(*[
        F.sum((F.col(f"`{f.name}`").isNotNull() & (F.trim(f"`{f.name}`") != "")
               & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).cast("long")).alias(f"n{i}")
        for i, f in enumerate(schema.fields)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.coalesce(F.col(f"n{i}"), F.lit(0).cast("long")).alias("bad"))
        for i, f in enumerate(schema.fields)])).alias("c")).select("c.*")


# ------------------------------------------------------------------ A3 ----
def scan_numbered_sequences(spark: SparkSession, path: str, lo: int, hi: int, columns: list[str],
                            skip: int = 1, sep: str = ",", id_pattern: str = r"(\d+)\.csv$",
                            id_col: str = "sample_id") -> DataFrame:
    """A3: one file per sample (id taken from the file path by ``id_pattern``),
    ids ``lo..hi`` inclusive, first ``skip`` lines dropped, each remaining line
    is a step (0-based) with ``columns`` as doubles.

    Lines are read split-parallel and numbered inside their file by
    ``number_lines``, so a very long sample is read by many tasks and is
    never held as one record. The id range is applied to the file paths
    before any line is numbered."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    sid = F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1)
    lines = lines.where((sid != "") & sid.cast("long").between(int(lo), int(hi)))
    numbered = number_lines(lines, "__ln", skip=skip, per_file=True, keep_path=True)
    numbered = numbered.where(F.length("value") > 0)
    cells = F.split(F.col("value"), _re(sep))
    return numbered.select(
        F.regexp_extract(F.col("__path"), id_pattern, 1).cast("long").alias(id_col),
        F.col("__ln").cast("long").alias("step"),
        *[cells.getItem(i).try_cast("double").alias(c) for i, c in enumerate(columns)])


def _re(sep: str) -> str:
    import re
    return re.escape(sep)


# ------------------------------------------------------------------ A4 ----
def _counted_prefix(df: DataFrame, by: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """``ordered_prefix`` of a table whose rows were counted to be few: one window."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(o) for o, c in sums.items()])


def number_lines(lines: DataFrame, name: str = "row_no", skip: int = 0, per_file: bool = False,
                 keep_path: bool = False) -> DataFrame:
    """Dense 0-based record numbers of a text scan in (file path, offset) order
    (``per_file``: restarting in every file), after dropping the first
    ``skip`` lines of every file; no window over the rows.

    Each input split (file, block start) is read by one task in order, so a
    line's position inside its split is its id minus the split's smallest
    id. The per-split counts (one row per split: data size / split size,
    never per row) give each split's offset inside its file and each file's
    offset in the whole scan. These offsets (32 bytes a split) are counted and
    broadcast up to BROADCAST_SPLITS splits, so the text itself is not moved;
    beyond that they are joined by split.
    """
    tagged = lines.select("*", F.col("_metadata.file_path").alias("__f"),
                          F.col("_metadata.file_block_start").alias("__b"),
                          F.monotonically_increasing_id().alias("__m"))
    splits = saved(tagged.groupBy("__f", "__b").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__m0")),
                   "line-splits")
    few = splits.count() <= BROADCAST_SPLITS
    # sums along a table of at most BROADCAST_SPLITS rows need no ranges of their own
    along = _counted_prefix if few else ordered_prefix
    offsets = along(splits, ["__f"], ["__b"], {"__foff": "__n"})
    if not per_file:
        keep = F.greatest(F.sum("__n") - int(skip), F.lit(0)).alias("__keep")
        files = along(splits.groupBy("__f").agg(keep), [], ["__f"], {"__goff": "__keep"})
        offsets = offsets.join(files.select("__f", "__goff"), "__f")
    else:
        offsets = offsets.withColumn("__goff", F.lit(0.0))
    # a line number is its id minus this base: one number per split
    base = (F.col("__m0") - F.col("__foff").cast("long") + int(skip)).alias("__base")
    offsets = offsets.select(F.xxhash64("__f").alias("__fk"), F.col("__b").alias("__bk"), base,
                             F.col("__goff").cast("long").alias("__goff"))
    if few:
        offsets = F.broadcast(offsets)
    out = tagged.join(offsets, (F.xxhash64("__f") == F.col("__fk")) & (F.col("__b") == F.col("__bk")))
    out = out.where(F.col("__m") >= F.col("__base"))
    out = out.withColumn(name, F.col("__goff") + F.col("__m") - F.col("__base"))
    if keep_path:
        out = out.withColumnRenamed("__f", "__path")
    return out.drop("__f", "__b", "__m", "__fk", "__bk", "__base", "__goff")


def scan_rows_numbered(spark: SparkSession, path: str, columns: list[str], skip: int = 1,
                       sep: str = ",") -> DataFrame:
    """A4: CSV records with a dense 0-based ``row_no`` in file order. The first
    ``skip`` lines of every file are dropped (a header per part file); files
    are taken in path order, so a folder of sorted part files reads as one
    ordered file."""
    lines = number_lines(spark.read.text(path), "row_no", skip=skip)
    cells = F.split(F.col("value"), _re(sep))
    return lines.select("row_no", *[cells.getItem(i).try_cast("double").alias(c)
                                    for i, c in enumerate(columns)])


# ------------------------------------------------------------------ A5 ----
def scan_vectors(spark: SparkSession, path: str, id_col: str, vector: str, label: str) -> DataFrame:
    """A5: labelled vectors -> (id, features array<double>, label)."""
    df = spark.read.parquet(path)
    return df.select(F.col(id_col).alias("id"),
                     F.transform(F.col(vector), lambda v: v.cast("double")).alias("features"),
                     F.col(label).cast("int").alias("label"))


# ------------------------------------------------------------------ A6 ----
def save_sequences(df: DataFrame, path: str, id_col: str, step: str, mode: str = "ignore",
                   num_files: int | None = None, partition_by: str | None = None) -> bool:
    """Write prepared sequences unless they are already there.

    With ``mode="ignore"`` a folder counts as present only when a finished
    write left ``_SUCCESS`` in it; a folder left by a failed job is written
    again. Rows are range-partitioned and sorted by (id, step): a hot id is
    spread over as many files as its rows need, and a lookup by id prunes row
    groups through parquet min/max statistics. ``partition_by`` writes one
    folder per value of that column (train and test) from one pass over ``df``.
    Returns True when data was written."""
    spark = df.sparkSession
    if mode == "ignore":
        if path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
            return False
        mode = "overwrite"
    keys = [id_col, step]
    out = df.repartitionByRange(num_files, *keys) if num_files else df.repartitionByRange(*keys)
    writer = out.sortWithinPartitions(*([partition_by] if partition_by else []), *keys).write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return True


def load_sequences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
