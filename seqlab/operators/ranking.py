"""Ranking within a label (F2) and best / worst N per label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seqlab.operators.ordering import ordered_index


def rank_within(df: DataFrame, label: str, score: str, tiebreak: str, name: str = "rank") -> DataFrame:
    """F2: 1-based ascending rank of each row by (score, tiebreak) inside its label.

    A full rank of a hot label is numbered by many tasks (skew-safe ordered
    index) rather than sorted by one window task.
    """
    out = ordered_index(df, [label], [score, tiebreak], name=name)
    return out.withColumn(name, (F.col(name) + 1).cast("long"))


def _reversed(df: DataFrame, name: str):
    """Ascending order columns that sort ``name`` from the highest down, as
    ``desc()`` does (NaN first, NULL last); None for types without a negative."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.IntegralType):
        return [c.isNull(), F.bitwise_not(c)]          # never overflows
    if isinstance(kind, T.FractionalType):
        nan = F.isnan(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.lit(False)
        return [F.when(c.isNull(), 2).when(nan, 0).otherwise(1), F.when(~nan, -c)]
    return None


def best_worst(df: DataFrame, label: str, score: str, tiebreak: str, n: int = 5) -> DataFrame:
    """the ``n`` lowest-score rows ("best", ascending) and the ``n`` highest
    ("worst", listed from the highest down) per label; fewer when a label has
    fewer rows.

    One scan: every row stands for both ends, with an order that is turned round
    for the second, and one rank filter over (label, end) keeps the ``n`` first.
    Spark plans it with a partial WindowGroupLimit before the only exchange, so at
    most 2 ``n`` rows per label and task are moved. Orders that cannot be turned
    round (text) take a branch per end."""
    turned = [_reversed(df, score), _reversed(df, tiebreak)]
    if None in turned:
        return _best_worst_branches(df, label, score, tiebreak, n)
    names, turned = list(df.columns), [c for part in turned for c in part]
    worst = F.col("kind") == "worst"
    both = df.withColumn("kind", F.explode(F.array(F.lit("best"), F.lit("worst"))))
    order = [F.when(~worst, F.col(score)), F.when(~worst, F.col(tiebreak)), *[F.when(worst, c) for c in turned]]
    rank = F.row_number().over(Window.partitionBy(label, "kind").orderBy(*order))
    out = both.withColumn("pos", rank).where(F.col("pos") <= int(n))
    return out.select(*names, F.col("pos").cast("long").alias("pos"), "kind")


def _best_worst_branches(df: DataFrame, label: str, score: str, tiebreak: str, n: int) -> DataFrame:
    asc = Window.partitionBy(label).orderBy(F.col(score).asc(), F.col(tiebreak).asc())
    desc = Window.partitionBy(label).orderBy(F.col(score).desc(), F.col(tiebreak).desc())
    best = df.withColumn("pos", F.row_number().over(asc)).where(F.col("pos") <= int(n)) \
        .withColumn("kind", F.lit("best"))
    worst = df.withColumn("pos", F.row_number().over(desc)).where(F.col("pos") <= int(n)) \
        .withColumn("kind", F.lit("worst"))
    return best.unionByName(worst).withColumn("pos", F.col("pos").cast("long"))
