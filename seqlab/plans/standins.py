"""Stand-in inputs derived by Spark from the given tables.

The reference's own datasets (vessel positions, basket sequences, image
vectors, ...) are not available; every stand-in below is a projection of a
table in the data folder, so its work grows with the tables. The same
expressions are written in SQL in ``__spark_entry__.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vessel_positions(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """events -> (event_id, mmsi, ts, lat, lon). Both coordinate ranges overshoot
    the valid box, so the outlier filter has work to do."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")).alias("mmsi"),
        F.col("ts"),
        (F.col("value") * 0.4 - 95.0).alias("lat"),
        ((F.col("event_id") * 37) % 4000 / 10.0 - 200.0).alias("lon"),
        *extra,
    )


def binary_scores(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """labels x documents -> (id, y, score) with score in [0, 1]."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col(target).cast("int").alias("y"),
        F.least(F.lit(1.0), F.col("n_chars") / 20000.0).alias("score"),
    )


def multitarget_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two binary targets per row (quality, toxic) in long form: (id, target, y, score)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    score = F.least(F.lit(1.0), F.col("n_chars") / 20000.0)
    return j.select(
        F.col("doc_id").alias("id"),
        F.explode(F.array(
            F.struct(F.lit("quality").alias("target"), F.col("quality").cast("int").alias("y")),
            F.struct(F.lit("toxic").alias("target"), F.col("toxic").cast("int").alias("y")),
        )).alias("t"),
        score.alias("score"),
    ).select("id", "t.target", "t.y", "score")


def conversation_steps(spark: SparkSession, sf_dir: str, batch_size: int = 32) -> DataFrame:
    """Variable-length sequences: (seq_id, step, value, batch_id) from conversations."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        F.col("conv_id").alias("seq_id"),
        F.col("turn").alias("step"),
        F.length("text").cast("double").alias("value"),
        F.floor(F.col("conv_id") / batch_size).cast("long").alias("batch_id"),
    )


def class_scores(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Multi-class stand-in: (id, y, scores array<double>(k)) from embeddings; the
    score of a class is the sum of the cells i with i mod k = class, over all cells."""
    cells = F.transform("embedding", lambda v: v.cast("double"))
    total = lambda c: F.aggregate(F.filter(cells, lambda v, i: F.pmod(i, F.lit(k)) == c), F.lit(0.0),
                                  lambda s, v: s + v)
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), F.col("label").alias("y"),
                      F.transform(F.sequence(F.lit(0), F.lit(k - 1)), total).alias("scores"))


def regression_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression stand-in: (col, truth, prediction) from lineitem, scaled to O(1)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linenumber").cast("int").alias("col"),
        (F.col("l_extendedprice") / 100000.0).alias("truth"),
        (F.col("l_quantity") / 50.0).alias("prediction"),
    )
