"""Corpus pipeline: five stages over ``documents``.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that calls one
operator of ``seqlab.llm`` on all rows its predecessor kept; its result is
written as Parquet and read back as the next one's ``docs``. All but the last
return the columns of ``documents``.

1. ``toxicity``: rows that score below the threshold stay.
2. ``near_duplicates``: of each class the document with the smallest id stays.
3. ``decontamination``: documents into which a benchmark item leaks go.
4. ``pii``: personal data is replaced by its kind; ``n_chars`` is the new length.
5. ``bpe``: token ids and their digest, and the digest of what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.llm.bpe import encode_decode
from seqlab.llm.common import saved, table
from seqlab.llm.decontamination import drop_contaminated
from seqlab.llm.minhash import keep_one_of_each
from seqlab.llm.pii import redacted
from seqlab.llm.queries import tokenizer_path
from seqlab.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_decode(docs, tokenizer_path())
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("pii", pii), ("bpe", bpe)]

# the toxicity score comes from a fitted model: no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
