"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use inside
                     T.StructField("id", T.StringType()), T.StructField("node", T.StringType()),
                     T.StructField("batch", T.StringType()), T.StructField("probability", T.StringType()),
                     T.StructField("row_hash", T.StringType()), T.StructField("spans", T.StringType())])


def docs(spark, rows):
    """rows: (doc_id, text)"""
    return spark.createDataFrame(
        [(i, t, None, "s", None if t is None else len(t), "x", None, "b", "p", None, "z") for i, t in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (None, "text without an id"), (5, "é" * 70_000),
           (6, "word " * 30_000), (7, "\x00\t\n' 's 'll <|endoftext|>   x  y　")]
