"""Registered queries of the subpackage: thin, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.llm.common import documents, table

QUERIES: dict = {}
ORACLE: dict = {}
SHARDS = 24


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def tokenizer_path() -> str:
    """The byte-level tokenizer file; TOKENIZER_FILE names another."""
    if "TOKENIZER_FILE" in os.environ:
        return os.environ["TOKENIZER_FILE"]
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@register("op3_bpe_forced_boundaries")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seqlab.llm.bpe import encode_decode
    coded = encode_decode(documents(spark, sf_dir), tokenizer_path())
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@register("op6_pii_candidate_boosting")
def op6(spark, sf_dir):
    from seqlab.llm.pii import find_personal_data
    found = find_personal_data(documents(spark, sf_dir))
    base = F.col("base")
    return found.select(
        F.col("id").alias("doc_id"),
        *[_of_kind(base, k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


@register("op8_bounded_load_ring")
def op8(spark, sf_dir):
    from seqlab.llm.sharding import assign_shards
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = assign_shards(rows, SHARDS, "doc_id", ["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op10_secret_linking")
def op10(spark, sf_dir):
    from seqlab.llm.secrets import scan_secrets
    found = scan_secrets(documents(spark, sf_dir))
    base = F.col("base")
    return found.select(
        F.col("id").alias("doc_id"), *[_of_kind(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "linked"))).alias("spans"))


@register("op1_toxicity_trees")
def op1(spark, sf_dir):
    from seqlab.llm.toxicity import THRESHOLD, held_out, score_toxicity
    scored = score_toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))


@register("op7_decontamination_qgram")
def op7(spark, sf_dir):
    """One row per document and benchmark item that leaks into it."""
    from seqlab.llm.decontamination import mark_contamination
    marked = mark_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("contamination").alias("c")).select(
        "doc_id", "c.item_id", "c.pieces", "c.edits")


@register("op9_minhash_weighted")
def op9(spark, sf_dir):
    """One row per document with the smallest id of its class."""
    from seqlab.llm.minhash import near_duplicates
    return near_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "class_id", "kept")


@register("op4_substrings_prefix_free")
def op4(spark, sf_dir):
    from seqlab.llm.substrings import remove_repeats
    done = remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_warc_sharded")
def op5(spark, sf_dir):
    from seqlab.llm.warc import archived
    return archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op5_warc_sharded"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
first AS (SELECT html, min(page_id) AS page_id FROM p GROUP BY html),
d AS (SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes, unhex(sha1(p.html)) AS raw,
             f.page_id AS first FROM p JOIN first f ON p.html = f.html),
bits AS (SELECT page_id, payload_bytes, first, CAST(raw AS BIT)::VARCHAR AS b FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + 16 * CAST(b[5 * i + 1] AS INT) + 8 * CAST(b[5 * i + 2] AS INT) + 4 * CAST(b[5 * i + 3] AS INT)
                  + 2 * CAST(b[5 * i + 4] AS INT) + CAST(b[5 * i + 5] AS INT) AS BIGINT), 1)), 'string_agg', '')
           AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""


@register("op2_embedding_range_join")
def op2(spark, sf_dir):
    from seqlab.llm.embeddings import link_embeddings
    return link_embeddings(table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))


@register("op12_infill_swar")
def op12(spark, sf_dir):
    """One row per document: its form, cuts and digests of output and rebuilt text."""
    from seqlab.llm.infill import fill_in_middle, rebuilt
    cut = fill_in_middle(documents(spark, sf_dir))
    return cut.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(rebuilt(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE["op12_infill_swar"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
g AS (SELECT doc_id, t, length(t) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS h
      FROM d),
c AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS z,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
                  THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT doc_id, t, n, a, z, form, substring(t, 1, a) AS prefix, substring(t, a + 1, z - a) AS middle,
             substring(t, z + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@register("op11_centroids_simplex")
def op11(spark, sf_dir):
    """One row per vector: its cluster, the squared distance to the cluster's
    final centroid, and the centroid's digest and sums."""
    from seqlab.llm.clustering import centroid_clusters, centroid_digest
    assigned, centroids = centroid_clusters(table(spark, sf_dir, "embeddings"))
    total = sum(c["inertia"] for c in centroids)
    rows = spark.createDataFrame([(c["cluster"], c["inertia"], total, centroid_digest(c["vector"])) for c in centroids],
                                 "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(rows), "cluster").select(      # 40 rows
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _lloyd_rounds(rounds: int) -> str:
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT id, x, m.c AS c, m.d AS d FROM (
    SELECT p.id, any_value(p.x) AS x, min({{'d': list_sum(list_transform(list_zip(p.x, c.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))
           ::BIGINT, 'c': c.c}}) AS m FROM p CROSS JOIN c{i} c GROUP BY p.id))""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM (
      SELECT c, j, sum(v)::BIGINT AS s, count(*) AS n
      FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{i}) GROUP BY c, j)
    GROUP BY c) n ON n.c = c.c)""")
    return ",".join(parts)


ORACLE["op11_centroids_simplex"] = f"""
WITH p AS MATERIALIZED (
  SELECT vec_id AS id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, x
  FROM (SELECT sha256('2:' || id) AS h, x FROM p ORDER BY h LIMIT 40)),
{_lloyd_rounds(5)}
SELECT id AS vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(f.x, lambda e: e::VARCHAR), ',')) AS centroid_sha256
FROM a5 a JOIN c5 f ON f.c = a.c
"""


@register("op13_deleted_interpolation")
def op13(spark, sf_dir):
    """One row per document: its tokens and its log10 probability by the add-half
    unigram model and by the interpolated one."""
    from seqlab.llm.language_model import TUNE_EVERY, fold, score_texts
    scored, model = score_texts(documents(spark, sf_dir), train=fold("doc_id", 5) != 1,
                                tune=fold("doc_id", TUNE_EVERY, skip=5) == 0)
    return scored.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
