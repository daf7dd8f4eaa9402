import hashlib
import zlib

import corpus_pipeline
import __spark_entry__ as entry
from llm_data import AWKWARD, docs
from seqlab.llm.common import saved
from seqlab.llm.decontamination import mark_contamination
from seqlab.llm.pii import find_personal_data
from seqlab.llm.queries import tokenizer_path


def test_one_query_per_operator():
    names = entry.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "bpe"]


def test_stages_keep_columns_and_take_effect(spark, sf_small):
    from tokenizers import Tokenizer
    source = d = spark.read.parquet(f"{sf_small}/documents.parquet")
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, d, sf_small), "test-stage")
        if name != "bpe":
            assert out.columns == source.columns and out.dtypes == source.dtypes
            assert out.count() <= d.count()
        by_stage[name] = out
        d = out
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    items = [r["text"] for r in bench.collect()]
    clean = {r["doc_id"]: r["text"] for r in by_stage["decontamination"].collect()}
    assert not any(i in t for i in items for t in clean.values())
    gone = by_stage["near_duplicates"].join(by_stage["decontamination"], "doc_id", "left_anti")
    assert mark_contamination(gone, bench).where("size(contamination) = 0").count() == 0
    texts = [r["text"] for r in by_stage["near_duplicates"].collect()]
    assert len(texts) == len(set(texts))
    spans = {r["id"]: list(r["base"]) + list(r["added"]) for r in find_personal_data(by_stage["decontamination"]).collect()}
    for r in by_stage["pii"].collect():
        assert r["n_chars"] == len(r["text"]) and (r["text"] == clean[r["doc_id"]]) == (not spans[r["doc_id"]])
    library = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in by_stage["pii"].collect()}
    for r in d.collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_toxicity_keeps_clean_rows(spark, sf_small):
    d = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.toxicity(spark, d, sf_small).select("doc_id").collect()}
    truth = [(r["doc_id"], r["toxic"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    clean = [i in kept for i, y in truth if y == 0]
    assert sum(clean) >= 0.95 * len(clean)


def test_awkward_rows_pass_every_stage(spark, sf_small):
    d = docs(spark, AWKWARD)
    for _, stage in corpus_pipeline.STAGES:
        d = saved(stage(spark, d, sf_small), "test-stage")
    # equal texts are one document; the rest stays
    assert d.count() == len({t or "" for _, t in AWKWARD})
