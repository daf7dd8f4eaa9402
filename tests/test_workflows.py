"""The reference's end-to-end tasks on file layouts written from sf0.001 tables."""

import tempfile

import pytest
from pyspark.sql import functions as F

from seqlab.plans import io_queries, workflows as W
from seqlab.plans import standins as S
from seqlab.plans.queries import daily_grid
from seqlab.plans.trajectories import hourly_trajectories
from seqlab.operators import splits
from seqlab.sources import readers as A

SF = "/root/testdata/sf0.001"
PAT = r"sample_id=(\d+)/"


def _per_sample_files(df, path, header=True):
    (df.repartition("sample_id").sortWithinPartitions("sample_id", "step").drop("step")
     .write.mode("overwrite").partitionBy("sample_id").option("header", header).csv(path))


@pytest.fixture(scope="module")
def conv_dirs(spark):
    base = tempfile.mkdtemp(prefix="seqlab-wf-conv-")
    conv = S.table(spark, SF, "conversations").select(
        F.col("conv_id").alias("sample_id"), F.col("turn").alias("step"),
        (F.length("text") / 1000.0).alias("f0"), (F.col("role") == "assistant").cast("double").alias("f1"),
        (F.col("role") == "assistant").cast("int").alias("y1"), (F.length("text") > 500).cast("int").alias("y2"))
    _per_sample_files(conv.select("sample_id", "step", "f0", "f1"), f"{base}/sequence")
    _per_sample_files(conv.select("sample_id", "step", "y1"), f"{base}/y1")
    _per_sample_files(conv.select("sample_id", "step", "y2"), f"{base}/y2")
    mort = conv.groupBy("sample_id").agg((F.max("step") >= 4).cast("int").alias("label"), F.lit(0).alias("step"))
    _per_sample_files(mort.select("sample_id", "step", "label"), f"{base}/mortality", header=False)
    return base


def test_examine_and_prepare_trajectories(spark):
    stats = W.examine_positions(spark, io_queries.vessel_csv_named(spark, SF))
    assert stats.count() == S.vessel_positions(spark, SF).select("mmsi").distinct().count()
    train, test = W.prepare_trajectories(spark, io_queries.vessel_csv(spark, SF))
    want = hourly_trajectories(S.vessel_positions(spark, SF)).count()
    assert train.count() + test.count() == want
    assert train.select("mmsi").intersect(test.select("mmsi")).count() == 0
    tr, te = W.save_trajectories(train, test, tempfile.mkdtemp(prefix="seqlab-wf-save-"))
    assert spark.read.parquet(tr).count() == train.count()


def test_classify_sequences(spark, conv_dirs):
    out = W.classify_sequences(spark, f"{conv_dirs}/sequence", f"{conv_dirs}/mortality",
                               n_train=14, n_valid=6, n_features=2, batch_size=2, id_pattern=PAT)
    assert out["predictions"].count() == 6
    auc = out["auc"].head().auc
    assert auc is None or 0.0 <= auc <= 1.0
    run = out["running_auc"].orderBy("batch_id").collect()
    assert [r.batch_id for r in run] == [0, 1, 2]
    out = W.classify_sequences(spark, f"{conv_dirs}/sequence", f"{conv_dirs}/mortality",
                               n_train=14, n_valid=6, n_features=2, batch_size=2, id_pattern=PAT, rates=[0.5, 0.9])
    assert out["predictions"].where("score between 0 and 1").count() == 6


def test_multitask_sequences(spark, conv_dirs):
    out = W.multitask_sequences(spark, f"{conv_dirs}/sequence",
                                {"y1": f"{conv_dirs}/y1", "y2": f"{conv_dirs}/y2"},
                                n_train=14, n_valid=6, n_features=2, first_id=0, id_pattern=PAT)
    got = {r.target: r.auc for r in out["auc"].collect()}
    assert set(got) == {"y1", "y2"}
    assert all(v is None or 0.0 <= v <= 1.0 for v in got.values())


def test_forecast_grid(spark):
    base = tempfile.mkdtemp(prefix="seqlab-wf-grid-")
    g = daily_grid(spark, SF)[0].select(F.col("user_id").alias("sample_id"), F.col("day").alias("step"),
                                     *[F.col(f"c{i}") for i in range(5)])
    _per_sample_files(g.where("step < 20"), f"{base}/features")
    nxt = g.where("step >= 1 AND step <= 20").select("sample_id", (F.col("step") - 1).alias("step"),
                                                      *[F.col(f"c{i}").alias(f"y_c{i}") for i in range(5)])
    _per_sample_files(nxt, f"{base}/targets")
    fut = g.where("step >= 20").select("sample_id", (F.col("step") - 20).alias("step"), *[f"c{i}" for i in range(5)])
    _per_sample_files(fut, f"{base}/futures")
    out = W.forecast_grid(spark, f"{base}/features", f"{base}/targets", f"{base}/futures",
                          n_train=10, n_valid=5, n_cells=5, warmup=20, horizon=10, first_id=0, id_pattern=PAT)
    assert out["forecast"].count() == 5 * 10 * 5
    m = out["metrics"].collect()
    assert len(m) == 5 and all(r.n == 50 and r.mse >= 0 for r in m)


def test_fused_classifier(spark):
    readers = io_queries.zip_reader_csvs(spark, SF)
    out = W.fused_classifier(spark, readers, readers, max_iter=10)
    assert out["predictions"].count() == S.table(spark, SF, "events").count()
    assert 0.0 <= out["auc"].head().auc <= 1.0


def test_vectors_classify_and_rank(spark):
    vec = A.scan_vectors(spark, f"{SF}/embeddings.parquet", "vec_id", "embedding", "label")
    vec = splits.hash_split(vec, "id", 80)
    out = W.classify_vectors(spark, vec.where("split = 'train'"), vec.where("split = 'test'"), 10)
    n_test = vec.where("split = 'test'").count()
    assert out["confusion"].agg(F.sum("n")).head()[0] == n_test
    assert out["auc_one_vs_all"].count() == 10
    assert 0.0 <= out["metrics"].head().accuracy <= 1.0
    ranked = W.rank_anomalies(spark, vec, k=10, n=5)["best_worst"]
    per = {(r.label, r.kind): r["count"] for r in ranked.groupBy("label", "kind").count().collect()}
    assert all(v <= 5 for v in per.values()) and len(per) == 20
