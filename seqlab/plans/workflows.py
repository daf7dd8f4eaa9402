"""End-to-end tasks of the reference, composed from the operators.

Each function takes paths laid out as the reference's readers expect (CSV
files, one numbered file per sample, aligned reader files, vector tables)
and returns DataFrames: prepared sequences, predictions and metric tables.
Nothing is collected except model coefficients inside the fits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.functions.columns import epoch_millis, parse_time_ntz
from seqlab.operators import evaluation as K
from seqlab.operators import models as M
from seqlab.operators import ranking, scoring, splits
from seqlab.operators.align import positional_zip
from seqlab.operators.recurrence import decayed_features, last_states
from seqlab.operators.sequences import sequence_stats
from seqlab.plans.trajectories import hourly_trajectories
from seqlab.sources import readers as A

TS_TEXT = "dd/MM/yyyy HH:mm:ss"


# ------------------------------------------------------------ vessels ----
def examine_positions(spark: SparkSession, csv_path: str) -> DataFrame:
    """Header CSV with inferred types -> per-vessel positions, first / last
    time and span (epoch ms). A1 B1 C3 E2."""
    raw = A.scan_csv(spark, csv_path)
    pos = raw.select(F.col("MMSI").cast("string").alias("mmsi"),
                     parse_time_ntz(F.col("`# Timestamp`"), TS_TEXT).alias("ts"),
                     F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    return sequence_stats(pos.select("mmsi", epoch_millis("ts").alias("t")), "mmsi", "t")


def prepare_trajectories(spark: SparkSession, csv_path: str, train_pct: int = 80,
                         more_than: int = 7, geo_mode: str = "reference") -> tuple[DataFrame, DataFrame]:
    """Raw 23-column text -> hourly geo-averaged trajectories longer than
    ``more_than`` windows -> deterministic train / test split by vessel.
    A2 B1 B3 B4 C1-C5 E1 E3-E5 G1."""
    raw = A.scan_csv(spark, csv_path, schema=A.VESSEL_SCHEMA, skip_prefix="# Timestamp")
    pos = raw.select(F.col("MMSI").alias("mmsi"), parse_time_ntz("Timestamp", TS_TEXT).alias("ts"),
                     F.col("Lat").alias("lat"), F.col("Lon").alias("lon"))
    traj = splits.hash_split(hourly_trajectories(pos, geo_mode=geo_mode, more_than=more_than),
                             "mmsi", train_pct)
    return (traj.where(F.col("split") == "train").drop("split"),
            traj.where(F.col("split") == "test").drop("split"))


def save_trajectories(train: DataFrame, test: DataFrame, cache_dir: str) -> tuple[str, str]:
    """Write both sets unless already present."""
    tr, te = f"{cache_dir.rstrip('/')}/train", f"{cache_dir.rstrip('/')}/test"
    A.save_sequences(train, tr, "mmsi", "step")
    A.save_sequences(test, te, "mmsi", "step")
    return tr, te


# -------------------------------------------- numbered sequence files ----
def _numbered(spark, path, lo, hi, columns, skip, id_pattern):
    return A.scan_numbered_sequences(spark, path, lo, hi, columns, skip=skip, id_pattern=id_pattern)


def classify_sequences(spark: SparkSession, features_dir: str, labels_dir: str, n_train: int,
                       n_valid: int, n_features: int, batch_size: int = 32, first_id: int = 0,
                       id_pattern: str = r"(\d+)\.csv$", rates: list[float] | None = None) -> dict[str, DataFrame]:
    """Sequence -> one binary label per sequence (label file: one line, no
    header, aligned to the end). Summary features (with ``rates`` also the
    recurrent state of each feature at the last step) + logistic regression;
    thresholded AUC (100 steps) of the validation set, and the running AUC
    after each validation batch. A3 B6 D2 G3 I3 J1 K4 K6."""
    cols = [f"f{i}" for i in range(n_features)]
    lo, mid, hi = first_id, first_id + n_train - 1, first_id + n_train + n_valid - 1
    feats = _numbered(spark, features_dir, lo, hi, cols, 1, id_pattern)
    labels = _numbered(spark, labels_dir, lo, hi, ["label"], 0, id_pattern)
    # a one-line label file lands on the last step (ALIGN_END): one label per sample
    lab = labels.groupBy("sample_id").agg(F.max_by("label", "step").cast("int").alias("label"))
    seq = M.sequence_features(feats, "sample_id", "step", cols).join(lab, "sample_id")
    if rates:
        states = decayed_features(feats, "sample_id", "step", cols, rates)
        names = [c for c in states.columns if c not in feats.columns]
        seq = seq.join(last_states(states, "sample_id", "step", names).drop("len"), "sample_id")
    fcols = [c for c in seq.columns if c not in ("sample_id", "label")]
    model = M.fit_sequence_classifier(seq.where(F.col("sample_id") <= mid), "label", fcols)
    pred = M.predict_classes(model, seq.where(F.col("sample_id") > mid), fcols) \
        .select("sample_id", F.col("label").alias("y"), F.col("p1").alias("score"),
                F.floor((F.col("sample_id") - (mid + 1)) / batch_size).cast("long").alias("batch_id"))
    return {"predictions": pred, "auc": K.auc_thresholded(pred), "running_auc": K.running_auc(pred)}


def multitask_sequences(spark: SparkSession, features_dir: str, target_dirs: dict[str, str],
                        n_train: int, n_valid: int, n_features: int, first_id: int = 1,
                        id_pattern: str = r"(\d+)\.csv$") -> dict[str, DataFrame]:
    """Per-step features with one binary target per step in each target
    folder; trailing-frame features, one classifier per target, exact AUC of
    every target on the validation ids. A3 B6 D2 I4 J1 K3 K7."""
    cols = [f"f{i}" for i in range(n_features)]
    lo, mid, hi = first_id, first_id + n_train - 1, first_id + n_train + n_valid - 1
    data = _numbered(spark, features_dir, lo, hi, cols, 1, id_pattern)
    for t, d in target_dirs.items():
        data = data.join(_numbered(spark, d, lo, hi, [t], 1, id_pattern), ["sample_id", "step"])
    feats = M.trailing_features(data, "sample_id", "step", cols)
    fcols = cols + [f"{c}_{k}" for c in cols for k in ("mean", "rms")] + ["step_f"]
    models = M.fit_multitask(feats.where(F.col("sample_id") <= mid), fcols, list(target_dirs))
    valid = feats.where(F.col("sample_id") > mid)
    longs = []
    for t, m in models.items():
        p = m.transform(M.as_vector(valid, fcols))
        longs.append(p.select(F.lit(t).alias("target"), F.col(t).cast("int").alias("y"),
                              F.element_at(_v2a(f"{t}_prob"), 2).alias("score")))
    scored = longs[0]
    for other in longs[1:]:
        scored = scored.unionByName(other)
    return {"auc": K.auc_exact(scored, "y", "score", by=["target"])}


def _v2a(col):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(col)


def forecast_grid(spark: SparkSession, features_dir: str, targets_dir: str, futures_dir: str,
                  n_train: int, n_valid: int, n_cells: int, warmup: int = 50, horizon: int = 10,
                  offset: int = 1, first_id: int = 1,
                  id_pattern: str = r"(\d+)\.csv$") -> dict[str, DataFrame]:
    """Grid sequences -> next-step linear forecaster (targets are the next
    step) -> warm-up on each validation sequence and autoregressive rollout
    -> regression metrics per cell against the future steps.
    A3 B6 D2 D4 C9 I6 J3 K8."""
    cells = [f"c{i}" for i in range(n_cells)]
    ycells = [f"y_c{i}" for i in range(n_cells)]
    lo, mid, hi = first_id, first_id + n_train - 1, first_id + n_train + n_valid - 1
    x = _numbered(spark, features_dir, lo, mid, cells, 1, id_pattern)
    y = _numbered(spark, targets_dir, lo, mid, ycells, 1, id_pattern)
    W, b = M.fit_forecaster(x.join(y, ["sample_id", "step"]), cells)
    warm = _numbered(spark, features_dir, mid + 1, hi, cells, 1, id_pattern)
    fc = scoring.rollout(warm, "sample_id", "step", cells, scoring.linear_step(W, b),
                         horizon=horizon, offset=offset, start=0, length=warmup)
    fut = _numbered(spark, futures_dir, mid + 1, hi, cells, 1, id_pattern).where(F.col("step") < horizon)
    truth = fut.select("sample_id", F.col("step").alias("k"),
                       F.posexplode(F.array(*[F.col(c) for c in cells])).alias("cell", "truth"))
    return {"forecast": fc,
            "metrics": K.regression_metrics(fc.join(truth, ["sample_id", "k", "cell"]), "cell", "truth",
                                            "prediction")}


# ---------------------------------------------------- aligned readers ----
def fused_classifier(spark: SparkSession, train_readers: list[tuple[str, list[str]]],
                     test_readers: list[tuple[str, list[str]]], label: str = "label",
                     hidden: int = 50, max_iter: int = 20) -> dict[str, DataFrame]:
    """Several aligned CSV readers (row i of every reader is one sample),
    merged features, 2-class MLP, thresholded AUC on the test readers.
    A4 B2 C7 D1 I2 J1 K4."""
    def load(readers):
        return positional_zip([A.scan_rows_numbered(spark, p, cols, skip=1) for p, cols in readers])
    train, test = load(train_readers), load(test_readers)
    feats = [c for c in train.columns if c not in ("row_no", label)]
    model = M.fit_fused_classifier(train.withColumn(label, F.col(label).cast("int")), feats, label,
                                   hidden=hidden, max_iter=max_iter)
    pred = M.predict_classes(model, test, feats).select(
        "row_no", F.col(label).cast("int").alias("y"), F.col("p1").alias("score"))
    return {"predictions": pred, "auc": K.auc_thresholded(pred)}


# ------------------------------------------------------------ vectors ----
def classify_vectors(spark: SparkSession, train: DataFrame, test: DataFrame, num_classes: int,
                     hidden: int | None = None, max_iter: int = 20) -> dict[str, DataFrame]:
    """(id, features array, label) -> multi-class classifier -> confusion,
    accuracy / macro precision / recall / F1, one-vs-all AUC. A5 I1 J1 K1 K2 K5 I7."""
    model = M.fit_vector_classifier(train, "features", "label", num_classes, hidden=hidden,
                                    max_iter=max_iter)
    pred = model.transform(M.as_vector(test, "features")).select(
        "id", F.col("label").alias("y"), F.col("prediction").cast("int").alias("yhat"),
        _v2a("probability").alias("scores"))
    return {"confusion": K.confusion(pred), "metrics": K.classification_metrics(pred),
            "auc_one_vs_all": K.auc_one_vs_all(pred, "y", "scores")}


def rank_anomalies(spark: SparkSession, vectors: DataFrame, k: int = 10, n: int = 5) -> dict[str, DataFrame]:
    """(id, features array, label) -> linear bottleneck (PCA k) -> reconstruction
    error per row -> best and worst ``n`` per label. A5 I5 J2 F2 F3."""
    models = M.fit_reconstruction(vectors, "features", k=k)
    scored = M.reconstruction_errors(models, vectors, "features").select("id", "label", "score")
    return {"scores": scored, "best_worst": ranking.best_worst(scored, "label", "score", "id", n=n)}
