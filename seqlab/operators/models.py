"""Model tasks as Spark ML jobs.

The reference trains neural networks with a tensor library; here each task
is re-aimed at a distributed Spark ML estimator (a documented substitution,
not an equivalent network). Fitting aggregates gradients or Gram matrices
over all partitions; the driver holds only coefficients (bounded by the
feature count) and the objective history.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.operators.ordering import ordered_sums


def as_vector(df: DataFrame, features, out: str = "features_vec") -> DataFrame:
    """Add an ML vector column from a list of numeric columns or one array column."""
    if isinstance(features, (list, tuple)):
        return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)
    return df.withColumn(out, array_to_vector(F.col(features)))


# ------------------------------------------------------------------ I1 ----
def fit_vector_classifier(df: DataFrame, features: str, label: str, num_classes: int,
                          hidden: int | None = 32, seed: int = 123, max_iter: int = 20,
                          reg: float = 1e-4):
    """Multi-class classifier on an array column: an MLP (``hidden`` units,
    sigmoid hidden layer, softmax output, L-BFGS) or, with ``hidden=None``,
    multinomial logistic regression with L2 ``reg``."""
    data = as_vector(df, features)
    d = data.select(F.size(F.col(features)).alias("d")).head()[0] if not isinstance(features, list) \
        else len(features)
    if hidden:
        est = MultilayerPerceptronClassifier(featuresCol="features_vec", labelCol=label,
                                             layers=[int(d), int(hidden), int(num_classes)],
                                             seed=seed, maxIter=max_iter)
    else:
        est = LogisticRegression(featuresCol="features_vec", labelCol=label, family="multinomial",
                                 regParam=reg, maxIter=max_iter)
    return est.fit(data.withColumn(label, F.col(label).cast("double")))


def predict_classes(model, df: DataFrame, features) -> DataFrame:
    """J1 for classifiers: adds ``yhat`` (int) and ``p1`` (probability of class 1)."""
    out = model.transform(as_vector(df, features))
    return out.withColumn("yhat", F.col("prediction").cast("int")) \
        .withColumn("p1", vector_to_array("probability")[1])


# ------------------------------------------------------------------ I2 ----
def fit_fused_classifier(df: DataFrame, feature_cols: list[str], label: str, hidden: int = 50,
                         seed: int = 123, max_iter: int = 20):
    """Several aligned inputs merged into one vector, 2-class MLP."""
    data = as_vector(df, feature_cols)
    est = MultilayerPerceptronClassifier(featuresCol="features_vec", labelCol=label,
                                         layers=[len(feature_cols), int(hidden), 2],
                                         seed=seed, maxIter=max_iter)
    return est.fit(data.withColumn(label, F.col(label).cast("double")))


# ------------------------------------------------------------------ I3 ----
def sequence_features(df: DataFrame, id_col: str, step: str, value_cols: list[str]) -> DataFrame:
    """Per-sequence summary features: length, and mean / min / max / last of
    each value column (partial+final aggregates; ``max_by`` picks the last)."""
    aggs = [F.count(F.lit(1)).cast("double").alias("len")]
    for c in value_cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
                 F.max_by(c, step).alias(f"{c}_last")]
    return df.groupBy(id_col).agg(*aggs)


def fit_sequence_classifier(seq_features: DataFrame, label: str, feature_cols: list[str],
                            reg: float = 1e-4, max_iter: int = 50):
    data = as_vector(seq_features, feature_cols)
    return LogisticRegression(featuresCol="features_vec", labelCol=label, regParam=reg,
                              maxIter=max_iter).fit(data.withColumn(label, F.col(label).cast("double")))


# ------------------------------------------------------------------ I4 ----
def trailing_features(df: DataFrame, id_col: str, step: str, values: list[str]) -> DataFrame:
    """Per-step features over the trailing frame (all steps up to the current
    one): running mean ``<c>_mean`` and running RMS ``<c>_rms`` of every column
    in ``values``, and the step index ``step_f``. The running sums of all columns
    come from one ordered prefix, so a very long sequence is split over many
    tasks."""
    zero = F.lit(0.0)
    cell = [F.coalesce(F.nanvl(F.col(c).cast("double"), zero), zero) for c in values]
    m = len(values)
    out = ordered_sums(df, [id_col], [step], F.array(F.lit(1.0), *cell, *[c * c for c in cell]), "__before")
    n = F.col("__before")[0] + 1
    return out.select(
        *df.columns,
        *[((F.col("__before")[1 + i] + cell[i]) / n).alias(f"{c}_mean") for i, c in enumerate(values)],
        *[F.sqrt((F.col("__before")[1 + m + i] + cell[i] * cell[i]) / n).alias(f"{c}_rms")
          for i, c in enumerate(values)],
        F.col(step).cast("double").alias("step_f"))


def fit_multitask(features: DataFrame, feature_cols: list[str], targets: list[str],
                  reg: float = 1e-4, max_iter: int = 50) -> dict:
    """One logistic regression per target over shared (cached) features."""
    data = as_vector(features, feature_cols).persist()
    try:
        models = {t: LogisticRegression(featuresCol="features_vec", labelCol=t, regParam=reg,
                                        maxIter=max_iter, predictionCol=f"{t}_pred",
                                        probabilityCol=f"{t}_prob", rawPredictionCol=f"{t}_raw")
                  .fit(data.withColumn(t, F.col(t).cast("double"))) for t in targets}
    finally:
        data.unpersist()
    return models


# ------------------------------------------------------------------ I5 ----
def fit_reconstruction(df: DataFrame, features: str, k: int = 10):
    """Linear bottleneck: centre, then PCA with ``k`` components (distributed
    covariance; the d x d eigen-problem is solved on the driver)."""
    data = as_vector(df, features)
    scaler = StandardScaler(inputCol="features_vec", outputCol="centered", withMean=True,
                            withStd=False).fit(data)
    pca = PCA(k=int(k), inputCol="centered", outputCol="code").fit(scaler.transform(data))
    return scaler, pca


def reconstruction_errors(models, df: DataFrame, features: str, name: str = "score") -> DataFrame:
    """Mean squared reconstruction error per row. With orthonormal components
    ``||x_c - P P' x_c||^2 = ||x_c||^2 - ||P' x_c||^2``, so no d-vector needs to
    be rebuilt."""
    scaler, pca = models
    out = pca.transform(scaler.transform(as_vector(df, features)))
    xc = vector_to_array("centered")
    z = vector_to_array("code")
    sq = lambda a: F.aggregate(F.transform(a, lambda v: v * v), F.lit(0.0), lambda s, v: s + v)
    err = F.greatest(sq(xc) - sq(z), F.lit(0.0)) / F.size(xc)
    return out.withColumn(name, err)


# ------------------------------------------------------------------ I6 ----
def lagged_pairs(df: DataFrame, id_col: str, step: str, cells: list[str]) -> DataFrame:
    """(x at step t, y at step t+1) per id through an equi-join on (id, step+1)."""
    nxt = df.select(F.col(id_col), (F.col(step) - 1).alias(step),
                    *[F.col(c).alias(f"y_{c}") for c in cells])
    return df.join(nxt, [id_col, step], "inner")


def gram_means(pairs: DataFrame, cells: list[str]) -> DataFrame:
    """Mean X'X and X'Y entries (X = cells + 1 bias, Y = next-step cells) as
    (kind, i, j, value) rows. Each task sums its Arrow blocks with one matrix
    product per block and emits its sums once; Spark adds the tasks up. Of X'X
    only the upper triangle is summed."""
    d = len(cells)

    def partial(batches):
        xx, xy, n = np.zeros((d + 1, d + 1)), np.zeros((d + 1, d)), 0
        for pdf in batches:
            x = np.column_stack([pdf.iloc[:, :d].to_numpy(dtype="float64"), np.ones(len(pdf))])
            y = pdf.iloc[:, d:].to_numpy(dtype="float64")
            xx, xy, n = xx + x.T @ x, xy + x.T @ y, n + len(pdf)
        if n:
            i, j = np.triu_indices(d + 1)
            k, m = np.indices((d + 1, d))
            yield pd.DataFrame({"kind": ["xx"] * len(i) + ["xy"] * k.size, "i": np.concatenate([i, k.ravel()]),
                                "j": np.concatenate([j, m.ravel()]), "s": np.concatenate([xx[i, j], xy.ravel()]),
                                "n": n})

    wide = pairs.select(*[F.col(c).cast("double") for c in cells], *[F.col(f"y_{c}").cast("double") for c in cells])
    parts = wide.where(" AND ".join(f"`{c}` IS NOT NULL" for c in wide.columns)).mapInPandas(
        partial, "kind string, i int, j int, s double, n long")
    mean = parts.groupBy("kind", "i", "j").agg((F.sum("s") / F.sum("n")).alias("value"))
    # the lower triangle of X'X mirrors the upper one
    both = F.when((F.col("kind") == "xx") & (F.col("i") != F.col("j")),
                  F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return mean.select("kind", "value", F.explode(F.coalesce(both, F.array(F.struct("i", "j")))).alias("c")).select(
        "kind", "c.i", "c.j", "value")


def fit_forecaster(pairs: DataFrame, cells: list[str], ridge: float = 1e-3):
    """Next-step linear forecaster for all cells at once: ridge solution of
    the (d+1) x (d+1) normal equations built from distributed Gram means.
    Returns (W, b) with y_next = W @ x + b."""
    g = gram_means(pairs, cells).collect()  # (d+1)^2 + (d+1)*d numbers
    d = len(cells)
    xx = np.zeros((d + 1, d + 1))
    xy = np.zeros((d + 1, d))
    for r in g:
        (xx if r["kind"] == "xx" else xy)[r["i"], r["j"]] = r["value"]
    reg = np.eye(d + 1) * float(ridge)
    reg[d, d] = 0.0
    beta = np.linalg.solve(xx + reg, xy)  # (d+1) x d
    return beta[:d].T, beta[d]


# ------------------------------------------------------------------ I7 ----
def score_history(model, every: int = 1) -> list[tuple[int, float]]:
    """Objective value every ``every`` iterations (bounded by maxIter)."""
    summary = model.summary
    hist = list(summary.objectiveHistory)
    return [(i, float(v)) for i, v in enumerate(hist) if i % int(every) == 0]
