"""Fitted models replayed from their exported coefficients with numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from seqlab.operators import models as M
from seqlab.plans import model_queries as Q

SF = "/root/testdata/sf0.001"


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def run(spark, name):
    return E.queries()[name](spark, SF)


def test_logistic_regression_values(spark):
    data = Q._labelled_vectors(spark, SF)
    train, test = Q._held_out(data, "id")
    model = M.fit_vector_classifier(train, "x", "y", 10, hidden=None, max_iter=40)
    rows = sorted(test.collect(), key=lambda r: r.id)
    p = softmax(np.array([r.x for r in rows]) @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray())
    got = sorted(run(spark, "vector_classifier_scores").collect(), key=lambda r: r.id)
    assert [r.id for r in got] == [r.id for r in rows] and len(rows) > 50
    assert [r.yhat for r in got] == p.argmax(axis=1).tolist()
    assert [r.p for r in got] == pytest.approx(p.max(axis=1).tolist(), abs=1e-6)
    y = np.array([r.y for r in rows])
    assert [r.loss for r in got] == pytest.approx((-np.log(p[np.arange(len(y)), y])).tolist(), abs=1e-5)
    report = {r.metric: r.value for r in run(spark, "vector_classifier_report").collect()}
    assert report["accuracy"] == pytest.approx((p.argmax(axis=1) == y).mean())
    for c in range(10):
        a, b = p[y == c, c], p[y != c, c]
        if len(a):
            assert report[f"auc_{c}"] == pytest.approx(((a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean()), abs=1e-6)


def test_network_values(spark):
    got = run(spark, "fused_classifier_scores")
    z = Q.q_positional_zip(spark, SF).withColumnRenamed("label", "y")
    feats = [f"f{i}" for i in range(1, 16)]
    train, test = Q._held_out(z, "row_no")
    model = M.fit_fused_classifier(train, feats, "y", hidden=8, seed=123, max_iter=40)
    w = model.weights.toArray()
    one, b1 = w[:120].reshape(15, 8).T, w[120:128]
    two, b2 = w[128:144].reshape(8, 2).T, w[144:146]
    scored = M.predict_classes(model, test, feats)
    rows = scored.select("row_no", "p1", "yhat", F.array(*[F.col(f) for f in feats]).alias("x")).collect()
    hidden = 1 / (1 + np.exp(-(np.array([r.x for r in rows]) @ one.T + b1)))
    p = softmax(hidden @ two.T + b2)[:, 1]
    assert [r.p1 for r in rows] == pytest.approx(p.tolist(), abs=1e-9)
    assert [r.yhat for r in rows] == (p > 0.5).astype(int).tolist()
    assert {r.row_no for r in got.collect()} == {r.row_no for r in rows}
    assert got.where("p1 < 0 or p1 > 1 or loss < 0").count() == 0


def test_multitask_values(spark):
    rows = run(spark, "multitask_scores").collect()
    auc = {r.target: r for r in run(spark, "multitask_auc").collect()}
    for target in ("y1", "y2"):
        y = np.array([r.y for r in rows if r.target == target])
        p = np.array([r.p1 for r in rows if r.target == target])
        a, b = p[y == 1], p[y == 0]
        want = (a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean() if len(a) and len(b) else None
        assert auc[target].auc == pytest.approx(want, abs=1e-6)
        assert (auc[target].n_pos, auc[target].n_neg) == (len(a), len(b))
    # what comes next cannot be read off the step itself: the targets follow the turns
    steps = {(r.seq_id, r.step): r for r in Q._next_turns(spark, SF).collect()}
    for (s, t), r in steps.items():
        follows = steps.get((s, t + 1))
        assert r.y2 == (follows is None) and r.y1 == (follows.assistant if follows else 0)


def test_reconstruction_values(spark):
    rows = run(spark, "reconstruction_errors").collect()
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in sorted(emb, key=lambda r: r.vec_id)], np.float64)
    xc = x - x.mean(axis=0)
    v = np.linalg.svd(xc, full_matrices=False)[2][:10]
    error = ((xc - xc @ v.T @ v) ** 2).mean(axis=1)
    rows = sorted(rows, key=lambda r: r.id)
    assert [r.score for r in rows] == pytest.approx(error.tolist(), abs=1e-9)
    assert [r.around_mean for r in rows] == pytest.approx((xc ** 2).mean(axis=1).tolist(), abs=1e-9)


def test_forecaster_values(spark):
    grid, cells, days = Q.daily_grid(spark, SF)
    warm = Q.warm_days(days)
    data = {}
    for r in grid.collect():
        data.setdefault(r.user_id, {})[r.day] = [r[c] for c in cells]
    x = np.array([[d[t] for t in range(days)] for _, d in sorted(data.items())])
    a = np.concatenate([x[:, :warm - 1].reshape(-1, len(cells)), np.ones((len(x) * (warm - 1), 1))], axis=1)
    b = x[:, 1:warm].reshape(-1, len(cells))
    reg = np.eye(len(cells) + 1) * 1e-3
    reg[-1, -1] = 0
    beta = np.linalg.solve(a.T @ a / len(a) + reg, a.T @ b / len(a))
    y, out = x[:, warm - 1], []
    for _ in range(days - warm + 1):
        y = y @ beta[:-1] + beta[-1]
        out.append(y)
    error = (np.stack(out[1:], axis=1) - x[:, warm:]) ** 2
    got = {r.cell: r for r in run(spark, "forecaster_errors").collect()}
    for c in range(len(cells)):
        assert got[c].mse == pytest.approx(error[:, :, c].mean(), rel=1e-5)


def test_loss_history(spark):
    loss = [r.loss for r in sorted(run(spark, "loss_history").collect(), key=lambda r: r.iteration)]
    assert 2 < len(loss) <= 21 and all(b <= a + 1e-12 for a, b in zip(loss, loss[1:]))
    data = Q._labelled_vectors(spark, SF)
    model = M.fit_vector_classifier(data, "x", "y", 10, hidden=None, max_iter=20)
    rows = data.collect()
    p = softmax(np.array([r.x for r in rows]) @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray())
    y = np.array([r.y for r in rows])
    mean = -np.log(p[np.arange(len(y)), y]).mean()
    assert mean <= loss[-1] <= mean + 0.1        # the objective adds the penalty


def test_recurrent_classifier(spark):
    rows = run(spark, "train_recurrent_classifier").collect()
    held = {r.seq_id for r in Q._held_out(spark.read.parquet(f"{SF}/conversations.parquet").select(
        F.col("conv_id").alias("seq_id")).distinct(), "seq_id")[1].collect()}
    assert {r.seq_id for r in rows} == held and all(0 <= r.p1 <= 1 and r.yhat == (r.p1 > 0.5) for r in rows)
