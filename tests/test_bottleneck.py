"""Range-finder bottleneck and two-ended ranking."""

import random

import numpy as np
import pytest

from seqlab.operators import ranking
from seqlab.operators.bottleneck import bottleneck_errors, principal_directions


def vectors(spark, x, parts=6):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>").repartition(parts)


def test_subspace_equals_that_of_pca(spark):
    # a nearly flat spectrum: the worst case of a range finder
    x = np.random.default_rng(1).normal(size=(400, 64)) + 3.0
    mean, comps, variances = principal_directions(vectors(spark, x), "x", 10)
    xc = x - x.mean(axis=0)
    sizes, right = np.linalg.svd(xc, full_matrices=False)[1:]
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(variances, sizes[:10] ** 2 / 399)
    assert np.abs(comps @ comps.T - right[:10].T @ right[:10]).max() < 1e-6
    got = bottleneck_errors(vectors(spark, x), "x", mean, comps).collect()
    want = ((xc - xc @ right[:10].T @ right[:10]) ** 2).mean(axis=1)
    assert [r.score for r in sorted(got, key=lambda r: r.id)] == pytest.approx(want.tolist(), abs=1e-9)


def test_tasks_without_rows(spark):
    # splits that hold no row group: one file cut into many splits
    x = np.random.default_rng(4).normal(size=(300, 8))
    conf = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        mean, comps, variances = principal_directions(vectors(spark, x, 1), "x", 3)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(variances, sizes[:3] ** 2 / 299)


def test_four_thousand_cells(spark):
    rng = np.random.default_rng(2)
    true = np.linalg.qr(rng.normal(size=(4096, 5)))[0]
    x = rng.normal(size=(160, 5)) * [9, 7, 5, 4, 3] @ true.T + 0.001 * rng.normal(size=(160, 4096))
    _, comps, variances = principal_directions(vectors(spark, x), "x", 5, width=8, rounds=3)
    assert comps.shape == (4096, 5)
    assert np.linalg.norm(comps - true @ (true.T @ comps)) < 0.01


def test_awkward_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, None), (4, [1.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [5.0, 2.0])]
    df = spark.createDataFrame(rows, "id bigint, x array<double>").coalesce(1)
    mean, comps, variances = principal_directions(df, "x", 2)
    assert mean.tolist() == [3.0, 2.0] and comps.shape == (2, 1) and abs(comps[0, 0]) == pytest.approx(1)
    got = {r.id: r.score for r in bottleneck_errors(df, "x", mean, comps).collect()}
    assert got[3] is None and got[4] is None and got[1] == pytest.approx(0)
    empty = spark.createDataFrame([], "id bigint, x array<double>")
    assert [a.size for a in principal_directions(empty, "x", 2)] == [0, 0, 0]


@pytest.mark.parametrize("score,tie", [("double", "bigint"), ("int", "int"), ("decimal(9,2)", "double"), ("double", "string")])
def test_both_ends_equal_two_rankings(spark, score, tie):
    rng = random.Random(score + tie)
    nan = float("nan")
    pool = [None, -2, 0, 1, 1, 7] + ([nan, float("inf"), -float("inf"), -0.5] if score == "double" else [])
    ties = [None, -2 ** 63, 2 ** 63 - 1, 5] if tie == "bigint" else [None, -7, 3, 5]
    rows = [(rng.choice(["a", "b", None]), rng.choice(pool), rng.choice(ties), i) for i in range(200)] + [("one", 3, 3, 999)]
    df = spark.createDataFrame([(a, None if b is None else str(b), None if c is None else str(c), i) for a, b, c, i in rows],
                               "label string, s string, t string, i int")
    df = df.selectExpr("label", f"cast(s as {score}) as s", f"cast(t as {tie}) as t").repartition(3)
    got = ranking.best_worst(df, "label", "s", "t", 4)
    want = ranking._best_worst_branches(df, "label", "s", "t", 4)
    key = lambda df: sorted(map(repr, df.select("label", "kind", "pos", "s", "t").collect()))
    assert key(got) == key(want) and len(key(got)) == 3 * 8 + 2


def test_one_exchange_with_a_limit_before_it(spark):
    df = spark.range(1000).selectExpr("id % 3 as label", "id * 1.0D as s", "id as t")
    plan = ranking.best_worst(df, "label", "s", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2 and plan.count("Range (") == 1
