import hashlib
import math

import numpy as np
import pytest

from seqlab.llm import clustering as C

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, cluster string"


def brute(rows, k, rounds, dims, scale=256):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)))
        return out
    for _ in range(rounds):
        where = assign() if kept else []
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, w) in zip(kept, where) if w == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    where = assign() if kept else []
    return sorted(((i, w, d) for (i, _), (d, w) in zip(kept, where)), key=repr), centroids


def found(spark, rows, k, rounds, dims, **options):
    df = spark.createDataFrame([(i, v, 1, "x", None, "c") for i, v in rows], SCHEMA)
    out, centroids = C.centroid_clusters(df, k=k, rounds=rounds, dims=dims, **options)
    got = sorted(map(tuple, out.collect()), key=repr)
    for c in centroids:
        assert c["inertia"] == sum(d for _, w, d in got if w == c["cluster"])
    return got, [c["vector"] for c in centroids]


def clusters(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims)) * 3
    return [(i, [float(x) for x in (centres[rng.integers(9)] + rng.normal(size=dims) * spread).astype(np.float32)])
            for i in range(n)]


@pytest.mark.parametrize("dims,spread,pivots", [(3, 0.3, 16), (12, 1.0, 4), (64, 0.2, 40), (5, 0.0, 2), (4, 0.5, 1)])
def test_equals_brute_force(spark, dims, spread, pivots):
    rows = clusters(dims, 260, dims, spread)
    assert found(spark, rows, 12, 5, dims, pivots=pivots) == brute(rows, 12, 5, dims)


def test_ties_copies_and_empty_clusters(spark):
    # all corners of a small grid, many times: equal distances everywhere, copies among the first centroids
    rows = [(i, [float(i % 2), float(i // 2 % 2), float(i // 4 % 2)]) for i in range(160)]
    assert found(spark, rows, 20, 5, 3) == brute(rows, 20, 5, 3)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 0.0, 0.0]),
            (7, [0.5, -0.5, 0.0]), (7, [0.5, -0.5, 0.0]), (7, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, -0.0]), (None, None),
            (8, [-1e5, 5e5, 0.001]), (9, [-0.001, -0.001, -0.001])]
    assert found(spark, rows, 40, 5, 3) == brute(rows, 40, 5, 3)
    # too large for 64-bit squares: left out, like those that are not finite
    assert found(spark, [*rows, (10, [3e38, 0.0, 0.0])], 40, 5, 3) == brute(rows, 40, 5, 3)


def test_empty_table(spark):
    assert found(spark, [], 40, 5, 3) == ([], [])
    assert found(spark, [(1, [1.0])], 40, 5, 3) == ([], [])


def test_bounds_hold_and_drop_most_centroids():
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, size=(40, 64))
    vectors = centres[rng.integers(40, size=2000)] + rng.integers(-60, 60, size=(2000, 64))
    simplex = C.Simplex(centres)
    a, c = simplex.apex(vectors), simplex.apex(centres)
    true = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    near = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    slack = C.SLACK * true.max()
    assert (near + (a[:, None, -1] - c[None, :, -1]) ** 2 <= true + slack).all()
    assert (near + (a[:, None, -1] + c[None, :, -1]) ** 2 >= true - slack).all()
    number, squared, compared = C.nearest(vectors, a, centres, c)
    assert (number == true.argmin(axis=1)).all() and (squared == true.min(axis=1)).all()
    assert compared < 0.6 * true.size
