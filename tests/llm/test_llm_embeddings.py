import math

import numpy as np
import pytest

from seqlab.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell string"


def brute(rows, similarity=E.SIMILARITY):
    units = []
    for _, v, label in rows:
        ok = label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        units.append(x / np.sqrt(x @ x) if ok else None)
    n = len(rows)
    link = [[i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= similarity
             for j in range(n)] for i in range(n)]
    low = [r[0] for r in rows]
    for _ in range(n):
        low = [min([low[i], *(low[j] for j in range(n) if link[i][j])]) for i in range(n)]
    return sorted((rows[i][0], sum(link[i]), low[i]) for i in range(n))


def found(spark, rows):
    df = spark.createDataFrame([(i, v, l, "x", None) for i, v, l in rows], SCHEMA)
    return sorted(map(tuple, E.link_embeddings(df).collect()))


def clusters(seed, n, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(8)] + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.6])
        rows.append((int(i), [float(x) for x in v.astype(np.float32)], int(rng.choice([1, 1, 1, 2]))))
    return rows


@pytest.mark.parametrize("cell,block", [(1024, 1024), (20, 16), (8, 1000)])
def test_equals_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(E, "CELL", cell)
    monkeypatch.setattr(E, "BLOCK", block)
    rows = clusters(cell, 220)
    assert found(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0, 2.0, 3.0]
    rows = [(1, a, 5), (2, [2.0, 4.0, 6.0], 5), (3, a, None), (4, None, 5), (5, [0.0, 0.0, 0.0], 5), (6, [1.0, nan, 0.0], 5),
            (7, [inf, 0.0, 0.0], 5), (8, [1.0, None, 0.0], 5), (9, a, 6), (10, a, 5), (10, a, 5), (11, [], 5),
            (12, [1.0, 2.0], 5), (13, [-0.0, 0.0, 1.0], 5), (14, [0.0, -0.0, 2.0], 5), (15, [3e38, 3e38, 3e38], 7)]
    assert found(spark, rows) == brute(rows)


def test_many_copies_are_one_node(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 10)
    rows = [(i, [1.0, 0.5], 1) for i in range(100)] + [(100 + i, [1.0, 0.5 + i / 100], 1) for i in range(30)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
