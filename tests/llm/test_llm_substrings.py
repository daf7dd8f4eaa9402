import random

import pytest
from pyspark.sql import functions as F

from llm_data import AWKWARD, docs
from seqlab.llm.common import id_ranges
from seqlab.llm.substrings import LENGTH, remove_repeats


def brute(rows):
    first = {}
    key = lambda i: (i is None, i or 0)
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        b = (t or "").encode()
        for k in range(len(b) - LENGTH + 1):
            first.setdefault(b[k:k + LENGTH], key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - LENGTH + 1):
            if first[b[k:k + LENGTH]] < key(i):
                gone[k:k + LENGTH] = [True] * LENGTH
        edges = [k for k in range(len(b) + 1) if (k < len(b) and gone[k]) != (k > 0 and gone[k - 1])]
        out.append((i, len(b), list(zip(edges[::2], edges[1::2])), bytes(c for c, g in zip(b, gone) if not g)))
    return out


def found(spark, rows, **options):
    return [(r["id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
            for r in remove_repeats(docs(spark, rows), **options).collect()]


@pytest.mark.parametrize("batch_bytes", [400, 5000, 1 << 20])
def test_equals_brute_force(spark, batch_bytes):
    rng = random.Random(batch_bytes)
    line = "".join(rng.choice("abcdef ") for _ in range(130))
    rows = []
    for i in range(60):
        parts = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(120))) for _ in range(3)]
        if rng.random() < 0.5:
            a = rng.randrange(80)
            parts.insert(rng.randrange(3), line[a:a + rng.randrange(45, 130)])
        if rng.random() < 0.3 and rows:
            parts.append(rng.choice(rows)[1])
        rows.append((rng.randrange(1000), "".join(parts)))
    rows += [(2000, "ab" * 100), (2001, "ab" * 60), (2002, "a" * 200), (2003, "a" * 49), (2004, "x" + "a" * 50)]
    assert sorted(found(spark, rows, batch_bytes=batch_bytes)) == sorted(brute(rows))


def test_awkward_rows(spark):
    rows = AWKWARD[:6] + [(8, "z" * 60), (8, "z" * 60), (None, "z" * 55), (None, "q" * 70), (9, "é" * 200), (5, "é" * 99)]
    rows = [r for r in rows if len(r[1] or "") < 1000]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(found(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_one_passage_in_every_document(spark):
    rng = random.Random(2)
    passage = "This passage stands in every single document of the corpus, word for word."
    rows = [(i, "".join(rng.choice("klmnopq") for _ in range(30)) + passage + str(i)) for i in range(100)]
    assert sorted(found(spark, rows, batch_bytes=600)) == sorted(brute(rows))


def test_empty_table(spark):
    assert found(spark, []) == []


def test_batches_follow_bytes_not_ids(spark):
    low, high = -(1 << 63), (1 << 63) - 2
    for ids in ([*range(200), 10 ** 15], [low, *range(200), high], [5] * 200, [1, 2, *[7] * 150, 8, 9]):
        rows = spark.createDataFrame([(i, "x" * 100) for i in ids], "id long, text string")
        ranged, divided = id_ranges(rows, F.octet_length("text"), 1000)
        got = ranged.groupBy("batch").agg(F.count("id").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
        got = sorted((r["batch"], r["n"], r["lo"], r["hi"]) for r in got.collect())
        assert max(n for _, n, _, _ in got) <= 20 and sum(n for _, n, _, _ in got) == len(ids)
        assert all(a[3] <= b[2] for a, b in zip(got, got[1:]))
        assert bool(divided) == (len(set(ids)) < len(ids))


@pytest.mark.parametrize("owner", [5, None])
def test_a_divided_id_is_one_document(spark, owner):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=80))
    ours, theirs = word(), word()
    rows = [(1, word() + theirs)] + [(owner, f"{i:04d}" + ours + word() + (theirs if i % 9 == 0 else ""))
                                     for i in range(60)] + [(9, ours + word())]
    assert sorted(found(spark, rows, batch_bytes=1000), key=str) == sorted(brute(rows), key=str)
