import random

import numpy as np
from pyspark.sql import functions as F

from llm_data import AWKWARD, docs
from seqlab.llm import minhash as M
from seqlab.llm.components import connected_components

RNG = random.Random(11)
VOCAB = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randrange(3, 9))) for _ in range(4000)]


def text(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def changed(t, k, rng=RNG):
    words = t.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = rng.choice(VOCAB)
    return " ".join(words)


def brute_classes(spark, rows, similarity=M.SIMILARITY):
    """Classes by comparing all pairs with the operator's weights."""
    texts = [t or "" for _, t in rows]
    idf = M.idf_table(spark.createDataFrame([(t,) for t in texts], "text string"))
    starts, h, w = M.Weigher(idf).weights(texts)
    sets = [dict(zip(h[a:b].tolist(), w[a:b].astype(float).tolist())) for a, b in zip(starts, starts[1:])]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = sum(min(v, sets[j][k]) for k, v in sets[i].items() if k in sets[j])
            union = sum(sets[i].values()) + sum(sets[j].values()) - common
            if texts[i] == texts[j] or (union and common >= similarity * union):
                root[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    return [min((x for x in ids[top(i)] if x is not None), default=None) for i in range(len(rows))]


def test_classes_equal_brute_force(spark):
    rows, n = [], 0
    for size, edits in ((1, 0), (1, 0), (2, 1), (5, 2), (12, 3), (8, 4)):
        for _ in range(3):
            base = text(120)
            for k in range(size):
                rows.append((n, base if k == 0 else changed(base, edits)))
                n += 1
    chain = text(100)
    for _ in range(6):   # neighbours alike, ends not
        rows.append((n, chain))
        chain, n = changed(chain, 2), n + 1
    got = {r["id"]: r["class_id"] for r in M.near_duplicates(docs(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == brute_classes(spark, rows)


def test_base_with_many_variants_that_differ_from_each_other(spark):
    """Members are like the base but not like each other: the base is not the smallest id."""
    base = text(100)
    rows = [(i, changed(base, 2)) for i in range(25)] + [(25, base)] + [(26 + i, text(50)) for i in range(10)]
    got = {r["id"]: r["class_id"] for r in M.near_duplicates(docs(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == brute_classes(spark, rows)


def test_awkward_rows_one_of_each_stays(spark):
    rows = AWKWARD + [(10, "one two three"), (11, "One, two THREE!"), (12, "one two"), (13, ""), (None, "one two"),
                      (14, "..."), (15, "!!!")]
    got = [(r["id"], r["class_id"], r["kept"]) for r in M.near_duplicates(docs(spark, rows)).collect()]
    assert len(got) == len(rows)
    of = {i: c for i, c, _ in got if i is not None}
    assert of[11] == 10 and of[12] == 12 and of[13] == of[2] == of[1] == 1 and of[14] == 14 and of[15] == 15
    d = docs(spark, rows)
    kept = M.keep_one_of_each(d)
    assert kept.columns == d.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 10, 12, 14, 15] and ids.count(None) == 1


def test_empty_table(spark):
    assert M.near_duplicates(docs(spark, [])).count() == 0 and M.keep_one_of_each(docs(spark, [])).count() == 0


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    h = np.sort(rng.integers(1, 1 << 62, 400).astype(np.uint64))
    w1, w2 = rng.random(400).astype(np.float32) + 1, rng.random(400).astype(np.float32) + 1
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    s = M.Sampler(2000)
    one, two = s(np.array([0, 400]), h, w1), s(np.array([0, 400]), h, w2)
    assert abs((one == two).mean() - want) < 0.05


def test_shingles_of_short_texts_and_counts():
    starts, h, n = M.Shingler()(["a b c d e f", "A, b c d e F!", "", "a b", "x x x x x x x"])
    assert np.diff(starts).tolist() == [2, 2, 0, 1, 1] and n[-1] == 3
    assert h[0:2].tolist() == h[2:4].tolist()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (200, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_document_frequencies_cover_all_documents(spark):
    rows = [(f"alpha beta gamma delta epsilon {text(20)}",) for _ in range(40)]
    idf = M.idf_table(spark.createDataFrame(rows, "text string").repartition(4))
    starts, h, _ = M.Shingler()(["alpha beta gamma delta epsilon"])
    common = idf[int(h[0] >> np.uint64(64 - M.BUCKETS))]
    assert common < np.median(idf) and common <= 1.01
