"""Layer 3: properties of the skew-safe paths, sources, scoring and models."""

import os
import tempfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqlab.operators import models as M
from seqlab.operators import scoring
from seqlab.operators.ordering import ordered_index, ordered_prefix
from seqlab.sources import readers as A


def _rows(keys, vals):
    return [(k, i, v) for i, (k, v) in enumerate(zip(keys, vals))]


def _brute_prefix(rows):
    seen, out = {}, []
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        n, s = seen.get(k, (0, 0.0))
        out.append((str(k), t, float(n), s))
        seen[k] = (n + 1, s + (v if v is not None else 0.0))
    return sorted(out)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=7))
def test_prefix_equals_brute_force(spark, keys, ranges):
    rows = _rows(keys, [float((i * 17) % 11 - 4) if i % 9 else None for i in range(len(keys))])
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = ordered_prefix(df, ["k"], ["t"], {"n": "__one", "s": "v"}, num_ranges=ranges)
    assert sorted((str(r.k), r.t, r.n, r.s) for r in got.collect()) == _brute_prefix(rows)


@pytest.mark.parametrize("ranges", [1, 2, 40])
def test_null_ids_hot_ids_and_ties_stay_whole(spark, ranges):
    from seqlab.operators.sequences import to_sequences
    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i % 20}", i // 4, i) for i in range(600)]
    df = spark.createDataFrame(rows, "mmsi string, ts long, event_id long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = to_sequences(df, "mmsi", "ts", tiebreak="event_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    by = {}
    for m, t, e in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(m, []).append(e)
    want = sorted((str(m), e, i, len(es)) for m, es in by.items() for i, e in enumerate(es))
    assert sorted((str(r.mmsi), r.event_id, r.step, r.seq_len) for r in got) == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b", "c", None]), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=9))
def test_group_totals_equal_brute_force(spark, keys, ranges):
    from seqlab.operators.ordering import ordered_sums
    rows = [(k, i * 7 % 50, i, float((i * 17) % 11 - 4)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, t long, id long, v double")
    for by in (["k"], []):
        got = ordered_sums(df, by, ["t", "id"], F.array(F.lit(1.0), F.col("v")), num_ranges=ranges, total="all")
        groups = {}
        for k, t, i, v in sorted(rows, key=lambda r: r[1:3]):
            groups.setdefault(k if by else 0, []).append((i, v))
        want = {}
        for members in groups.values():
            whole = [float(len(members)), sum(v for _, v in members)]
            for n, (i, _) in enumerate(members):
                want[i] = ([float(n), sum(v for _, v in members[:n])], whole)
        assert {r["id"]: (r["before"], r["all"]) for r in got.collect()} == want


def test_group_totals_with_joined_offsets_and_small_batches(spark, monkeypatch):
    from seqlab.operators import ordering
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", 0)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select((F.col("id") * F.col("id") % 13 % 4).alias("k"), "id")
        got = ordering.ordered_index(df, ["k"], ["id"], num_ranges=6, count="n").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    sizes, seen = {}, {}
    for i in range(500):
        sizes[i * i % 13 % 4] = sizes.get(i * i % 13 % 4, 0) + 1
    for r in sorted(got, key=lambda r: r["id"]):
        assert (r["idx"], r["n"]) == (seen.get(r["k"], 0), sizes[r["k"]])
        seen[r["k"]] = r["idx"] + 1
    assert sum(seen.values()) == 500


def test_sequences_exchange_their_rows_once(spark, capsys):
    from seqlab.operators.sequences import to_sequences
    df = spark.range(300).select((F.col("id") % 5).alias("mmsi"), F.col("id").alias("ts"))
    out = to_sequences(df, "mmsi", "ts")
    out.explain("formatted")
    plan = capsys.readouterr().out
    # the numbered rows are read back and only the table of edges is exchanged
    assert "Range (" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert out.columns == ["mmsi", "ts", "step", "seq_len"] and out.count() == 300
    empty = to_sequences(df.where("ts < 0"), "mmsi", "ts")
    assert empty.count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 64, 65, 200])
def test_mini_batch_split_equals_batches_then_split(spark, n):
    from seqlab.operators import splits
    df = spark.range(n).select((F.col("id") * 37 % 211).alias("k"))
    got = splits.mini_batch_split(df, ["k"], 64, 0.8)
    want = splits.batch_split(splits.mini_batches(df, ["k"], 64), "batch_id", ["k"], 0.8)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_global_index_split_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    out = ordered_index(df, [], ["x"], num_ranges=6)
    got = sorted((r.x, r.idx) for r in out.collect())
    assert got == [(i, i) for i in range(1000)]


def test_hot_key_is_spread_over_ranges(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        (F.col("id") % 50).cast("string")).alias("k"), F.col("id").alias("t"))
    out = ordered_index(df, ["k"], ["t"], num_ranges=8)
    # the hot key's rows are numbered by several tasks yet stay dense
    hot = sorted(r.idx for r in out.where("k = 'hot'").collect())
    assert hot == list(range(1000))


def test_number_lines_over_several_files(spark):
    d = tempfile.mkdtemp(prefix="seqlab-lines-")
    for name, lines in [("part-0.csv", ["h", "0", "1"]), ("part-1.csv", ["h"]), ("part-2.csv", ["h", "2", "3", "4"])]:
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    got = sorted((r.row_no, r.c) for r in A.scan_rows_numbered(spark, d, ["c"], skip=1).collect())
    assert got == [(i, float(i)) for i in range(5)]


def test_numbered_files_steps_in_file_order(spark):
    d = tempfile.mkdtemp(prefix="seqlab-num-")
    for i, lines in [(1, ["a,b", "1,2", "3,4"]), (2, ["a,b", "5,6"]), (10, ["a,b", "7,8"])]:
        with open(os.path.join(d, f"{i}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
    out = A.scan_numbered_sequences(spark, d, 1, 2, ["a", "b"]).collect()
    assert sorted((r.sample_id, r.step, r.a, r.b) for r in out) == [(1, 0, 1.0, 2.0), (1, 1, 3.0, 4.0), (2, 0, 5.0, 6.0)]


def test_positional_schema_bad_cells_and_header(spark):
    d = tempfile.mkdtemp(prefix="seqlab-csv-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("# Timestamp,MMSI,Lat\n01/10/2017 00:00:01,219000,55.5\n02/10/2017 00:00:01,219001,oops\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("Timestamp", T.StringType()), T.StructField("MMSI", T.StringType()),
                           T.StructField("Lat", T.DoubleType())])
    got = A.scan_csv(spark, d, schema=schema, skip_prefix="# Timestamp").orderBy("MMSI").collect()
    assert [(r.MMSI, r.Lat) for r in got] == [("219000", 55.5), ("219001", None)]


def test_rollout_matches_closed_form(spark):
    rows = [(u, d, float(u + d), 2.0 * d) for u in range(5) for d in range(6)]
    df = spark.createDataFrame(rows, "u long, d long, c0 double, c1 double")
    step = scoring.linear_step(np.diag([0.5, 0.9]), np.array([1.0, -1.0]))
    for offset in (0, 1):
        out = {(r.u, r.k, r.cell): r.prediction for r in
               scoring.rollout(df, "u", "d", ["c0", "c1"], step, horizon=3, offset=offset).collect()}
        for u in range(5):
            y = np.array([u + 5.0, 10.0])
            for j in range(1, 3 + offset + 1):
                y = np.diag([0.5, 0.9]) @ y + np.array([1.0, -1.0])
                k = j - 1 - offset
                if k >= 0:
                    assert out[(u, k, 0)] == pytest.approx(y[0]) and out[(u, k, 1)] == pytest.approx(y[1])


def test_rollout_feeds_every_step_to_a_stateful_model(spark):
    """A running sum: the forecast depends on the whole history, also when a
    sample spans several Arrow batches."""
    rows = [(u, d, float(u + d)) for u in (3, 1, 2) for d in range(50 if u == 1 else 7)]
    df = spark.createDataFrame(rows, "u long, d long, c0 double")

    def total(state, x):
        state = x if state is None else state + x
        return state, state

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("4", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = {r.u: r.prediction for r in scoring.rollout(df, "u", "d", ["c0"], total, horizon=1, offset=0).collect()}
            cut = {r.u: r.prediction for r in scoring.rollout(df, "u", "d", ["c0"], total, horizon=1, offset=0,
                                                              start=2, length=3).collect()}
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        assert got == {u: float(sum(v for w, _, v in rows if w == u)) for u in (1, 2, 3)}
        assert cut == {u: float(sum(v for w, d, v in rows if w == u and 2 <= d < 5)) for u in (1, 2, 3)}


def test_gram_means_at_52_cells(spark):
    rng = np.random.default_rng(3)
    d = 52
    data = rng.normal(size=(300, 2 * d))
    names = [f"c{i}" for i in range(d)] + [f"y_c{i}" for i in range(d)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], names)
    got = {(r.kind, r.i, r.j): r.value for r in M.gram_means(df, names[:d]).collect()}
    x = np.column_stack([data[:, :d], np.ones(300)])
    xx, xy = x.T @ x / 300, x.T @ data[:, d:] / 300
    assert len(got) == (d + 1) ** 2 + (d + 1) * d
    assert all(abs(v - (xx if k == "xx" else xy)[i, j]) < 1e-9 for (k, i, j), v in got.items())


def test_forecaster_recovers_linear_dynamics(spark):
    rng = np.random.default_rng(1)
    W = np.array([[0.5, 0.1], [0.0, 0.8]])
    b = np.array([1.0, 2.0])
    rows = []
    for u in range(30):
        y = rng.normal(size=2)
        for d in range(20):
            rows.append((u, d, float(y[0]), float(y[1])))
            y = W @ y + b + rng.normal(scale=0.01, size=2)
    df = spark.createDataFrame(rows, "u long, d long, c0 double, c1 double")
    W_hat, b_hat = M.fit_forecaster(M.lagged_pairs(df, "u", "d", ["c0", "c1"]), ["c0", "c1"], ridge=0.0)
    assert np.allclose(W_hat, W, atol=0.05) and np.allclose(b_hat, b, atol=0.2)


def test_classifier_seed_stable_and_beats_majority(spark):
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(
        F.transform("embedding", lambda v: v.cast("double")).alias("x"), F.col("label").alias("y"))
    m1 = M.fit_vector_classifier(emb, "x", "y", 10, hidden=None, max_iter=30)
    m2 = M.fit_vector_classifier(emb, "x", "y", 10, hidden=None, max_iter=30)
    p1 = [r.yhat for r in M.predict_classes(m1, emb, "x").select("yhat").collect()]
    p2 = [r.yhat for r in M.predict_classes(m2, emb, "x").select("yhat").collect()]
    assert p1 == p2
    ys = [r.y for r in emb.select("y").collect()]
    acc = np.mean([a == b for a, b in zip(p1, ys)])
    majority = max(np.bincount(ys)) / len(ys)
    assert acc > majority


def test_reconstruction_error_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(60, 6))
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id int, x array<double>")
    models = M.fit_reconstruction(df, "x", k=2)
    got = {r.id: r.score for r in M.reconstruction_errors(models, df, "x").collect()}
    Xc = X - X.mean(axis=0)
    _, _, vt = np.linalg.svd(Xc, full_matrices=False)
    P = vt[:2].T
    err = ((Xc - Xc @ P @ P.T) ** 2).mean(axis=1)
    assert np.allclose([got[i] for i in range(60)], err, atol=1e-8)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=2, max_size=80))
def test_auc_exact_equals_pairwise_brute_force(spark, rows):
    from seqlab.operators import evaluation as K
    data = [(y, s / 12.0) for y, s in rows]
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    df = spark.createDataFrame(data, "y int, score double")
    got = K.auc_exact(df).head().auc
    if not pos or not neg:
        assert got is None
        return
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert got == pytest.approx(round(wins / (len(pos) * len(neg)), 6), abs=1e-9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 100)), min_size=2, max_size=60))
def test_roc_thresholded_equals_direct_counts(spark, rows):
    from seqlab.operators import evaluation as K
    data = [(y, s / 100.0) for y, s in rows]
    df = spark.createDataFrame(data, "y int, score double")
    roc = {round(r.threshold * 100): (r.tp, r.fp) for r in K.roc_thresholded(df).collect()}
    for i in range(101):
        tp = sum(1 for y, s in data if y == 1 and s >= i / 100.0)
        fp = sum(1 for y, s in data if y == 0 and s >= i / 100.0)
        assert roc[i] == (tp, fp)


def test_classification_metrics_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randrange(4), rnd.randrange(5)) for _ in range(300)]
    from seqlab.operators import evaluation as K
    r = K.classification_metrics(spark.createDataFrame(rows, "y int, yhat int")).head()
    classes = sorted({y for y, _ in rows} | {p for _, p in rows})
    precs, recs, f1s = [], [], []
    for c in classes:
        tp = sum(1 for y, p in rows if y == c and p == c)
        pred = sum(1 for _, p in rows if p == c)
        act = sum(1 for y, _ in rows if y == c)
        pr = tp / pred if pred else None
        rc = tp / act if act else None
        if pr is not None:
            precs.append(pr)
        if rc is not None:
            recs.append(rc)
        if pr is not None and rc is not None:
            f1s.append(2 * pr * rc / (pr + rc) if pr + rc else 0.0)
    assert r.accuracy == pytest.approx(sum(y == p for y, p in rows) / len(rows), abs=1e-6)
    assert r.precision == pytest.approx(sum(precs) / len(precs), abs=1e-6)
    assert r.recall == pytest.approx(sum(recs) / len(recs), abs=1e-6)
    assert r.f1 == pytest.approx(sum(f1s) / len(f1s), abs=1e-6)


def test_gzip_text_sources(spark):
    import gzip
    d = tempfile.mkdtemp(prefix="seqlab-gz-")
    with gzip.open(os.path.join(d, "part-0.csv.gz"), "wt") as f:
        f.write("h\n" + "\n".join(str(i) for i in range(50)) + "\n")
    got = sorted((r.row_no, r.c) for r in A.scan_rows_numbered(spark, d, ["c"], skip=1).collect())
    assert got == [(i, float(i)) for i in range(50)]
    n = os.path.join(d, "num")
    os.makedirs(n)
    with gzip.open(os.path.join(n, "3.csv.gz"), "wt") as f:
        f.write("a\n1\n2\n")
    out = A.scan_numbered_sequences(spark, n, 0, 9, ["a"], id_pattern=r"(\d+)\.csv\.gz$").collect()
    assert sorted((r.sample_id, r.step, r.a) for r in out) == [(3, 0, 1.0), (3, 1, 2.0)]


def test_save_sequences_skips_finished_and_redoes_partial(spark):
    d = tempfile.mkdtemp(prefix="seqlab-save-")
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 3.0)], "mmsi string, step long, v double")
    assert A.save_sequences(df, f"{d}/s", "mmsi", "step") is True
    assert A.save_sequences(df.limit(1), f"{d}/s", "mmsi", "step") is False
    assert spark.read.parquet(f"{d}/s").count() == 3
    os.makedirs(f"{d}/p")                  # a folder left by a job that died mid-write
    with open(f"{d}/p/_temporary_marker", "w") as f:
        f.write("partial")
    assert A.save_sequences(df.limit(1), f"{d}/p", "mmsi", "step") is True
    assert spark.read.parquet(f"{d}/p").count() == 1


def test_numbering_moves_rows_once(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    out = ordered_index(df, ["k"], ["t"], num_ranges=5)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the saved chunks are read twice and joined with the broadcast offsets
    assert "BroadcastExchange" in plan and "SinglePartition" not in plan.split("Scan parquet")[0]


def test_bins_of_scores_at_and_next_to_every_threshold(spark):
    import math
    from seqlab.operators import evaluation as K
    scores = [x for k in range(101) for x in (k / 100.0, math.nextafter(k / 100.0, -1), math.nextafter(k / 100.0, 2))]
    scores += [0.16999999999999998, -5.0, 7.0, 1e300, -1e300, float("inf"), float("-inf")]
    df = spark.createDataFrame([(x,) for x in scores], "s double")
    for r in df.select("s", K.threshold_bin("s").alias("k")).collect():
        assert r.k == sum(r.s >= k / 100.0 for k in range(101)) - 1, r


def test_nan_scores_are_dropped_everywhere(spark):
    from seqlab.operators import evaluation as K
    df = spark.createDataFrame([(1, 0.9, 0), (0, float("nan"), 0), (0, 0.1, 0), (1, None, 0)],
                               "y int, score double, batch_id long")
    assert K.auc_exact(df).head().auc == 1.0 and K.auc_exact(df).head().n_neg == 1
    assert K.auc_thresholded(df).head().auc == 1.0 and K.running_auc(df).head().auc == 1.0
    assert K.roc_thresholded(df).where("threshold = 0").head().fp == 1


def test_running_auc_equals_recomputation(spark):
    import random
    from seqlab.operators import evaluation as K
    rnd = random.Random(4)
    rows = [(i // 7, rnd.randrange(2), rnd.randrange(-5, 120) / 100.0) for i in range(140)]
    df = spark.createDataFrame(rows, "batch_id long, y int, score double")
    got = {r.batch_id: r.auc for r in K.running_auc(df).collect()}
    for b in (0, 3, 19):
        want = K.auc_thresholded(df.where(F.col("batch_id") <= b)).head().auc
        assert got[b] == want


def test_line_numbers_across_splits_of_one_file(spark):
    d = tempfile.mkdtemp(prefix="seqlab-splits-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("h\n" + "\n".join(str(i) for i in range(20000)) + "\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("h\n" + "\n".join(str(20000 + i) for i in range(5000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")   # many splits per file
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 4
        got = sorted((r.row_no, r.c) for r in A.scan_rows_numbered(spark, d, ["c"], skip=1).collect())
        steps = A.scan_numbered_sequences(spark, d, 0, 9, ["c"], id_pattern=r"/(\d)\.csv$")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, float(i)) for i in range(25000)]
    assert steps.count() == 0   # no file name is a single digit


def test_long_sample_file_read_by_several_splits(spark):
    d = tempfile.mkdtemp(prefix="seqlab-longsample-")
    with open(os.path.join(d, "7.csv"), "w") as f:
        f.write("v\n" + "\n".join(str(i) for i in range(20000)) + "\n")
    with open(os.path.join(d, "8.csv"), "w") as f:
        f.write("v\n1\n2\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 4
        got = sorted((r.sample_id, r.step, r.v) for r in A.scan_numbered_sequences(spark, d, 0, 9, ["v"]).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(7, i, float(i)) for i in range(20000)] + [(8, 0, 1.0), (8, 1, 2.0)]


def test_positional_schema_prefix_with_separator(spark):
    from pyspark.sql import types as T
    d = tempfile.mkdtemp(prefix="seqlab-csv2-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("# Timestamp,MMSI,Lat\n# Timestamp,x,y\n01/10/2017 00:00:01,219000,55.5\n")
    schema = T.StructType([T.StructField("Timestamp", T.StringType()), T.StructField("MMSI", T.StringType()),
                           T.StructField("Lat", T.DoubleType())])
    got = A.scan_csv(spark, d, schema=schema, skip_prefix="# Timestamp,MMSI").collect()
    # only the first line starts with the prefix (text filter path)
    assert sorted((r.MMSI, r.Lat) for r in got) == [("219000", 55.5), ("x", None)]


def test_joined_offsets_equal_broadcast_ones(spark, monkeypatch):
    from seqlab.operators import ordering
    rows = [("hot" if i % 3 else f"k{i % 7}", i, float(i % 11)) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(4)
    read = lambda: sorted(map(tuple, ordered_prefix(df, ["k"], ["t"], {"n": "__one", "s": "v"}, num_ranges=9).collect()))
    small = read()
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", 0)
    joined = ordered_prefix(df, ["k"], ["t"], {"n": "__one", "s": "v"}, num_ranges=9)
    assert "ResolvedHint (strategy=broadcast)" not in joined._jdf.queryExecution().analyzed().toString()
    assert read() == small and len(small) == 700


def test_conversation_files_are_written_by_many_tasks(spark):
    import glob
    import re
    from seqlab.plans import io_queries
    d = tempfile.mkdtemp(prefix="seqlab-conv-")
    rows = [(i, t, "assistant" if t % 2 else "user", "x" * (i + t)) for i in range(60) for t in range(1 + i % 3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3) \
        .write.parquet(f"{d}/conversations.parquet")
    path = io_queries.conversation_files(spark, d).removeprefix("file:")
    files = [os.path.relpath(f, path) for f in glob.glob(f"{path}/sample_id=*/*.csv")]
    assert sorted(os.path.dirname(f) for f in files) == sorted(f"sample_id={i}" for i in range(60))   # one file each
    # a few bytes, yet as many writers as shuffle partitions
    tasks = {re.search(r"part-(\d+)", f)[1] for f in files}
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = sorted(map(tuple, io_queries.q_scan_numbered_sequences(spark, d).collect()))
    assert got == [(i, t, float(len(x)), float(r == "assistant")) for i, t, r, x in rows]
