"""Layer 2: hand fixtures with literal expected rows (edge cases of FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seqlab.functions import columns as C
from seqlab.operators import align, evaluation as K, projection as B, ranking, seq2seq, splits
from seqlab.operators import sequences as E
from seqlab.plans.trajectories import GEO_BOX, hourly_trajectories

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(h=0, m=0, s=0, day=0):
    return T0 + dt.timedelta(days=day, hours=h, minutes=m, seconds=s)


# ------------------------------------------------------------------ B3 ----
def test_outlier_bounds_inclusive_and_nan_null_dropped(spark):
    rows = [(1, 90.0, 0.0), (2, -90.0, 0.0), (3, 90.0001, 0.0), (4, 91.0, 0.0),
            (5, float("nan"), 0.0), (6, None, 0.0), (7, 0.0, 180.0), (8, 0.0, -180.0),
            (9, 0.0, 180.5), (10, 0.0, float("nan"))]
    df = spark.createDataFrame(rows, "id int, lat double, lon double")
    kept = sorted(r.id for r in B.drop_outside(df, GEO_BOX).collect())
    assert kept == [1, 2, 7, 8]


# ------------------------------------------------------------------ C* ----
def test_minmax_and_text(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0)], "lat double, lon double")
    got = df.select(C.minmax("lat", -90, 90).alias("a"), C.minmax("lon", -180, 180).alias("b"),
                    C.to_text(C.minmax("lat", -90, 90)).alias("t")).collect()
    assert [(r.a, r.b, r.t) for r in got] == [(0.0, 0.0, "0.000000"), (1.0, 1.0, "1.000000"),
                                             (0.5, 0.5, "0.500000")]


def test_parse_time_bad_text_is_null(spark):
    df = spark.createDataFrame([("01/10/2017 00:59:59",), ("not a time",), ("31/02/2017 00:00:00",)], "s string")
    got = [r.t for r in df.select(C.parse_time_millis("s").alias("t")).collect()]
    assert got[0] == int(dt.datetime(2017, 10, 1, 0, 59, 59, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert got[1] is None and got[2] is None


def test_split_doubles_arity(spark):
    df = spark.createDataFrame([("1.5,2.5",), ("1,2,3",), ("x,1",)], "s string")
    got = [r.a for r in df.select(C.split_doubles("s", ",", arity=2).alias("a")).collect()]
    assert got == [[1.5, 2.5], None, [None, 1.0]]
    with pytest.raises(Exception):
        df.select(C.split_doubles("s", ",", arity=2, strict=True).alias("a")).collect()


def test_argmax_first_on_ties_and_one_hot(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([2.0],), ([],)], "a array<double>")
    assert [r.i for r in df.select(C.argmax("a").alias("i")).collect()] == [1, 0, None]
    oh = spark.createDataFrame([(0,), (1,), (5,)], "y int").select(C.one_hot("y", 2).alias("v")).collect()
    assert [r.v for r in oh] == [[1, 0], [0, 1], [0, 0]]


def test_grid_round_trip(spark):
    df = spark.createDataFrame([(list(range(12)),)], "v array<int>")
    r = df.select(C.to_grid("v", 3, 4).alias("g"), C.from_grid(C.to_grid("v", 3, 4)).alias("f")).head()
    assert r.g == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]] and r.f == list(range(12))


def test_geo_xyz_round_trip(spark):
    df = spark.createDataFrame([(10.0, 20.0), (-45.0, 179.0)], "lat double, lon double")
    x, y, z = C.geo_xyz("lat", "lon")
    la, lo = C.xyz_geo(x, y, z)
    got = df.select(la.alias("a"), lo.alias("b")).collect()
    assert all(abs(r.a - e[0]) < 1e-9 and abs(r.b - e[1]) < 1e-9 for r, e in zip(got, [(10, 20), (-45, 179)]))


# ------------------------------------------------------------------ E* ----
def _positions(spark, rows):
    return spark.createDataFrame(rows, "mmsi string, ts timestamp_ntz, lat double, lon double")


def test_window_edges_and_equal_times(spark):
    rows = [("a", ts(0, 59, 59), 0.0, 0.0), ("a", ts(1, 0, 0), 0.0, 0.0), ("a", ts(1, 0, 0), 10.0, 0.0)]
    out = E.window_reduce(_positions(spark, rows), "mmsi", "ts").orderBy("window_start").collect()
    assert [(r.window_start, r.n_points, r.first_ts) for r in out] == [
        (ts(0), 1, ts(0, 59, 59)), (ts(1), 2, ts(1))]


def test_length_filter_strictly_more_than_seven(spark):
    rows = [("seven", ts(h), 0.0, 0.0) for h in range(7)] + [("eight", ts(h), 0.0, 0.0) for h in range(8)]
    out = hourly_trajectories(_positions(spark, rows)).collect()
    assert {r.mmsi for r in out} == {"eight"}
    assert sorted(r.step for r in out) == list(range(8))


def test_antimeridian_geodesic_vs_reference(spark):
    rows = [("a", ts(0, 10), 0.0, 179.0), ("a", ts(0, 20), 0.0, -179.0)]
    geo = E.hourly_geo_windows(_positions(spark, rows), "mmsi", "ts", "lat", "lon", geo_mode="geodesic").head()
    ref = E.hourly_geo_windows(_positions(spark, rows), "mmsi", "ts", "lat", "lon", geo_mode="reference").head()
    # geodesic mean is on the antimeridian (scaled lon 0 or 1); the reference
    # mode averages scaled numbers and lands mid-range
    assert geo.lon in (0.0, 1.0) and abs(geo.lat - 0.5) < 1e-9
    assert abs(ref.lon - 0.5) < 1e-3


def test_geo_average_is_order_and_partition_invariant(spark):
    rows = [("a", ts(0, i), float(i % 7), float(i * 3 % 50)) for i in range(40)]
    df = _positions(spark, rows)
    a = E.hourly_geo_windows(df, "mmsi", "ts", "lat", "lon").collect()
    b = E.hourly_geo_windows(df.repartition(7).orderBy(F.rand(3)), "mmsi", "ts", "lat", "lon").collect()
    assert a == b


def test_sequence_stats(spark):
    rows = [("a", ts(0), 0.0, 0.0), ("a", ts(2), 0.0, 0.0), ("b", ts(1), 0.0, 0.0)]
    df = _positions(spark, rows).withColumn("t", F.unix_millis(F.col("ts").cast("timestamp")))
    got = {r.mmsi: (r.num_positions, r.total_time) for r in E.sequence_stats(df, "mmsi", "t").collect()}
    assert got == {"a": (2, 7_200_000), "b": (1, 0)}


# ------------------------------------------------------------------ F* ----
def test_best_worst_fewer_rows_than_n(spark):
    df = spark.createDataFrame([(1, 0, 0.5), (2, 0, 0.1), (3, 0, 0.1), (4, 1, 0.2)], "id int, label int, score double")
    out = ranking.best_worst(df, "label", "score", "id", n=5).collect()
    best0 = [r.id for r in sorted(out, key=lambda r: r.pos) if r.kind == "best" and r.label == 0]
    worst0 = [r.id for r in sorted(out, key=lambda r: r.pos) if r.kind == "worst" and r.label == 0]
    assert best0 == [2, 3, 1] and worst0 == [1, 3, 2]
    assert len([r for r in out if r.label == 1]) == 2


# ------------------------------------------------------------------ D* ----
def test_align_end_dense_masks(spark):
    rows = [(1, 0, 1.0, 0), (1, 1, 2.0, 0), (1, 2, 3.0, 0), (2, 0, 9.0, 0)]
    df = spark.createDataFrame(rows, "seq_id int, step long, value double, batch_id long")
    dense = align.align_end(df, "seq_id", "step", "batch_id", dense=True, value_cols=["value"])
    got = sorted((r.seq_id, r.pos, r.value, r.mask) for r in dense.collect())
    assert got == [(1, 0, 1.0, 1), (1, 1, 2.0, 1), (1, 2, 3.0, 1),
                   (2, 0, 0.0, 0), (2, 1, 0.0, 0), (2, 2, 9.0, 1)]
    assert sum(g[3] for g in got) == df.count()


def test_align_end_equal_lengths_no_padding(spark):
    rows = [(s, t, float(t), 0) for s in (1, 2) for t in range(3)]
    df = spark.createDataFrame(rows, "seq_id int, step long, value double, batch_id long")
    dense = align.align_end(df, "seq_id", "step", "batch_id", dense=True, value_cols=["value"]).collect()
    assert all(r.mask == 1 for r in dense) and len(dense) == 6


# ------------------------------------------------------------------ G* ----
def test_hash_split_disjoint_complete_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = splits.hash_split(df, "k", 80)
    b = splits.hash_split(df.repartition(5), "k", 80)
    ra = {r.k: r.split for r in a.collect()}
    assert ra == {r.k: r.split for r in b.collect()}
    share = sum(v == "train" for v in ra.values()) / len(ra)
    assert 0.75 < share < 0.85 and len(ra) == 2000


def test_batch_split_floor_and_minimum_one(spark):
    df = spark.createDataFrame([(i, i // 4) for i in range(9)], "id int, b int")
    out = {r.id: r.split for r in splits.batch_split(df, "b", ["id"], 0.8).collect()}
    # batches of 4, 4 and 1: floor(3.2) = 3 train each, the 1-row batch keeps 1
    assert [out[i] for i in range(9)] == ["train"] * 3 + ["validation"] + ["train"] * 3 + ["validation"] + ["train"]


def test_mini_batches_last_short(spark):
    df = spark.range(70).select(F.col("id").alias("k"))
    out = splits.mini_batches(df, ["k"], 32).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r.batch_id, r["count"]) for r in out] == [(0, 32), (1, 32), (2, 6)]


# ------------------------------------------------------------------ H* ----
def _seq_input(spark):
    rows = [("a", t, c, float(10 * t + c)) for t in range(3) for c in range(2)] + [("b", 0, 0, 5.0), ("b", 0, 1, 6.0)]
    return spark.createDataFrame(rows, "seq_id string, step long, channel int, value double")


def test_seq2seq_go_stop_default(spark):
    out = seq2seq.seq2seq(_seq_input(spark), n_channels=2).collect()
    go = sorted((r.seq_id, r.pos) for r in out if r.tensor == "decoder" and r.channel == 2)
    stop = sorted((r.seq_id, r.pos) for r in out if r.tensor == "label" and r.channel == 2)
    assert go == [("a", 0), ("b", 0)] and stop == [("a", 2), ("b", 0)]
    dec_a = {(r.pos, r.channel): r.value for r in out if r.tensor == "decoder" and r.seq_id == "a" and r.channel < 2}
    assert dec_a[(1, 0)] == 0.0 and dec_a[(3, 1)] == 21.0 and (0, 0) not in dec_a


def test_seq2seq_variants(spark):
    out = seq2seq.seq2seq(_seq_input(spark), n_channels=2, go="all", stop="after").collect()
    go = sorted((r.seq_id, r.pos) for r in out if r.tensor == "decoder" and r.channel == 2)
    stop = sorted((r.seq_id, r.pos) for r in out if r.tensor == "label" and r.channel == 2)
    # every position of the padded tensor, also beyond a short sequence's end
    assert go == [(i, p) for i in "ab" for p in range(4)]
    assert stop == [("a", 3), ("b", 1)]


def test_extend_mask(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 1, 1)], "seq_id int, pos long, mask int")
    got = sorted((r.pos, r.mask) for r in seq2seq.extend_mask(df).collect())
    assert got == [(0, 1), (1, 0), (2, 1)]


def test_extend_mask_is_left_out_where_nothing_is_padded(spark):
    df = spark.createDataFrame([(1, 0, 1, 7), (1, 1, 1, 7), (2, 0, 0, 8), (2, 1, 1, 8)],
                               "seq_id int, pos long, mask int, batch_id long")
    got = sorted((r.seq_id, r.pos, r.mask) for r in seq2seq.extend_mask(df, batch_id="batch_id").collect())
    assert got == [(2, 0, 1), (2, 1, 0), (2, 2, 1)]


def test_one_hot_of_null_is_all_zero(spark):
    from seqlab.functions import columns as C
    got = [r.h for r in spark.createDataFrame([(None,), (1,), (9,)], "y int").select(C.one_hot("y", 3).alias("h")).collect()]
    assert got == [[0, 0, 0], [0, 1, 0], [0, 0, 0]]


def test_batch_transform_sees_whole_batches(spark):
    from seqlab.operators import splits
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (None, 5.0), (2, 7.0)], "b long, v double")
    got = splits.batch_transform(df, "b", lambda p: p.assign(s=p.v.sum(), n=len(p)), "b long, v double, s double, n long")
    assert sorted((r.v, r.s, r.n) for r in got.collect()) == [(1.0, 4.0, 2), (3.0, 4.0, 2), (5.0, 5.0, 1), (7.0, 7.0, 1)]
    assert splits.batch_transform(df.limit(0), "b", lambda p: p, df.schema).count() == 0


# ------------------------------------------------------------------ K* ----
def _bin_df(spark, rows):
    return spark.createDataFrame(rows, "y int, score double")


def test_auc_exact_ties_and_single_class(spark):
    df = _bin_df(spark, [(1, 0.9), (0, 0.1), (1, 0.5), (0, 0.5)])
    assert K.auc_exact(df).head().auc == pytest.approx((1 + 1 + 1 + 0.5) / 4)
    assert K.auc_exact(_bin_df(spark, [(1, 0.3), (1, 0.4)])).head().auc is None


def test_auc_negated_scores(spark):
    rows = [(i % 3 == 0 and 1 or 0, ((i * 37) % 101) / 101.0) for i in range(300)]
    df = _bin_df(spark, rows)
    a = K.auc_exact(df).head().auc
    b = K.auc_exact(df.withColumn("score", -F.col("score"))).head().auc
    assert a + b == pytest.approx(1.0, abs=2e-6)
    t = K.auc_thresholded(df).head().auc
    assert abs(t - a) < 0.02


def test_threshold_bins_on_exact_hundredths(spark):
    df = spark.createDataFrame([(0.29,), (0.57,), (0.0,), (1.0,), (-0.1,), (0.999,)], "s double")
    got = [r.b for r in df.select(K.threshold_bin("s").alias("b")).collect()]
    assert got == [29, 57, 0, 100, -1, 99]


def test_roc_rows(spark):
    df = _bin_df(spark, [(1, 0.9), (0, 0.2)])
    roc = {round(r.threshold, 2): (r.tpr, r.fpr) for r in K.roc_thresholded(df).collect()}
    assert len(roc) == 101 and roc[0.0] == (1.0, 1.0) and roc[0.5] == (1.0, 0.0) and roc[1.0] == (0.0, 0.0)
    assert K.auc_thresholded(df).head().auc == 1.0


def test_running_auc_matches_prefix_tables(spark):
    rows = [(b, (b * 7 + i) % 2, ((b * 13 + i * 5) % 100) / 100.0) for b in range(6) for i in range(10)]
    df = spark.createDataFrame(rows, "batch_id long, y int, score double")
    run = {r.batch_id: r.auc for r in K.running_auc(df).collect()}
    for b in range(6):
        prefix = df.where(F.col("batch_id") <= b)
        assert run[b] == K.auc_thresholded(prefix).head().auc


def test_classification_metrics_skip_undefined_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "y int, yhat int")
    r = K.classification_metrics(df).head()
    # class 1 is never predicted: precision over classes 0 and 2 only
    assert r.accuracy == 0.75 and r.precision == pytest.approx((2 / 3 + 1) / 2, abs=1e-6)
    assert r.recall == pytest.approx((1 + 0 + 1) / 3, abs=1e-6)


def test_regression_constant_truth(spark):
    df = spark.createDataFrame([(0, 1.0, 1.5), (0, 1.0, 0.5)], "col int, truth double, prediction double")
    r = K.regression_metrics(df).head()
    assert r.mse == 0.25 and r.mae == 0.5 and r.rmse == 0.5
    assert r.rse is None and r.r2 is None and r.correlation is None


def test_timeseries_mask(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.1, 1), (0, 0.95, 0)], "y int, score double, mask int")
    assert K.timeseries_auc(df).head().auc == 1.0
    assert K.timeseries_auc(df, include_padding=True).head().auc == 0.5


def test_positional_zip_drops_excess_rows(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "row_no long, a double")
    b = spark.createDataFrame([(0, 10.0), (1, 20.0)], "row_no long, b double")
    got = sorted(tuple(r) for r in align.positional_zip([a, b]).collect())
    assert got == [(0, 1.0, 10.0), (1, 2.0, 20.0)]


def test_thresholded_auc_single_class_is_null(spark):
    assert K.auc_thresholded(_bin_df(spark, [(0, 0.2), (0, 0.7)])).head().auc is None


def test_seq2seq_stop_at_last_nonzero_mask(spark):
    rows = [("a", t, 0, float(t), m) for t, m in enumerate([1, 1, 1, 0, 0])]
    df = spark.createDataFrame(rows, "seq_id string, step long, channel int, value double, mask int")
    out = seq2seq.seq2seq(df, n_channels=1, mask="mask").collect()
    stop = [(r.pos, r.value) for r in out if r.tensor == "label" and r.channel == 1]
    assert stop == [(2, 1.0)]
    last = B.last_valid_step(df, "seq_id", "step", "mask").head().last_step
    assert last == 2


def test_one_step_sequence(spark):
    df = spark.createDataFrame([("b", 0, 0, 5.0)], "seq_id string, step long, channel int, value double")
    out = sorted((r.tensor, r.pos, r.channel, r.value) for r in seq2seq.seq2seq(df, n_channels=1).collect())
    assert out == [("decoder", 0, 1, 1.0), ("decoder", 1, 0, 5.0), ("label", 0, 0, 5.0), ("label", 0, 1, 1.0)]
