"""Kept and recurrent state, neighbourhood forecasts and sequence lookup."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqlab.operators import kept_state as P
from seqlab.operators import recurrence as R
from seqlab.operators import scoring, stencil
from seqlab.sources import readers as A
from seqlab.sources.lookup import lookup_sequences, zone_map


# ------------------------------------------------------------ lookup ----
SAVED = "id string, step bigint, v double, split string"


def saved_sequences(spark, tmp_path, files=12, partition_by=None):
    """One sequence fills most files; the others are short."""
    rows = [("hot", i, float(i), "train") for i in range(3000)]
    rows += [(f"s{i:03d}", j, float(i), "test" if i % 3 else "train") for i in range(90) for j in range(i % 7 + 1)]
    rows += [(None, 0, -1.0, "test"), ("", 0, -2.0, "test")]
    path = str(tmp_path / "sequences")
    A.save_sequences(spark.createDataFrame(rows, SAVED), path, "id", "step", num_files=files, partition_by=partition_by)
    return path, rows


@pytest.mark.parametrize("partition_by", [None, "split"])
def test_lookup_returns_the_sequences_and_opens_few_files(spark, tmp_path, partition_by):
    path, rows = saved_sequences(spark, tmp_path, partition_by=partition_by)
    total = len(spark.read.parquet(path).inputFiles())
    for ids, most in [(["s042"], 2), (["s000", "s089", "nobody"], 6), ([""], 3), ([], 0), (["zzz"], 1), ([None], 0)]:
        got = lookup_sequences(spark, path, ids, "id", "step")
        assert sorted(map(tuple, got.select("id", "step", "v", "split").collect())) == sorted(
            r for r in rows if r[0] is not None and r[0] in ids)
        assert ids and ids != [None] and ids != ["zzz"] or got.count() == 0
        if got.count():
            assert len(got.inputFiles()) <= most < total
    zones = zone_map(spark, path, "id", "step")
    assert zones.count() == total and zones.agg(F.sum("rows")).first()[0] == len(rows)


def test_lookup_by_steps_of_a_sequence_in_many_files(spark, tmp_path):
    path, _ = saved_sequences(spark, tmp_path)
    whole = lookup_sequences(spark, path, ["hot"], "id", "step")
    some = lookup_sequences(spark, path, ["hot"], "id", "step", first=1500, last=1510)
    assert whole.count() == 3000 and len(whole.inputFiles()) > 6
    assert sorted(r.step for r in some.collect()) == list(range(1500, 1511)) and len(some.inputFiles()) <= 2


def test_a_zone_map_does_not_outlive_its_data(spark, tmp_path):
    path, _ = saved_sequences(spark, tmp_path)
    assert lookup_sequences(spark, path, ["new"], "id", "step").count() == 0
    again = spark.createDataFrame([("new", 0, 1.0, "train")], SAVED)
    A.save_sequences(again, path, "id", "step", mode="overwrite")
    assert lookup_sequences(spark, path, ["new"], "id", "step").count() == 1
    assert lookup_sequences(spark, path, ["hot"], "id", "step").count() == 0


# -------------------------------------------------------- recurrence ----
def loop(rows, rates):
    """rows: (key, step, value, gate) -> {(key, step): states}"""
    out, states = {}, {}
    for key, step, v, g in sorted(rows, key=lambda r: (repr(r[0]), r[1])):
        v = 0.0 if v is None or v != v else v
        s = states.get(key, [0.0] * (len(rates) + 1))
        s = [r * a + (1 - r) * v for r, a in zip(rates, s)] + [(1 - g) * s[-1] + g * v if g is not None else s[-1]]
        states[key] = out[key, step] = s
    return out


@pytest.mark.parametrize("chunks", [1, 7, 40])
def test_decayed_features_equal_a_loop(spark, chunks):
    rng = random.Random(chunks)
    rows = [("hot", i, rng.gauss(0, 1), rng.random()) for i in range(900)]
    rows += [(k, i, rng.choice([None, float("nan"), 1.0, -2.0]), rng.random()) for k in ("a", None, "", "z") for i in range(5)]
    rows += [(f"one{i}", 0, 3.0, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, step int, v double, g double").repartition(5)
    got = R.decayed_features(df, "id", "step", ["v"], [0.5, 0.99], gate=F.col("g"), num_ranges=chunks).collect()
    want = loop(rows, [0.5, 0.99])
    assert len(got) == len(rows)
    for r in got:
        assert [r.v_r0, r.v_r1, r.v_gate] == pytest.approx(want[r.id, r.step], rel=1e-9, abs=1e-12)


def test_scan_goes_on_over_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        test_decayed_features_equal_a_loop(spark, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_joined_carries_equal_broadcast_ones(spark, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    test_decayed_features_equal_a_loop(spark, 7)


def test_last_states_and_empty_table(spark):
    df = spark.createDataFrame([], "id string, step int, v double, g double")
    assert R.decayed_features(df, "id", "step", ["v"], [0.5]).collect() == []
    df = spark.createDataFrame([("a", 0, 2.0), ("a", 1, 4.0)], "id string, step int, v double")
    feats = R.decayed_features(df, "id", "step", ["v"], [0.5])
    assert [tuple(r) for r in R.last_states(feats, "id", "step", ["v_r0"]).collect()] == [("a", 2.0, 2.5)]


# -------------------------------------------------------- kept state ----
CELLS = ["x", "y"]


def _memory_step():
    """A state wider than its output, that counts what it was fed."""
    def step(state, x):
        x = np.asarray(x, float)
        state = np.zeros((len(x), 3)) if state is None else np.asarray(state)
        state = np.column_stack([0.7 * state[:, 0] + x[:, 0], 0.2 * state[:, 1] + x[:, 1], state[:, 2] + 1])
        return state, state[:, :2] + 0.01 * state[:, 2:]
    return step


memory_step = _memory_step()


def series(seed, n=40):
    rng = random.Random(seed)
    return [(i, t, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(n) for t in range(rng.choice([1, 2, 9, 30]))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, t bigint, x double, y double").repartition(3)


def table(df):
    return {r.id: (r.last_step, [round(v, 9) for v in r.state], [round(v, 9) for v in r.output]) for r in df.collect()}


@pytest.mark.parametrize("batch", [5, 10_000])
def test_two_halves_equal_one_feed(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = series(batch)
        whole = table(P.advance(frame(spark, rows), "id", "t", CELLS, memory_step))
        for cut in (1, 5, 100):
            first = P.advance(frame(spark, [r for r in rows if r[1] < cut]), "id", "t", CELLS, memory_step)
            # the second feed repeats what the first one had, and brings new samples
            assert table(P.advance(frame(spark, rows), "id", "t", CELLS, memory_step, first)) == whole
        new = frame(spark, [(99, 3, 1.0, 1.0)])
        kept = P.advance(frame(spark, rows), "id", "t", CELLS, memory_step)
        grown = table(P.advance(new, "id", "t", CELLS, memory_step, kept))
        assert grown.pop(99)[0] == 3 and grown == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_states_equal_a_loop_and_skip_awkward_rows(spark):
    rows = series(3, 12)
    want = {}
    for i in {r[0] for r in rows}:
        s = None
        for _, t, x, y in sorted(r for r in rows if r[0] == i):
            s, out = memory_step(s, np.array([[x, y]]))
        want[i] = (t, [round(v, 9) for v in s[0]], [round(v, 9) for v in out[0]])
    more = [(None, 0, 1.0, 1.0), (5, None, 1.0, 1.0)] + [(i, t, x + 1, y) for i, t, x, y in rows[:9]]   # repeated steps
    assert table(P.advance(frame(spark, rows + more), "id", "t", CELLS, memory_step)) == want
    assert table(P.advance(frame(spark, []), "id", "t", CELLS, memory_step)) == {}


def test_forecast_equals_rollout(spark):
    df = frame(spark, series(4))
    for offset in (0, 1):
        kept = P.advance(df, "id", "t", CELLS, memory_step)
        a = P.forecast(kept, "id", memory_step, 4, offset)
        b = scoring.rollout(df, "id", "t", CELLS, memory_step, horizon=4, offset=offset)
        key = lambda r: (r.id, r.k, r.cell, round(r.prediction, 9))
        assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_only_finished_versions_count(spark, tmp_path):
    path = str(tmp_path / "states")
    assert P.load_states(spark, path) is None
    states = P.advance(frame(spark, series(5, 6)), "id", "t", CELLS, memory_step)
    P.save_states(states, path, 1)
    (tmp_path / "states" / "version=2").mkdir()                        # a run that failed
    assert P.latest_version(spark, path) == 1
    assert table(P.load_states(spark, path)) == table(states)
    again = P.advance(frame(spark, [(77, 0, 0.0, 0.0)]), "id", "t", CELLS, memory_step, P.load_states(spark, path))
    assert 77 in table(P.save_states(again, path, 2)) and P.latest_version(spark, path) == 2
    assert table(P.save_states(states, path, 2)) == table(P.load_states(spark, path, 2))    # written once
    assert 77 not in table(P.load_states(spark, path, 1))


# ----------------------------------------------------------- stencil ----
def test_stencil_is_recovered(spark):
    rng = np.random.default_rng(1)
    true, bias = rng.normal(size=(3, 3)), 0.4
    step = stencil.stencil_step(true, bias, 4, 13)
    x = rng.normal(size=(300, 52))
    y = step(None, x)[1]
    rows = [(a.tolist(), b.tolist()) for a, b in zip(x, y)]
    rows += [(None, x[0].tolist()), (x[0].tolist()[:-1], y[0].tolist()), ([None] * 52, y[0].tolist())]
    pairs = spark.createDataFrame(rows, "x array<double>, y array<double>").repartition(4)
    got, b = stencil.fit_stencil(pairs, "x", "y", 4, 13)
    assert np.allclose(got, true, atol=1e-9) and b == pytest.approx(bias, abs=1e-9)


def test_patches_by_hand():
    p = stencil.patches(np.arange(1.0, 7.0)[None], 2, 3)
    assert p[0].tolist() == [0, 0, 0, 0, 1, 2, 0, 4, 5, 1]
    assert p[5].tolist() == [2, 3, 0, 5, 6, 0, 0, 0, 0, 1]


def test_stencil_rollout_over_grids(spark):
    true = np.array([[0, 0.1, 0], [0.1, 0.5, 0.1], [0, 0.1, 0]])
    step = stencil.stencil_step(true, 0.0, 3, 3)
    cells = [f"c{i}" for i in range(9)]
    df = spark.createDataFrame([(1, 0, *map(float, range(9)))], ["id", "t", *cells])
    out = scoring.rollout(df, "id", "t", cells, step, horizon=2, offset=0)
    x = np.arange(9.0)[None]
    for k in range(2):
        _, x = step(None, x)
        got = [r.prediction for r in out.where(F.col("k") == k).orderBy("cell").collect()]
        assert got == pytest.approx(x[0].tolist())
