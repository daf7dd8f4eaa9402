"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` that reads the given tables in full.

Floating outputs that pass through engine-specific summation or libm calls
are rounded (6 decimals, 9 for trigonometry) so that they compare equal
with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.functions import columns as C
from seqlab.operators import align, evaluation as K, projection as B, ranking, scoring, seq2seq, splits
from seqlab.operators import sequences as E
from seqlab.operators.comparing import comparator_order
from seqlab.plans import standins as S
from seqlab.plans.trajectories import GEO_BOX, hourly_trajectories
from seqlab.sources import readers as A

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _filtered_positions(spark, sf_dir) -> DataFrame:
    return B.drop_outside(S.vessel_positions(spark, sf_dir), GEO_BOX)


# ================================================================ E ======
@register("hourly_trajectories")
def q_hourly_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 flagship (reference geo mode)."""
    return hourly_trajectories(S.vessel_positions(spark, sf_dir))


@register("hourly_window_reduce")
def q_hourly_window_reduce(spark, sf_dir):
    """E3 with the geodesic E4 variant: per (vessel, hour) count, first time, mean position."""
    return E.hourly_geo_windows(_filtered_positions(spark, sf_dir), "mmsi", "ts", "lat", "lon",
                                geo_mode="geodesic")


@register("geo_average")
def q_geo_average(spark, sf_dir):
    """E4 both modes per vessel."""
    pos = _filtered_positions(spark, sf_dir)
    la_r, lo_r = E.geo_average(C.minmax("lat", -90, 90), C.minmax("lon", -180, 180))
    la_g, lo_g = E.geo_average("lat", "lon")
    return pos.groupBy("mmsi").agg(F.count(F.lit(1)).alias("n"), la_r.alias("lat_ref"),
                                   lo_r.alias("lon_ref"), la_g.alias("lat_geo"), lo_g.alias("lon_geo"))


@register("sequence_stats")
def q_sequence_stats(spark, sf_dir):
    """E2 on epoch milliseconds."""
    pos = S.vessel_positions(spark, sf_dir).select(
        "mmsi", C.epoch_millis("ts").alias("t"))
    return E.sequence_stats(pos, "mmsi", "t")


@register("to_sequences")
def q_to_sequences(spark, sf_dir):
    """Time-ordered step numbers per vessel (event_id breaks ties)."""
    pos = _filtered_positions(spark, sf_dir).select("event_id", "mmsi", "ts")
    return E.to_sequences(pos, "mmsi", "ts", tiebreak="event_id").select(
        "mmsi", "event_id", "step", "seq_len")


@register("min_length_filter")
def q_min_length_filter(spark, sf_dir):
    """B5 on hourly windows: keep vessels with more than 7 windows."""
    hourly = E.hourly_geo_windows(_filtered_positions(spark, sf_dir), "mmsi", "ts", "lat", "lon")
    return B.min_length(hourly, "mmsi", more_than=7).select("mmsi", "window_start", "n_points")


# ================================================================ B ======
@register("keep_columns")
def q_keep_columns(spark, sf_dir):
    return B.keep_columns(S.vessel_positions(spark, sf_dir), "ts", "mmsi", "lat", "lon")


@register("column_range_features")
def q_column_range_features(spark, sf_dir):
    """B2: lineitem columns 4..7 (inclusive) next to the order key."""
    li = S.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *B.column_range(li, 4, 7).columns)


@register("geo_outlier_filter")
def q_geo_outlier_filter(spark, sf_dir):
    return _filtered_positions(spark, sf_dir).select("event_id", "mmsi", "lat", "lon")


@register("index_range_split")
def q_index_range_split(spark, sf_dir):
    """First 80% of the conversation id range is train, the rest validation."""
    conv = S.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    hi = F.floor(conv.select(F.max("conv_id")).scalar() * 0.8)
    return splits.index_split(conv, "conv_id", hi)


@register("index_range")
def q_index_range(spark, sf_dir):
    """The conversations with ids in the middle half of the id range, inclusive."""
    conv = S.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    hi = conv.agg(F.max("conv_id")).first()[0] or 0
    return B.index_range(conv, "conv_id", hi // 4, 3 * hi // 4)


# ================================================================ C ======
@register("minmax_normalize")
def q_minmax_normalize(spark, sf_dir):
    pos = _filtered_positions(spark, sf_dir)
    return pos.select("event_id", C.minmax("lat", -90, 90).alias("lat_n"),
                      C.minmax("lon", -180, 180).alias("lon_n"))


@register("number_to_string")
def q_number_to_string(spark, sf_dir):
    pos = _filtered_positions(spark, sf_dir)
    return pos.select("event_id", C.to_text(C.minmax("lat", -90, 90)).alias("lat_text"),
                      C.to_text(C.minmax("lon", -180, 180)).alias("lon_text"))


@register("parse_timestamp")
def q_parse_timestamp(spark, sf_dir):
    """Render event times as day/month/year text, parse back to epoch ms."""
    ev = S.table(spark, sf_dir, "events")
    txt = F.date_format(F.col("ts"), "dd/MM/yyyy HH:mm:ss")
    return ev.select("event_id", txt.alias("ts_text"), C.parse_time_millis(txt).alias("ts_ms"))


@register("concat_columns")
def q_concat_columns(spark, sf_dir):
    pos = _filtered_positions(spark, sf_dir)
    return pos.select("event_id", C.concat_text(",", C.to_text(C.minmax("lat", -90, 90)),
                                                C.to_text(C.minmax("lon", -180, 180))).alias("latlon"))


@register("split_to_doubles")
def q_split_to_doubles(spark, sf_dir):
    pos = _filtered_positions(spark, sf_dir)
    txt = C.concat_text(",", C.to_text("lat"), C.to_text("lon"))
    arr = C.split_doubles(txt, ",", arity=2)
    return pos.select("event_id", arr.getItem(0).alias("a"), arr.getItem(1).alias("b"))


@register("geo_to_xyz")
def q_geo_to_xyz(spark, sf_dir):
    pos = _filtered_positions(spark, sf_dir)
    x, y, z = C.geo_xyz("lat", "lon")
    la, lo = C.xyz_geo(x, y, z)
    # "+ 0.0" turns a rounded -0.0 into 0.0 (engines differ in keeping the sign)
    return pos.select("event_id", (F.round(x, 9) + 0.0).alias("x"), (F.round(y, 9) + 0.0).alias("y"),
                      (F.round(z, 9) + 0.0).alias("z"), (F.round(la, 6) + 0.0).alias("lat_back"),
                      (F.round(lo, 6) + 0.0).alias("lon_back"))


@register("one_hot")
def q_one_hot(spark, sf_dir):
    lab = S.table(spark, sf_dir, "labels")
    return lab.select("doc_id", F.posexplode(C.one_hot("quality", 2)).alias("cls", "v")) \
        .select("doc_id", F.col("cls").cast("int").alias("cls"), "v")


@register("argmax")
def q_argmax(spark, sf_dir):
    cs = S.class_scores(spark, sf_dir)
    return cs.select("id", "y", C.argmax("scores").alias("yhat"))


@register("step_slice")
def q_step_slice(spark, sf_dir):
    steps = S.conversation_steps(spark, sf_dir)
    return B.step_slice(steps, "step", 2, 5).select("seq_id", "step", "value")


@register("reshape_grid")
def q_reshape_grid(spark, sf_dir):
    """64-vector -> 8 x 8 grid, exploded to (row, col, v); and back."""
    emb = S.table(spark, sf_dir, "embeddings")
    g = emb.select("vec_id", C.to_grid("embedding", 8, 8).alias("g"),
                   (C.from_grid(C.to_grid("embedding", 8, 8)) == F.col("embedding")).alias("round_trip"))
    rows = g.select("vec_id", "round_trip", F.posexplode("g").alias("r", "row"))
    return rows.select("vec_id", "round_trip", F.col("r").cast("int").alias("r"),
                       F.posexplode("row").alias("c", "v")).select(
        "vec_id", "round_trip", "r", F.col("c").cast("int").alias("c"), F.col("v").cast("double").alias("v"))


@register("last_valid_step")
def q_last_valid_step(spark, sf_dir):
    dense = align.align_end(S.conversation_steps(spark, sf_dir), "seq_id", "step", "batch_id", dense=True)
    return B.last_valid_step(dense, "seq_id", "pos", "mask")


# ================================================================ D ======
def zip_readers():
    """The five column groups of the positional-zip stand-in (name, expression)."""
    ev = F.col
    return [
        [("label", (ev("event_type") == "purchase").cast("int")), ("f1", ev("value")),
         ("f2", ev("user_id").cast("double")), ("f3", F.hour("ts").cast("double"))],
        [("f4", ev("value") * 2.0), ("f5", F.minute("ts").cast("double")),
         ("f6", F.second("ts").cast("double"))],
        [("f7", F.length("props").cast("double")), ("f8", F.dayofmonth("ts").cast("double")),
         ("f9", (ev("event_id") % 7).cast("double"))],
        [("f10", F.sqrt("value")), ("f11", F.log1p("value")), ("f12", ev("value") / 10.0)],
        [("f13", (ev("user_id") % 3).cast("double")), ("f14", (ev("user_id") % 5).cast("double")),
         ("f15", (ev("user_id") % 11).cast("double"))],
    ]


def zip_output(z):
    return z.select("row_no", F.col("label").cast("int").alias("label"),
                    *[F.round(f"f{i}", 9).alias(f"f{i}") for i in range(1, 16)])


@register("positional_zip")
def q_positional_zip(spark, sf_dir):
    """Five readers (column groups of events, each numbered on its own)
    zipped by row number."""
    from seqlab.operators.ordering import ordered_index
    ev = S.table(spark, sf_dir, "events")
    readers = [ordered_index(ev.select("event_id", *[e.alias(n) for n, e in cols]), [], ["event_id"],
                             name="row_no").drop("event_id") for cols in zip_readers()]
    return zip_output(align.positional_zip(readers))


def _conv_labels(spark, sf_dir):
    steps = S.conversation_steps(spark, sf_dir)
    return steps.groupBy("seq_id").agg((F.max("step") >= 4).cast("int").alias("label"))


@register("join_features_labels")
def q_join_features_labels(spark, sf_dir):
    return align.join_samples(S.conversation_steps(spark, sf_dir), _conv_labels(spark, sf_dir),
                              on="seq_id").select("seq_id", "step", "value", "label")


@register("align_end")
def q_align_end(spark, sf_dir):
    a = align.align_end(S.conversation_steps(spark, sf_dir), "seq_id", "step", "batch_id")
    return a.select("seq_id", "batch_id", "step", "pos", "value", "mask")


@register("align_end_dense")
def q_align_end_dense(spark, sf_dir):
    return align.align_end(S.conversation_steps(spark, sf_dir), "seq_id", "step", "batch_id",
                           dense=True, value_cols=["value"])


# ================================================================ F, J2 ==
def _recon(spark, sf_dir):
    """J2 input: each embedding against its label centroid (the reconstruction)."""
    emb = S.table(spark, sf_dir, "embeddings")
    cells = emb.select("label", F.posexplode("embedding").alias("i", "v"))
    cent = cells.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    cent = cent.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("xhat"))
    # AQE broadcasts the centroids when their measured size is small, and
    # splits the rows of a hot label otherwise
    j = emb.join(cent, "label")
    return scoring.reconstruction_score(j, "embedding", "xhat").select(
        F.col("vec_id").alias("id"), "label", F.round("score", 6).alias("score"))


@register("reconstruction_score")
def q_reconstruction_score(spark, sf_dir):
    return _recon(spark, sf_dir)


@register("rank_by_label")
def q_rank_by_label(spark, sf_dir):
    return ranking.rank_within(_recon(spark, sf_dir), "label", "score", "id")


def _natural():
    """Numbers in a text compare as numbers, the rest letter by letter."""
    import re

    def compare(a, b):
        x, y = ([(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.findall("[0-9]+|[^0-9]+", v or "")]
                for v in (a[0], b[0]))
        return (x > y) - (x < y)
    return compare


@register("comparator_order")
def q_comparator_order(spark, sf_dir):
    """L3: vessels by the natural order of their ids, given as a comparator."""
    stats = E.sequence_stats(S.vessel_positions(spark, sf_dir).select("mmsi", C.epoch_millis("ts").alias("t")), "mmsi", "t")
    return comparator_order(stats.select("mmsi", "num_positions"), ["mmsi"], _natural())


@register("best_worst_by_label")
def q_best_worst_by_label(spark, sf_dir):
    return ranking.best_worst(_recon(spark, sf_dir), "label", "score", "id", n=5)


# ================================================================ G ======
@register("hash_split")
def q_hash_split(spark, sf_dir):
    traj = hourly_trajectories(S.vessel_positions(spark, sf_dir))
    per = traj.groupBy("mmsi").agg(F.count(F.lit(1)).alias("seq_len"))
    return splits.hash_split(per, "mmsi", 80)


@register("batch_split")
def q_batch_split(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events").select("event_id", "value")
    return splits.mini_batch_split(ev, ["event_id"], 300, 0.8)


@register("mini_batches")
def q_mini_batches(spark, sf_dir):
    emb = S.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return splits.mini_batches(emb, ["vec_id"], 32)


# ================================================================ H ======
def _traj_channels(spark, sf_dir):
    traj = hourly_trajectories(S.vessel_positions(spark, sf_dir))
    return traj.select("mmsi", "step", F.explode(F.array(
        F.struct(F.lit(0).alias("channel"), F.col("lat").alias("value")),
        F.struct(F.lit(1).alias("channel"), F.col("lon").alias("value")))).alias("c")) \
        .select("mmsi", "step", "c.channel", "c.value")


@register("seq2seq_tokens")
def q_seq2seq_tokens(spark, sf_dir):
    return seq2seq.seq2seq(_traj_channels(spark, sf_dir), "mmsi", "step", "channel", "value",
                           n_channels=2)


@register("seq2seq_tokens_all")
def q_seq2seq_tokens_all(spark, sf_dir):
    """H1 with GO at every position of the padded tensor (what the reference does)."""
    return seq2seq.seq2seq(_traj_channels(spark, sf_dir), "mmsi", "step", "channel", "value",
                           n_channels=2, go="all")


@register("batch_transform")
def q_batch_transform(spark, sf_dir):
    """L2: a user's transform over whole batches: each value relative to its
    batch's mean and largest value."""
    def centred(pdf):
        return pdf.assign(centred=pdf["value"] - pdf["value"].mean(), share=pdf["value"] / pdf["value"].max())
    steps = S.conversation_steps(spark, sf_dir)
    out = splits.batch_transform(steps, "batch_id", centred, "seq_id long, step long, value double, batch_id long, "
                                 "centred double, share double")
    return out.select("seq_id", "step", "batch_id", F.round("centred", 6).alias("centred"),
                      F.round("share", 6).alias("share"))


@register("seq2seq_masks")
def q_seq2seq_masks(spark, sf_dir):
    dense = align.align_end(S.conversation_steps(spark, sf_dir), "seq_id", "step", "batch_id",
                            dense=True, value_cols=["value"])
    return seq2seq.extend_mask(dense, "seq_id", "pos", "mask")


# ================================================================ J ======
EMB_WEIGHTS = [((i % 7) - 3) / 10.0 for i in range(64)]


@register("batch_predict")
def q_batch_predict(spark, sf_dir):
    vec = A.scan_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding", "label")
    s = scoring.linear_scores(vec, "features", EMB_WEIGHTS, bias=0.1)
    return s.select("id", F.round("score", 6).alias("score"),
                    (F.col("score") >= 0.5).cast("int").alias("yhat"))


def daily_grid(spark, sf_dir) -> tuple[DataFrame, list[str], int]:
    """Grid series stand-in: per user and day the total value / 100 of each event
    type (one cell per type, by name); missing days are 0. The days run from the
    first to the last one in the table. Returns (grid, cells, number of days)."""
    ev = S.table(spark, sf_dir, "events")
    first, last = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    types = [r[0] for r in ev.where("event_type IS NOT NULL").select("event_type").distinct()
             .orderBy("event_type").collect()]   # the columns of the grid
    days = (last - first).days + 1
    cells = [f"c{i}" for i in range(len(types))]
    day = F.datediff(F.to_date("ts"), F.lit(first)).cast("long")
    sums = ev.groupBy("user_id", day.alias("day")).agg(
        *[F.sum(F.when(F.col("event_type") == t, F.col("value") / 100.0).otherwise(0.0)).alias(c)
          for c, t in zip(cells, types)])
    users = ev.select("user_id").distinct()
    grid = users.select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(days - 1).cast("long"))).alias("day"))
    full = grid.join(sums, ["user_id", "day"], "left")
    return full.select("user_id", "day", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in cells]), cells, days


def warm_days(days: int) -> int:
    """The first two thirds of the days warm a forecast up, the rest is forecast."""
    return days * 2 // 3


AR_A, AR_B = 0.6, 10.0


@register("rollout_forecast")
def q_rollout_forecast(spark, sf_dir):
    """Warm-up on the first two thirds of the days, forecast of the rest, AR(1)
    per cell with fixed weights."""
    import numpy as np
    g, cells, days = daily_grid(spark, sf_dir)
    step = scoring.linear_step(np.eye(len(cells)) * AR_A, np.full(len(cells), AR_B))
    out = scoring.rollout(g, "user_id", "day", cells, step, horizon=days - warm_days(days), offset=1,
                          start=0, length=warm_days(days))
    return out.select("user_id", "k", "cell", F.round("prediction", 6).alias("prediction"))


def grid_truth(grid, cells, days) -> DataFrame:
    """The days after the warm-up as (user_id, k, cell, truth)."""
    warm = warm_days(days)
    return grid.where(F.col("day") >= warm).select(
        "user_id", (F.col("day") - warm).alias("k"),
        F.posexplode(F.array(*cells)).alias("cell", "truth"))


# ================================================================ K ======
@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    cs = S.class_scores(spark, sf_dir).select("y", C.argmax("scores").alias("yhat"))
    return K.confusion(cs, "y", "yhat")


@register("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    cs = S.class_scores(spark, sf_dir).select("y", C.argmax("scores").alias("yhat"))
    return K.classification_metrics(cs, "y", "yhat")


@register("auc_exact")
def q_auc_exact(spark, sf_dir):
    return K.auc_exact(S.multitarget_scores(spark, sf_dir), by=["target"])


@register("roc_thresholded")
def q_roc_thresholded(spark, sf_dir):
    return K.roc_thresholded(S.binary_scores(spark, sf_dir))


@register("auc_thresholded")
def q_auc_thresholded(spark, sf_dir):
    return K.auc_thresholded(S.multitarget_scores(spark, sf_dir), by=["target"])


@register("auc_one_vs_all")
def q_auc_one_vs_all(spark, sf_dir):
    return K.auc_one_vs_all(S.class_scores(spark, sf_dir), "y", "scores")


def _event_scores(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("y"),
                     F.least(F.lit(1.0), F.col("value") / 300.0).alias("score"))


@register("running_auc")
def q_running_auc(spark, sf_dir):
    """K6: cumulative thresholded AUC after each batch of 32 events."""
    b = splits.mini_batches(_event_scores(spark, sf_dir), ["event_id"], 32)
    return K.running_auc(b, "batch_id", "y", "score")


def _conv_targets(spark, sf_dir):
    """Per-step binary targets on end-aligned, padded conversations."""
    conv = S.table(spark, sf_dir, "conversations")
    steps = conv.select(F.col("conv_id").alias("seq_id"), F.col("turn").alias("step"),
                        (F.col("role") == "assistant").cast("int").alias("y1"),
                        (F.length("text") > 500).cast("int").alias("y2"),
                        F.least(F.lit(1.0), F.length("text") / 2000.0).alias("score"),
                        F.floor(F.col("conv_id") / 32).cast("long").alias("batch_id"))
    dense = align.align_end(steps, "seq_id", "step", "batch_id", dense=True,
                            value_cols=["y1", "y2", "score"])
    return dense.select("seq_id", "pos", "mask", F.explode(F.array(
        F.struct(F.lit("y1").alias("target"), F.col("y1").alias("y")),
        F.struct(F.lit("y2").alias("target"), F.col("y2").alias("y")))).alias("t"), "score") \
        .select("seq_id", "pos", "mask", "t.target", "t.y", "score")


@register("timeseries_auc")
def q_timeseries_auc(spark, sf_dir):
    """K7: both targets evaluated, padded steps dropped."""
    return K.timeseries_auc(_conv_targets(spark, sf_dir), by=["target"])


@register("timeseries_auc_padded")
def q_timeseries_auc_padded(spark, sf_dir):
    """K7 with the reference's unmasked evaluation (padding counts as negatives)."""
    return K.timeseries_auc(_conv_targets(spark, sf_dir), include_padding=True, by=["target"])


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    return K.regression_metrics(S.regression_pairs(spark, sf_dir))


@register("forecast_metrics")
def q_forecast_metrics(spark, sf_dir):
    """J3 + K8: rollout predictions against the days after the warm-up, per cell."""
    j = q_rollout_forecast(spark, sf_dir).join(grid_truth(*daily_grid(spark, sf_dir)), ["user_id", "k", "cell"])
    return K.regression_metrics(j, "cell", "truth", "prediction")


# ================================================================ L ======
@register("user_reducer_geo_average")
def q_user_reducer_geo_average(spark, sf_dir):
    """L1: the geo average written as a user accept/combine/get reducer,
    run as map-side partial states + per-key combine (reference geo mode)."""
    from seqlab.functions.reducers import geo_average_reducer, reduce_by_key
    pos = _filtered_positions(spark, sf_dir).select(
        "mmsi", C.minmax("lat", -90, 90).alias("lat"), C.minmax("lon", -180, 180).alias("lon"))
    return reduce_by_key(pos, ["mmsi"], ["lat", "lon"], geo_average_reducer())


# ======================================================== many chunks ==
# The same queries with every ordered numbering cut into many more chunks
# than the data needs, so that keys that continue from chunk to chunk are
# checked against the same SQL.
def _split_variant(name: str, base):
    def q(spark, sf_dir):
        conf = "spark.sql.shuffle.partitions"
        old = spark.conf.get(conf)
        spark.conf.set(conf, "23")
        try:
            return base(spark, sf_dir)
        finally:
            spark.conf.set(conf, old)
    q.__name__ = f"q_{name}"
    q.__doc__ = f"{base.__name__} with every ordered numbering cut into 23 chunks."
    return register(name)(q)


for _n, _b in [("to_sequences_split", q_to_sequences), ("rank_by_label_split", q_rank_by_label),
               ("mini_batches_split", q_mini_batches), ("auc_exact_split", q_auc_exact),
               ("running_auc_split", q_running_auc)]:
    _split_variant(_n, _b)
