"""Registered queries for the model tasks (I1-I7) and their scoring.

Fits are Spark ML jobs over whole tables. Solver output cannot be written in
SQL. The ``train_*`` queries fit on the training rows, score the held-out ones
and return what SQL can state about them: the rows scored, their labels, and
whether the model does better than an answer that ignores the features. The
queries of values return classes, probabilities, losses and metrics for the
tables' own labels; tests replay the fitted coefficients on them.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seqlab.operators import evaluation as K
from seqlab.operators import models as M
from seqlab.operators import ranking, scoring, splits
from seqlab.operators.bottleneck import bottleneck_errors, principal_directions
from seqlab.operators.kept_state import advance, forecast, save_states, smoothing_step
from seqlab.operators.recurrence import decayed_features, last_states
from seqlab.operators.stencil import fit_stencil, patch_gram, stencil_step
from seqlab.plans import standins as S
from seqlab.session import saved
from seqlab.sources.readers import scratch_path
from seqlab.plans.queries import daily_grid, grid_truth, q_positional_zip, register, warm_days


def _log_loss(probabilities, y) -> Column:
    """Negative log probability of the true class, bounded away from infinity."""
    return -F.log(F.greatest(F.get(probabilities, y), F.lit(1e-15)))


def _with_verdict(scored: DataFrame, train: DataFrame, y: str = "y") -> DataFrame:
    """``scored`` (with ``loss``) and ``beats_frequencies``: the mean log loss is
    below that of giving every row the label frequencies of ``train`` (two small
    aggregates). Holds for any number of rows, also of one label."""
    freq = train.groupBy(F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    total = freq.agg(F.sum("n")).first()[0] or 1
    prior = freq.select("y", (-F.log(F.col("n") / total)).alias("prior"))      # one row per label
    means = scored.join(F.broadcast(prior), "y", "left").agg(
        F.avg("loss"), F.avg(F.coalesce("prior", -F.log(F.lit(1e-15))))).first()
    return scored.withColumn("beats_frequencies", F.lit(means[0] is None or bool(means[0] < means[1])))


def _held_out(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    parts = splits.hash_split(df, key, 80)
    return parts.where("split = 'train'").drop("split"), parts.where("split = 'test'").drop("split")


def _losses(model, df: DataFrame, features) -> DataFrame:
    """J1 with ``yhat``, ``scores`` (probabilities by class) and ``loss``."""
    out = M.predict_classes(model, df, features).withColumn("scores", vector_to_array("probability"))
    return out.withColumn("loss", _log_loss(F.col("scores"), F.col("y").cast("int")))


def _vectors(spark, sf_dir) -> DataFrame:
    """All 64 cells; the class is the sign pattern of the first two."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    return S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), x.alias("x"),
        ((F.col("embedding")[0] > 0).cast("int") + 2 * (F.col("embedding")[1] > 0).cast("int")).alias("y"))


@register("train_vector_classifier")
def q_train_vector_classifier(spark, sf_dir):
    """I1 + J1: MLP 64-16-4 fitted on 80% of the vectors (by id hash), scored on the rest."""
    train, test = _held_out(_vectors(spark, sf_dir), "id")
    model = M.fit_vector_classifier(train, "x", "y", 4, hidden=16, seed=123, max_iter=20)
    return _with_verdict(_losses(model, test, "x").select("id", "y", "loss"), train).drop("loss")


@register("train_fused_classifier")
def q_train_fused_classifier(spark, sf_dir):
    """Five zipped readers (15 features) -> MLP 15-8-2; the class is the half
    of the day."""
    z = saved(q_positional_zip(spark, sf_dir).withColumn("y", (F.col("f3") >= 12).cast("int")), "fused")
    feats = [f"f{i}" for i in range(1, 16)]
    train, test = _held_out(z, "row_no")
    model = M.fit_fused_classifier(train, feats, "y", hidden=8, seed=123, max_iter=60)
    return _with_verdict(_losses(model, test, feats).select("row_no", "y", "loss"), train).drop("loss")


def _conv_steps(spark, sf_dir):
    conv = S.table(spark, sf_dir, "conversations")
    return conv.select(F.col("conv_id").alias("seq_id"), F.col("turn").alias("step"),
                       (F.length("text") / 1000.0).alias("value"),
                       F.regexp_count("text", F.lit(" ")).cast("double").alias("blanks"),
                       (F.col("role") == "assistant").cast("double").alias("assistant"),
                       (F.length("text") > 500).cast("int").alias("y1"),
                       (F.col("turn") >= 2).cast("int").alias("y2"))


@register("train_sequence_classifier")
def q_train_sequence_classifier(spark, sf_dir):
    """Summaries of three features per sequence -> logistic regression (label:
    5 or more turns)."""
    steps = _conv_steps(spark, sf_dir)
    feats = M.sequence_features(steps, "seq_id", "step", ["value", "blanks", "assistant"])
    lab = steps.groupBy("seq_id").agg((F.max("step") >= 4).cast("int").alias("y"))
    cols = [c for c in feats.columns if c != "seq_id"]
    train, test = _held_out(feats.join(lab, "seq_id"), "seq_id")
    model = M.fit_sequence_classifier(train, "y", cols)
    return _with_verdict(_losses(model, test, cols).select("seq_id", "y", "loss"), train).drop("loss")


@register("train_multitask")
def q_train_multitask(spark, sf_dir):
    """I4: trailing-frame features of every column per step, one classifier per
    target; exact AUC of both targets on the held-out sequences (K7)."""
    steps = _conv_steps(spark, sf_dir)
    values = ["value", "blanks", "assistant"]
    feats = M.trailing_features(steps, "seq_id", "step", values)
    cols = values + [f"{c}_{k}" for c in values for k in ("mean", "rms")] + ["step_f"]
    train, test = _held_out(feats, "seq_id")
    models = M.fit_multitask(train, cols, ["y1", "y2"])
    scored = test
    for t, m in models.items():
        scored = m.transform(M.as_vector(scored, cols)).drop("features_vec").withColumn(
            f"{t}_p", F.element_at(vector_to_array(f"{t}_prob"), 2))
    long = scored.select("seq_id", "step", F.explode(F.array(
        F.struct(F.lit("y1").alias("target"), F.col("y1").alias("y"), F.col("y1_p").alias("score")),
        F.struct(F.lit("y2").alias("target"), F.col("y2").alias("y"), F.col("y2_p").alias("score")),
    )).alias("t")).select("seq_id", "step", "t.*")
    return K.auc_exact(long, "y", "score", by=["target"]).select(
        "target", "n_pos", "n_neg", (F.col("auc") > 0.8).alias("beats_chance"))


@register("train_reconstruction")
def q_train_reconstruction(spark, sf_dir):
    """I5 + J2: PCA(10) bottleneck over all vectors; per vector, whether its
    reconstruction is closer to it than the mean vector is."""
    emb = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("x"), "label")
    models = M.fit_reconstruction(emb, "x", k=10)
    scored = M.reconstruction_errors(models, emb, "x")
    centred = vector_to_array("centered")
    around_mean = F.aggregate(centred, F.lit(0.0), lambda s, v: s + v * v) / F.size(centred)
    return scored.select("id", "label", (F.col("score") <= around_mean + 1e-9).alias("closer_than_mean"))


def _pairs(spark, sf_dir):
    grid, cells, _ = daily_grid(spark, sf_dir)
    return M.lagged_pairs(grid, "user_id", "day", cells), cells


@register("forecaster_gram")
def q_forecaster_gram(spark, sf_dir):
    """I6 sufficient statistics: mean X'X and X'Y over all (day, next day) pairs."""
    g = M.gram_means(*_pairs(spark, sf_dir))
    return g.select("kind", F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"),
                    F.round("value", 6).alias("value"))


@register("train_forecaster")
def q_train_forecaster(spark, sf_dir):
    """I6 + J3 + K8: fit on the first two thirds of the days, warm up on them, roll
    out the rest; per cell, rows forecast and whether the error stays within 10%
    of that of the true mean (the days are independent draws)."""
    grid, cells, days = daily_grid(spark, sf_dir)
    warm = warm_days(days)
    train = grid.where(F.col("day") < warm)
    weights, bias = M.fit_forecaster(M.lagged_pairs(train, "user_id", "day", cells), cells)
    fc = scoring.rollout(grid, "user_id", "day", cells, scoring.linear_step(weights, bias),
                         horizon=days - warm, offset=1, start=0, length=warm)
    joined = fc.join(grid_truth(grid, cells, days), ["user_id", "k", "cell"])
    return K.regression_metrics(joined, "cell", "truth", "prediction").select(
        "cell", "n", (F.col("rse") <= 1.1).alias("near_mean"))


def _grid_pairs(spark, sf_dir) -> DataFrame:
    """Embeddings as 8 x 8 grids in id order: a grid and the next one."""
    emb = S.table(spark, sf_dir, "embeddings")
    x = F.transform("embedding", lambda v: v.cast("double"))
    return emb.select("vec_id", x.alias("x")).join(emb.select((F.col("vec_id") - 1).alias("vec_id"), x.alias("y")), "vec_id")


@register("stencil_gram")
def q_stencil_gram(spark, sf_dir):
    """I6 with neighbourhoods: mean products of the 3x3 patches (and a constant)
    with each other and with the next value, over all cells of all grids."""
    g = patch_gram(_grid_pairs(spark, sf_dir), "x", "y", 8, 8)
    return g.select("kind", "i", "j", F.round("value", 6).alias("value"))


@register("train_stencil_forecaster")
def q_train_stencil_forecaster(spark, sf_dir):
    """I6 + J3 + K8 with a shared 3x3 stencil: fitted on 80% of the grid pairs (by
    id hash), one step forecast on the rest, errors per cell."""
    train, test = _held_out(_grid_pairs(spark, sf_dir), "vec_id")
    stencil, bias = fit_stencil(train, "x", "y", 8, 8)
    cells = [f"c{i}" for i in range(64)]
    grids = test.select("vec_id", F.lit(0).alias("step"), *[F.col("x")[i].alias(c) for i, c in enumerate(cells)])
    fc = scoring.rollout(grids, "vec_id", "step", cells, stencil_step(stencil, bias, 8, 8), horizon=1, offset=0)
    truth = test.select("vec_id", F.posexplode("y").alias("cell", "truth"))
    return K.regression_metrics(fc.join(truth, ["vec_id", "cell"]), "cell", "truth", "prediction")


RATES = [2 / 3, 6 / 7]


def _recurrent(spark, sf_dir) -> DataFrame:
    steps = _conv_steps(spark, sf_dir)
    return decayed_features(steps, "seq_id", "step", ["value", "blanks"], RATES,
                            gate=F.least(F.lit(1.0), F.col("value") / 1.001))


@register("recurrent_state")
def q_recurrent_state(spark, sf_dir):
    """Recurrent state per step of two values, at two fixed rates and with a
    gate that opens with the text's length."""
    out = _recurrent(spark, sf_dir)
    return out.select("seq_id", "step", *[F.round(f"{v}_{k}", 6).alias(f"{v}_{k}")
                                          for v in ("value", "blanks") for k in ("r0", "r1", "gate")])


@register("train_recurrent_classifier")
def q_train_recurrent_classifier(spark, sf_dir):
    """I3 on recurrent state: the last step's state per sequence -> logistic
    regression, labelled by whether the last turn is the assistant's; class and
    probability of the held-out sequences."""
    feats = _recurrent(spark, sf_dir)
    cols = [f"{v}_{k}" for v in ("value", "blanks") for k in ("r0", "r1", "gate")]
    last = last_states(feats, "seq_id", "step", [*cols, "assistant"])
    data = last.withColumn("y", F.col("assistant").cast("int"))
    train, test = _held_out(data, "seq_id")
    model = M.fit_sequence_classifier(train, "y", cols)
    return M.predict_classes(model, test, cols).select("seq_id", "y", "yhat", "p1")


SMOOTHING = (0.8, 0.9, 1.5)


@register("rollout_resumed")
def q_rollout_resumed(spark, sf_dir):
    """J3 with kept state: half of the warm-up, its states saved, the whole warm-up
    fed to them again (what they have seen is skipped), saved, and forecast."""
    grid, cells, days = daily_grid(spark, sf_dir)
    warm, step = warm_days(days), smoothing_step(*SMOOTHING)
    path = scratch_path(spark, "rollout-states")
    feed = lambda until, kept: advance(grid.where(F.col("day") < until), "user_id", "day", cells, step, kept)
    half = save_states(feed(warm // 2, None), path, 1)
    whole = save_states(feed(warm, half), path, 2)
    return forecast(whole, "user_id", step, days - warm).select(
        "user_id", "k", "cell", F.round("prediction", 6).alias("prediction"))


@register("score_history")
def q_score_history(spark, sf_dir):
    """The objective per iteration of a multinomial logistic regression never
    rises, falls in all, and stays within the iterations asked for."""
    model = M.fit_vector_classifier(_vectors(spark, sf_dir), "x", "y", 4, hidden=None, max_iter=20)
    loss = [v for _, v in M.score_history(model, every=1)]
    n = S.table(spark, sf_dir, "embeddings").agg(F.count(F.lit(1)).alias("rows"))
    return n.select("rows", F.lit(all(b <= a + 1e-12 for a, b in zip(loss, loss[1:]))).alias("never_rises"),
                    F.lit(loss[-1] < loss[0]).alias("falls"), F.lit(1 < len(loss) <= 21).alias("within_limit"))


# ------------------------------------------ values of the models ----
def _labelled_vectors(spark, sf_dir) -> DataFrame:
    x = F.transform("embedding", lambda v: v.cast("double"))
    return S.table(spark, sf_dir, "embeddings").where("label IS NOT NULL").select(
        F.col("vec_id").alias("id"), x.alias("x"), F.col("label").cast("int").alias("y"))


@register("vector_classifier_scores")
def q_vector_classifier_scores(spark, sf_dir):
    """I1 + J1 with the table's own labels: class, its probability and log loss of
    every held-out vector."""
    data = _labelled_vectors(spark, sf_dir)
    train, test = _held_out(data, "id")
    classes = (data.agg(F.max("y")).first()[0] or 0) + 1
    model = M.fit_vector_classifier(train, "x", "y", classes, hidden=None, max_iter=40)
    return _losses(model, test, "x").select("id", "y", "yhat", F.array_max("scores").alias("p"), "loss")


@register("vector_classifier_report")
def q_vector_classifier_report(spark, sf_dir):
    """I1 + K2 + K5: accuracy, macro precision, recall and F1 of the held-out
    vectors, and the one-vs-all AUC of each class."""
    data = _labelled_vectors(spark, sf_dir)
    train, test = _held_out(data, "id")
    classes = (data.agg(F.max("y")).first()[0] or 0) + 1
    model = M.fit_vector_classifier(train, "x", "y", classes, hidden=None, max_iter=40)
    scored = saved(_losses(model, test, "x").select("id", "y", "yhat", "scores"), "report")
    metrics = K.classification_metrics(scored)
    long = metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                              for c in metrics.columns])).alias("m")).select("m.*")
    auc = K.auc_one_vs_all(scored, "y", "scores")
    return long.unionByName(auc.select(F.concat(F.lit("auc_"), F.col("cls").cast("string")).alias("metric"),
                                       F.col("auc").alias("value")))


@register("fused_classifier_scores")
def q_fused_classifier_scores(spark, sf_dir):
    """I2 + J1: five zipped readers -> MLP 15-8-2 for the reader's own label (a
    purchase); class and probability of every held-out row."""
    z = saved(q_positional_zip(spark, sf_dir).withColumnRenamed("label", "y"), "fused")
    feats = [f"f{i}" for i in range(1, 16)]
    train, test = _held_out(z, "row_no")
    model = M.fit_fused_classifier(train, feats, "y", hidden=8, seed=123, max_iter=40)
    return _losses(model, test, feats).select("row_no", "y", "yhat", "p1", "loss")


def _next_turns(spark, sf_dir) -> DataFrame:
    """Steps with two targets that are no features: whether the assistant speaks
    next, and whether the conversation ends here."""
    nxt = Window.partitionBy("seq_id").orderBy("step")      # turns of one conversation
    steps = _conv_steps(spark, sf_dir).drop("y1", "y2")
    after = F.lead("assistant").over(nxt)
    return steps.withColumns({"y1": F.coalesce(after, F.lit(0.0)).cast("int"), "y2": after.isNull().cast("int")})


@register("multitask_scores")
def q_multitask_scores(spark, sf_dir):
    """I4 + J1 + K7: one classifier per target over trailing and recurrent features;
    probability of every step of the held-out sequences, per target."""
    steps, values = _next_turns(spark, sf_dir), ["value", "blanks", "assistant"]
    feats = M.trailing_features(steps, "seq_id", "step", values)
    feats = decayed_features(feats, "seq_id", "step", values, RATES)
    cols = values + [f"{c}_{k}" for c in values for k in ("mean", "rms", "r0", "r1")] + ["step_f"]
    train, test = _held_out(feats, "seq_id")
    models = M.fit_multitask(train, cols, ["y1", "y2"])
    scored = M.as_vector(test, cols)
    for t, m in models.items():
        scored = m.transform(scored).withColumn(f"{t}_p", F.element_at(vector_to_array(f"{t}_prob"), 2))
    return scored.select("seq_id", "step", F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).alias("y"), F.col(f"{t}_p").alias("p1")) for t in models
    ])).alias("t")).select("seq_id", "step", "t.*")


@register("multitask_auc")
def q_multitask_auc(spark, sf_dir):
    """I4 + K3: exact AUC of both targets on the held-out sequences."""
    return K.auc_exact(q_multitask_scores(spark, sf_dir), "y", "p1", by=["target"])


@register("reconstruction_errors")
def q_reconstruction_errors(spark, sf_dir):
    """I5 + J2: mean squared error of every vector against its reconstruction from
    ten components, and that against the mean vector."""
    emb = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("x"), "label")
    scored = M.reconstruction_errors(M.fit_reconstruction(emb, "x", k=10), emb, "x")
    centred = vector_to_array("centered")
    around_mean = F.aggregate(centred, F.lit(0.0), lambda t, v: t + v * v) / F.size(centred)
    return scored.select("id", "label", "score", around_mean.alias("around_mean"))


@register("bottleneck_errors")
def q_bottleneck_errors(spark, sf_dir):
    """I5 + J2 by the range finder: mean squared error of every vector against its
    reconstruction from ten components."""
    emb = S.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    mean, components, _ = principal_directions(emb, "embedding", k=10)
    return bottleneck_errors(emb, "embedding", mean, components).select(F.col("vec_id").alias("id"), "label", "score")


@register("forecaster_errors")
def q_forecaster_errors(spark, sf_dir):
    """I6 + J3 + K8: the fitted forecaster's regression metrics per cell."""
    grid, cells, days = daily_grid(spark, sf_dir)
    warm = warm_days(days)
    weights, bias = M.fit_forecaster(M.lagged_pairs(grid.where(F.col("day") < warm), "user_id", "day", cells), cells)
    fc = scoring.rollout(grid, "user_id", "day", cells, scoring.linear_step(weights, bias),
                         horizon=days - warm, offset=1, start=0, length=warm)
    return K.regression_metrics(fc.join(grid_truth(grid, cells, days), ["user_id", "k", "cell"]), "cell", "truth", "prediction")


@register("loss_history")
def q_loss_history(spark, sf_dir):
    """The objective of the vector classifier at every iteration."""
    data = _labelled_vectors(spark, sf_dir)
    classes = (data.agg(F.max("y")).first()[0] or 0) + 1
    model = M.fit_vector_classifier(data, "x", "y", classes, hidden=None, max_iter=20)
    return spark.createDataFrame(M.score_history(model, every=1), "iteration int, loss double")   # one row per iteration


@register("anomaly_ranking")
def q_anomaly_ranking(spark, sf_dir):
    """I5 + J2 + F3: reconstruction error per row, best and worst 5 per label."""
    emb = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("x"), "label")
    models = M.fit_reconstruction(emb, "x", k=10)
    scored = M.reconstruction_errors(models, emb, "x").select("id", "label", F.round("score", 6).alias("score"))
    return ranking.best_worst(scored, "label", "score", "id", n=5)
