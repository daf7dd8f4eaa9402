"""Evaluation as DataFrame queries (K1-K8).

Every metric is an aggregate: partial aggregation runs before each
exchange, curves are arrays of 101 counters per group, running sums go
through the skew-safe ordered prefix, and nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.operators.ordering import ordered_prefix, ordered_sums

_G = "__grp"


def _by(df: DataFrame, by) -> tuple[DataFrame, list[str]]:
    by = list(by or [])
    if by:
        return df, by
    return df.withColumn(_G, F.lit(0)), [_G]


def _drop_g(df: DataFrame) -> DataFrame:
    return df.drop(_G) if _G in df.columns else df


# --------------------------------------------------------------- K1 ------
def confusion(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Counts per (truth, predicted)."""
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(
        F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- K2 ------
def classification_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Accuracy and macro precision / recall / F1 over the classes seen in
    truth or prediction. A class with no predictions has no precision and a
    class with no truth rows has no recall; such classes are skipped in the
    macro mean (not counted as 0)."""
    conf = confusion(df, y, yhat)
    truth = conf.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("actual"))
    pred = conf.groupBy(F.col("yhat").alias("cls")).agg(F.sum("n").alias("predicted"))
    tp = conf.where(F.col("y") == F.col("yhat")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    per = truth.join(pred, "cls", "full").join(tp, "cls", "left").select(
        "cls",
        F.coalesce("actual", F.lit(0)).alias("actual"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"),
        F.coalesce("tp", F.lit(0)).alias("tp"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted"))
    rec = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual"))
    per = per.select("*", prec.alias("precision"), rec.alias("recall"))
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    per = per.withColumn("f1", F.when(F.col("precision").isNotNull() & F.col("recall").isNotNull(),
                                      F.coalesce(f1, F.lit(0.0))))
    return per.agg(
        F.round(F.sum("tp") / F.sum("actual"), 6).alias("accuracy"),
        F.round(F.avg("precision"), 6).alias("precision"),
        F.round(F.avg("recall"), 6).alias("recall"),
        F.round(F.avg("f1"), 6).alias("f1"),
        F.sum("actual").cast("long").alias("n"),
    )


# --------------------------------------------------------------- K3 ------
def auc_exact(df: DataFrame, y: str = "y", score: str = "score", by=()) -> DataFrame:
    """Exact ROC AUC (Mann-Whitney, ties count half) per group.

    Rows are first reduced to distinct (group, score) with positive and
    negative counts (map-side combine), then the negatives below each score
    come from the skew-safe ordered prefix. NULL when a group has one class.
    """
    src, keys = _by(_scored(df, y, score), by)
    per_score = src.groupBy(*keys, F.col(score).alias("__s")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("double").alias("__pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("double").alias("__neg"))
    pref = ordered_prefix(per_score, keys, ["__s"], {"__neg_lt": "__neg"})
    res = pref.groupBy(*keys).agg(
        F.sum(F.col("__pos") * (F.col("__neg_lt") + 0.5 * F.col("__neg"))).alias("__u"),
        F.sum("__pos").alias("n_pos"), F.sum("__neg").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.round(F.col("__u") / (F.col("n_pos") * F.col("n_neg")), 6))
    return _drop_g(res.select(*keys, auc.alias("auc"),
                              F.col("n_pos").cast("long").alias("n_pos"),
                              F.col("n_neg").cast("long").alias("n_neg")))


# --------------------------------------------------------------- K4 ------
def threshold_bin(score, steps: int = 100) -> Column:
    """Largest k in 0..steps with score >= k/steps (-1 below 0). The product
    score*steps may round to either side of k, so k is corrected by comparing
    the score with the thresholds themselves."""
    s = F.col(score) if isinstance(score, str) else score
    k0 = F.floor(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)) * steps).cast("int")
    k = F.when(s >= (k0 + 1) / F.lit(float(steps)), k0 + 1).when(
        s < k0 / F.lit(float(steps)), k0 - 1).otherwise(k0)
    return F.when(s < 0, F.lit(-1)).otherwise(F.least(k, F.lit(int(steps))))


def _scored(df: DataFrame, y: str, score: str) -> DataFrame:
    """Rows with a label and a score; NaN scores are dropped like NULL ones."""
    return df.where(F.col(score).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def _histogram(df: DataFrame, y: str, score: str, keys: list[str], steps: int) -> DataFrame:
    return _scored(df, y, score).groupBy(*keys, threshold_bin(score, steps).alias("__bin")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("long").alias("__pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("long").alias("__neg"))


def _counters(hist: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """One row per group: ``tp`` and ``fp`` (arrays: rows at score >= k/steps, k =
    0..steps) and the totals ``p``, ``n`` (which include scores below 0)."""
    cells = hist.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("__bin", F.struct("__pos", "__neg")))).alias("c"),  # steps + 2
        F.sum("__pos").alias("p"), F.sum("__neg").alias("n"))

    def from_the_top(field):
        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out"))

        def step(acc, k):
            total = acc["sum"] + F.coalesce(F.try_element_at(F.col("c"), k)[field], F.lit(0).cast("long"))
            return F.struct(total.alias("sum"), F.array_append(acc["out"], total).alias("out"))
        return F.reverse(F.aggregate(F.sequence(F.lit(int(steps)), F.lit(0), F.lit(-1)), zero, step,
                                     lambda acc: acc["out"]))

    return cells.select(*keys, from_the_top("__pos").alias("tp"), from_the_top("__neg").alias("fp"), "p", "n")


def _roc_rows(counters: DataFrame, keys: list[str], steps: int) -> DataFrame:
    rows = counters.select(*keys, "p", "n", F.posexplode(F.arrays_zip("tp", "fp")).alias("k", "c"))
    return rows.select(*keys, (F.col("k") / F.lit(float(steps))).alias("threshold"), F.col("c.tp").alias("tp"),
                       F.col("c.fp").alias("fp"), F.when(F.col("p") > 0, F.col("c.tp") / F.col("p")).alias("tpr"),
                       F.when(F.col("n") > 0, F.col("c.fp") / F.col("n")).alias("fpr"))


def roc_thresholded(df: DataFrame, y: str = "y", score: str = "score", steps: int = 100,
                    by=()) -> DataFrame:
    """TPR/FPR at score >= i/steps, i = 0..steps (steps+1 rows per group)."""
    src, keys = _by(df, by)
    roc = _roc_rows(_counters(_histogram(src, y, score, keys, steps), keys, steps), keys, steps)
    return _drop_g(roc.select(*keys, F.round("threshold", 6).alias("threshold"), "tp", "fp",
                              F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr")))


def _area(counters: DataFrame, keys: list[str]) -> DataFrame:
    """Trapezoid area under the thresholded curve, closed at (0, 0)."""
    closed = lambda c: F.concat(c, F.array(F.lit(0).cast("long")))
    parts = F.zip_with(
        F.zip_with(F.col("fp"), F.slice(closed(F.col("fp")), 2, F.size("fp")), lambda a, b: a - b),
        F.zip_with(F.col("tp"), F.slice(closed(F.col("tp")), 2, F.size("tp")), lambda a, b: a + b),
        lambda d, s: d.cast("double") * s.cast("double"))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return counters.select(*keys, F.when(both, F.round(
        total / (2.0 * F.col("p").cast("double") * F.col("n").cast("double")), 6)).alias("auc"))


def auc_thresholded(df: DataFrame, y: str = "y", score: str = "score", steps: int = 100,
                    by=()) -> DataFrame:
    """Trapezoid area under the thresholded ROC, closed at (0, 0)."""
    src, keys = _by(df, by)
    return _drop_g(_area(_counters(_histogram(src, y, score, keys, steps), keys, steps), keys))


# --------------------------------------------------------------- K5 ------
def auc_one_vs_all(df: DataFrame, y: str = "y", scores: str = "scores") -> DataFrame:
    """Per class c: exact AUC of scores[c] for (y == c) against the rest."""
    long = df.select(F.col(y).alias("__y"), F.posexplode(scores).alias("cls", "__sc"))
    long = long.select("cls", (F.col("__y") == F.col("cls")).cast("int").alias("__t"), "__sc")
    return auc_exact(long, "__t", "__sc", by=["cls"]).select(
        F.col("cls").cast("int").alias("cls"), "auc", "n_pos", "n_neg")


# --------------------------------------------------------------- K6 ------
def running_auc(df: DataFrame, batch: str = "batch_id", y: str = "y", score: str = "score",
                steps: int = 100) -> DataFrame:
    """Thresholded AUC over all rows of batches <= b, for every batch b.

    Each batch is reduced to one row of counters (rows at or above each
    threshold); the counters are summed up along the batches by the ordered
    prefix, which cuts the batches into chunks and carries one row of totals
    from chunk to chunk. Linear in rows; no prefix self-join.
    """
    k = int(steps) + 1
    own = _counters(_histogram(df, y, score, [batch], steps), [batch], steps)
    own = own.select(batch, F.concat("tp", "fp", F.array("p", "n")).cast("array<double>").alias("__own"))
    summed = ordered_sums(own, [], [batch], F.col("__own"), "__before")
    upto = F.zip_with("__before", "__own", lambda a, b: (a + b).cast("long"))
    cum = summed.select(batch, upto.alias("__c")).select(
        batch, F.slice("__c", 1, k).alias("tp"), F.slice("__c", k + 1, k).alias("fp"),
        F.col("__c")[2 * k].alias("p"), F.col("__c")[2 * k + 1].alias("n"))
    return _area(cum, [batch]).select(F.col(batch).cast("long").alias(batch), "auc")


# --------------------------------------------------------------- K7 ------
def timeseries_auc(df: DataFrame, y: str = "y", score: str = "score", mask: str = "mask",
                   include_padding: bool = False, by=(), exact: bool = True,
                   steps: int = 100) -> DataFrame:
    """Flattened (sample, step) evaluation; padded steps (mask 0) are dropped
    unless ``include_padding`` reproduces the reference's unmasked call."""
    src = df if include_padding else df.where(F.col(mask) == 1)
    if exact:
        return auc_exact(src, y, score, by=by)
    return auc_thresholded(src, y, score, steps, by=by)


# --------------------------------------------------------------- K8 ------
def regression_metrics(df: DataFrame, col: str = "col", truth: str = "truth",
                       pred: str = "prediction") -> DataFrame:
    """Per output column: MSE, MAE, RMSE, RSE, Pearson correlation, R2.
    RSE = SSE / SST and R2 = 1 - RSE; both NULL for a constant truth."""
    t, p = F.col(truth), F.col(pred)
    err = t - p
    agg = df.groupBy(col).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("__mse"),
        F.avg(F.abs(err)).alias("__mae"),
        F.sum(err * err).alias("__sse"),
        (F.var_pop(t) * F.count(t)).alias("__sst"),
        # corr() raises on a zero variance under ANSI mode; Pearson from
        # covariance and standard deviations with a NULL-on-zero division
        F.try_divide(F.covar_pop(t, p), F.stddev_pop(t) * F.stddev_pop(p)).alias("__corr"))
    rse = F.when(F.col("__sst") > 0, F.col("__sse") / F.col("__sst"))
    return agg.select(
        F.col(col), F.col("n").cast("long").alias("n"),
        F.round("__mse", 6).alias("mse"), F.round("__mae", 6).alias("mae"),
        F.round(F.sqrt("__mse"), 6).alias("rmse"), F.round(rse, 6).alias("rse"),
        F.round(F.when(F.col("__sst") > 0, F.col("__corr")), 6).alias("correlation"),
        F.round(1 - rse, 6).alias("r2"))
