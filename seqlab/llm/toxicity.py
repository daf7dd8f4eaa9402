"""Toxicity scores: boosted trees over dense text features, isotonic calibration.

A fixed seed lexicon knows common English insults; everything else is learned
from labelled rows: whole words and word stems (prefixes of 3 to 7 letters)
whose share of toxic documents is significantly above the base rate (a
log-likelihood ratio above the logarithm of the number of features tested).
Labelled rows get lexicon weights from the other folds only, so that the trees
see the densities an unseen document would have. Two folds fit the trees, the
third fits the isotonic calibration.

Fitting uses at most ``sample_rows`` labelled rows (those with the smallest id
hashes); scoring reads every whole text. Only texts are inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import release_memory, saved, text_slices

# fixed values: seed lexicon and second-person words
SEED = frozenset("""
    arsehole asshole bastard bitch braindead brainless clown coward cretin crap cunt despicable dick
    dickhead dimwit dipshit disgrace disgusting douche dumb dumbass dunce fatso filth filthy fool freak
    fuck fucker fucking garbage gross hate idiot idiotic ignorant imbecile jackass jerk kill lame liar
    loathsome loser lunatic maggot moron moronic nasty nitwit parasite pathetic pig prick psycho punk rat
    repulsive retard revolting savage scum scumbag shameful shit shitty sicko sleazy slob slut stupid
    sucker swine thug trash twat twit ugly useless vermin vile wanker weakling whore wimp worthless wretch
""".split())
YOU = frozenset("""you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine
    deinen deiner euch euer ihr sie usted ustedes ti tuyo vosotros os vuestro""".split())
FEATURES = ("log_words", "seed_density", "stem_density", "stem_best", "stem_mass", "stem_count", "you_density",
            "you_near", "capitals", "shouted", "punctuation", "exclamations", "obfuscated", "symbols",
            "revealed", "stretched")
FOLDS = 3
SAMPLE_ROWS = 12_000
LEXICON_ROWS = 5_000
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W_]+")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")
_MIXED = re.compile(r"\b[A-Za-z]+[0-9@$*!|+][A-Za-z0-9@$*!|+]*[A-Za-z]\b|\b[A-Za-z](?:[.\-_*][A-Za-z]){3,}\b")
_STRETCHED = re.compile(r"([a-z])\1{2,}")
_LEET = str.maketrans("013457@$!|+", "oieastasiit")
_SPLIT = re.compile(r"[.\-_*]")
_CACHE = 300_000


def word_features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in range(3, min(8, len(word))))]


def held_out(id_col: str) -> Column:
    """The rows whose labels may not be learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


class Featurizer:
    """Dense features of a text under lexicon weights {feature: weight}."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.cache = weights, {}

    def _weight(self, word: str) -> float:
        w = max((self.weights.get(f, 0.0) for f in word_features(word)), default=0.0) if self.weights else 0.0
        if len(self.cache) >= _CACHE:
            self.cache.clear()
        self.cache[word] = w
        return w

    def __call__(self, text: str) -> list[float]:
        lower = text.lower()
        words = _WORD.findall(lower)
        n = len(words)
        if not n:
            return [0.0] * len(FEATURES)
        get, weight = self.cache.get, self._weight
        found = [w if (w := get(x)) is not None else weight(x) for x in words]
        seeds = [i for i, x in enumerate(words) if x in SEED]
        stems = [i for i, w in enumerate(found) if w]
        you = [i for i, x in enumerate(words) if x in YOU]
        hits = sorted({*seeds, *stems})
        near = 0
        if hits and you:
            at = np.searchsorted(you, hits)
            near = sum(1 for i, h in zip(at, hits) if (i < len(you) and you[i] - h <= 5)
                       or (i > 0 and h - you[i - 1] <= 5))
        data = np.bincount(np.frombuffer(text.encode("utf-8"), np.uint8), minlength=256)
        size = max(1, int(data.sum()))
        letters = max(1, int(data[65:91].sum() + data[97:123].sum()))
        marks = int(data[33:48].sum() + data[58:65].sum() + data[91:97].sum() + data[123:127].sum())
        plain = int(data[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
        mixed = _MIXED.findall(text)
        revealed = 0
        for m in mixed:
            shown = _SPLIT.sub("", m).lower().translate(_LEET)
            revealed += shown in SEED or bool(self.weights and weight(shown))
        per = 100.0 / n
        mass = sum(found[i] for i in stems)
        return [math.log1p(n), len(seeds) * per, len(stems) * per, max(found), mass * per, math.log1p(len(hits)),
                len(you) * per, near / len(hits) if hits else 0.0, int(data[65:91].sum()) / letters,
                len(_SHOUT.findall(text)) * per, marks / size, int(data[33]) / size, len(mixed) * per,
                (marks - plain) / size, revealed * per, len(_STRETCHED.findall(lower)) * per]


def _count_features(batches):
    """Documents holding each feature, per fold: what a slice of rows adds."""
    for part in text_slices(batches, column=2):
        n, toxic = Counter(), Counter()
        for fold, y, text in zip(*(part.column(c).to_pylist() for c in range(3))):
            for f in {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}:
                n[f, fold] += 1
                toxic[f, fold] += y
        yield pa.RecordBatch.from_pydict({
            "feature": [f for f, _ in n], "fold": pa.array([k for _, k in n], pa.int32()),
            "n": pa.array(list(n.values()), pa.int64()), "toxic": pa.array([toxic[k] for k in n], pa.int64())})


def _learn_lexicons(sample: DataFrame, lexicon_rows: int) -> dict[int, dict[str, float]]:
    """Weights per left-out fold (-1: none left out), at most ``lexicon_rows`` features."""
    sizes = {r["fold"]: (r["n"], r["y"]) for r in sample.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).collect()}
    counted = sample.select("fold", "y", "text").mapInArrow(
        _count_features, "feature string, fold int, n long, toxic long")
    counted = counted.groupBy("feature").agg(*[
        F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}")
        for k in range(FOLDS) for c in ("n", "toxic")])
    frequent = saved(counted.where(" + ".join(f"n{k}" for k in range(FOLDS)) + " >= 3"), "toxic-features")
    least = math.log(max(2, frequent.count()))
    scores, cols = [], []
    for out in (-1, *range(FOLDS)):
        folds = [k for k in range(FOLDS) if k != out]
        rows, toxic = (sum(sizes.get(k, (0, 0))[i] for k in folds) for i in (0, 1))
        p = min(max(toxic / max(rows, 1), 1e-6), 1 - 1e-6)
        n, y = (sum((F.col(f"{c}{k}") for k in folds), F.lit(0.0)) for c in ("n", "toxic"))
        q = F.least(F.greatest(y / F.greatest(n, F.lit(1.0)), F.lit(1e-9)), F.lit(1 - 1e-9))
        score = F.when(q > p, n * (q * F.log(q / p) + (1 - q) * F.log((1 - q) / (1 - p)))).otherwise(0.0)
        odds = F.log((y + 0.5) / (n - y + 0.5)) - math.log(p / (1 - p))
        scores.append(score)
        cols.append(F.when(score > least, F.least(F.greatest(odds, F.lit(0.0)), F.lit(8.0))).otherwise(0.0)
                    .alias(f"w{out + 1}"))
    kept = frequent.select("feature", F.greatest(*scores).alias("score"), *cols).where(F.col("score") > least)
    lexicons: dict[int, dict[str, float]] = defaultdict(dict)
    for r in kept.orderBy(F.col("score").desc(), "feature").limit(lexicon_rows).collect():
        for out in range(-1, FOLDS):
            if r[f"w{out + 1}"] > 0:
                lexicons[out][r["feature"]] = r[f"w{out + 1}"]
    return lexicons


def _featurize(lexicons: dict[int, dict[str, float]]):
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        release_memory()
        of = {k: Featurizer(lexicons.get(k, {})) for k in range(-1, FOLDS)}
        for texts, out in batches:
            yield pd.Series([of[k](t) for t, k in zip(texts, out)])
        of.clear()
        release_memory()
    return F.pandas_udf(run, "array<double>")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
                   lexicon_rows: int = LEXICON_ROWS) -> DataFrame:
    """``docs`` with ``toxicity double`` (0 to 1) added; all rows and columns stay.

    Labels are learned from rows that are not ``held_out``; of several labels
    of one id the highest counts; null labels and labels without a document
    are ignored. Null and empty texts have all features zero and get a score
    like any other. Repeated rows get equal scores. Without at least five
    training labels of either class nothing is fitted and the score is
    ``1 - exp(-seed_density)``. An empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y"))
    train = docs.where(~held_out(id_col)).select(F.col(id_col).alias("__id"), text.alias("text"))
    ids = train.select("__id").join(known, "__id").select(
        "__id", "y", F.xxhash64(F.lit("sample"), "__id").alias("key")).orderBy("key", "__id").limit(sample_rows)
    sample = saved(train.join(F.broadcast(ids), "__id").select(   # at most sample_rows ids
        F.pmod(F.xxhash64(F.lit("fold"), "__id"), F.lit(FOLDS)).cast("int").alias("fold"), "y", "text"), "toxic-sample")
    classes = {(r["part"], r["y"]): r["n"] for r in sample.groupBy(
        (F.col("fold") == FOLDS - 1).alias("part"), "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    fit = all(classes.get((part, y), 0) >= 5 for part in (False, True) for y in (0, 1))
    lexicons = dict(_learn_lexicons(sample, lexicon_rows)) if fit else {}

    names = docs.columns
    features = _featurize(lexicons)
    scored = docs.withColumn("__features", features(text, F.lit(-1)))
    if not fit:
        return scored.select(*names, (1 - F.exp(-F.col("__features")[1])).alias("toxicity"))
    learn = saved(sample.select("fold", F.col("y").cast("double").alias("y"),
                                features("text", "fold").alias("__features")), "toxic-fit")
    learn = learn.select("fold", "y", array_to_vector("__features").alias("__vector")).coalesce(1)
    trees = GBTClassifier(labelCol="y", featuresCol="__vector", predictionCol="__class",
                          maxIter=12, maxDepth=3, seed=7).fit(learn.where(F.col("fold") != FOLDS - 1))
    trees.setRawPredictionCol("__raw").setProbabilityCol("__p")

    def predicted(df):
        return trees.transform(df).withColumn("__score", vector_to_array("__p")[1])

    steps = IsotonicRegression(labelCol="y", featuresCol="__score", predictionCol="__calibrated").fit(
        predicted(learn.where(F.col("fold") == FOLDS - 1)).select("y", "__score"))
    out = steps.transform(predicted(scored.withColumn("__vector", array_to_vector("__features"))))
    # the trees' own probability orders documents within a step of the calibration
    return out.select(*names, (0.999 * F.col("__calibrated") + 0.001 * F.col("__score")).alias("toxicity"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that score below ``threshold``, with their columns."""
    return score_toxicity(docs, labels, **options).where(F.col("toxicity") < threshold).select(*docs.columns)
