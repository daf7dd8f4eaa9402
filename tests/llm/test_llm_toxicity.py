import random
import zlib

from llm_data import AWKWARD, docs
from seqlab.llm.toxicity import Featurizer, drop_toxic, held_out, score_toxicity, word_features

WORDS = ["lorem", "ipsum", "dolor", "amet", "sit", "vita", "mundi", "terra", "aqua", "ignis"]


def corpus(n=240):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(30)]
        y = i % 4 == 0
        if y:
            for _ in range(3):   # a stem the seed lexicon does not know, with changing ends
                words.insert(rng.randrange(30), "vequ" + rng.choice(["a", "ta", "ée", "aire"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(y)))
    return rows, labels


def test_learned_stems_separate_held_out_rows(spark):
    rows, labels = corpus()
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    d = docs(spark, rows + AWKWARD[:6])
    out = score_toxicity(d, l)
    assert out.columns == [*d.columns, "toxicity"]
    got = [(r["doc_id"], r["text"], r["toxicity"]) for r in out.collect()]
    assert len(got) == len(rows) + 6 and all(0 <= s <= 1 for _, _, s in got)
    truth = {t: y for (i, t), (_, _, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 3 == 1}
    held = [(truth[t], s) for _, t, s in got if t in truth]
    assert min(s for y, s in held if y) >= 0.7 > max(s for y, s in held if not y)
    kept = drop_toxic(d, l)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] in truth and r["doc_id"] % 4 == 0} == set()


def test_held_out_follows_crc32(spark):
    d = docs(spark, [(i, "") for i in range(50)])
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
               for r in d.select("doc_id", held_out("doc_id").alias("h")).collect())


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(120)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    d = docs(spark, rows)
    a, b = ([r["toxicity"] for r in score_toxicity(d, spark.createDataFrame(
        x, "doc_id long, quality int, toxic int")).orderBy("doc_id").collect()] for x in (labels, flipped))
    assert a == b


def test_without_labels_the_seed_lexicon_scores(spark):
    none = spark.createDataFrame([(None, 1, 1), (900, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["toxicity"] for r in score_toxicity(
        docs(spark, [(1, "you idiot"), (2, "good day"), (3, "")]), none).collect()}
    assert got[1] > 0.7 and got[2] == got[3] == 0.0
    assert score_toxicity(docs(spark, []), none).count() == 0


def test_features():
    f = Featurizer({"vequ*": 3.0})
    names = dict(zip(("log_words", "seed_density", "stem_density", "stem_best"), f("You idiot, vequta!")))
    assert names["seed_density"] > 0 and names["stem_best"] == 3.0
    assert f("")[0] == 0.0 and len(f("x")) == len(f(""))
    assert word_features("vequta") == ["vequta", "veq*", "vequ*", "vequt*"]
