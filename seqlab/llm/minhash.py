"""Near-duplicates by improved consistent weighted sampling.

Documents are sets of shingles of five words, weighted by TF-IDF:
``(1 + ln tf) * (1 + idf / ln(n + 1))`` with ``idf = ln((n + 1) / (df + 1))``.
Document frequencies are counted over all documents in a hashed feature space
of ``2**BUCKETS`` buckets (the hashing trick: a bucket's count bounds the
frequency of each of its shingles from above); its size does not follow the
corpus, and neither do the weights of rare and of common shingles.

A signature holds one consistent weighted sample per hash function; two
documents agree in one with a probability equal to their weighted Jaccard
similarity. ``BANDS`` bands of ``ROWS`` samples select candidates, and the
weighted Jaccard similarity of whole texts decides.

Equal texts are one node. In a bucket every node is compared with the node that
meets most others (a leader), not all with all. Where several components still
meet, an exact bound comes first: a pair of similarity s shares at least
``s / (1 + s)`` of its summed weight, and what a node can share with any other is
the weight of its shingles that some other open node holds too. Nodes and pairs
below the bound are settled; a second leader, now the node with the smallest
share of its own shingles, joins most of the rest; what is left is compared
pairwise across components, each pair once. So no link between components is
lost, and a group of copies costs comparisons in proportion to its size unless
its members are neither alike nor told apart by the bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import saved, text_slices
from seqlab.llm.components import connected_components
from seqlab.llm.hashing import Roller, groups_of_size, join_bytes, mix

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
BUCKETS = 18
PARTS = 64
SLACK = 1e-6   # for rounding of the weights
_TABLE = 1 << 16
_SLICE = 1 << 20


class Shingler:
    """Distinct shingles of texts and how often each occurs."""

    def __init__(self, words: int = WORDS):
        self.words, self.by_byte, self.by_word = words, Roller(11), Roller(12)
        letter = np.zeros(256, bool)
        letter[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
        self.letter = letter

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text a run of shingle hashes (ascending) and counts; ``starts``
        has one more entry than texts. A text of fewer words than a shingle has
        one shingle, a text without words none."""
        data, begin = join_bytes([t.lower().encode("utf-8") for t in texts])
        inside = np.concatenate([[False], self.letter[data], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edge[::2], edge[1::2]
        h = self.by_byte.spans(self.by_byte.prefix(data), first, last)
        word_at = np.searchsorted(first, begin)          # first word of each text
        n = np.diff(word_at)
        p = self.by_word.prefix(h)
        grams = self.by_word.grams(p, self.words)
        doc = np.repeat(np.arange(len(texts)), n)
        whole = np.flatnonzero(doc[:len(grams)] == doc[self.words - 1:self.words - 1 + len(grams)])
        few = np.flatnonzero((n > 0) & (n < self.words))
        grams = np.concatenate([grams[whole], self.by_word.spans(p, word_at[few], word_at[few + 1])])
        doc = np.concatenate([doc[whole], few])
        order = np.lexsort((grams, doc))
        grams, doc = grams[order], doc[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.concatenate([at, [len(grams)]]))
        starts = np.searchsorted(doc[at], np.arange(len(texts) + 1))
        return starts, grams[at], count


class Weigher(Shingler):
    """Shingles with their TF-IDF weights."""

    def __init__(self, idf: np.ndarray, words: int = WORDS):
        super().__init__(words)
        self.idf = idf

    def weights(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, h, n = self(texts)
        w = self.idf[h >> np.uint64(64 - BUCKETS)] * (1 + np.log(n)).astype(np.float32)
        return starts, h, w.astype(np.float32)


class Sampler:
    """Consistent weighted samples. The random draws of a (shingle, function)
    pair come from a fixed table, at an index hashed from the pair."""

    def __init__(self, functions: int):
        rng = np.random.default_rng(2010)
        self.r = rng.gamma(2, 1, _TABLE).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, _TABLE)).astype(np.float32)
        self.beta = rng.random(_TABLE, np.float32)
        self.factors = rng.integers(1, 1 << 63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, starts: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """One row of sample hashes per text that has shingles."""
        full = np.flatnonzero(np.diff(starts))
        at, n = starts[full], np.diff(starts)[full]
        out = np.zeros((len(full), len(self.factors)), np.uint64)
        log_w = np.log(w)
        group = np.repeat(np.arange(len(full)), n)
        for k, factor in enumerate(self.factors):
            i = ((h * factor) >> np.uint64(48)).astype(np.intp)
            r, beta = self.r[i], self.beta[i]
            t = np.floor(log_w / r + beta)
            cost = self.log_c[i] - r * (t - beta + 1)
            best = np.minimum.reduceat(cost, at)
            hit = np.flatnonzero(cost == best[group])
            # equal costs within a text: the smallest hash, rows being sorted by it
            hit = hit[np.concatenate([[True], np.diff(group[hit]) > 0])]
            out[:, k] = mix(h[hit] + t[hit].astype(np.int64).astype(np.uint64) * factor)
        return out


def _count_buckets(batches):
    """How many documents of this task hold each bucket's shingles."""
    shingles, counts, width = Shingler(), np.zeros(1 << BUCKETS, np.int64), (1 << BUCKETS) // PARTS
    for part in text_slices(batches, column=0, max_bytes=_SLICE):
        h = shingles(part.column(0).to_pylist())[1]
        counts += np.bincount((h >> np.uint64(64 - BUCKETS)).astype(np.intp), minlength=1 << BUCKETS)
    used = [i for i in range(PARTS) if counts[i * width:(i + 1) * width].any()]
    yield pa.RecordBatch.from_pydict({
        "part": pa.array(used, pa.int32()),
        "counts": pa.array([counts[i * width:(i + 1) * width].tobytes() for i in used], pa.binary())})


def _add_counts(rows):
    total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
    return rows.iloc[:1].assign(counts=[total.tobytes()])


def idf_table(texts: DataFrame) -> np.ndarray:
    """Weight factor per bucket from all documents (2**BUCKETS numbers)."""
    n = texts.count()
    parts = texts.mapInArrow(_count_buckets, "part int, counts binary").groupBy("part").applyInPandas(
        _add_counts, "part int, counts binary").collect()   # PARTS rows of fixed size
    width = (1 << BUCKETS) // PARTS
    df = np.zeros(1 << BUCKETS)
    for r in parts:
        df[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(r["counts"], np.int64)
    return (1 + np.maximum(0, np.log((n + 1) / (df + 1))) / np.log(n + 2)).astype(np.float32)


def _signatures(idf):
    def run(batches):
        weigh, sample = Weigher(idf.value), Sampler(BANDS * ROWS)
        band_seed = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for part in text_slices(batches, max_bytes=_SLICE):
            starts, h, w = weigh.weights(part.column(1).to_pylist())
            full = np.flatnonzero(np.diff(starts))
            if not len(full):
                continue
            s = sample(starts, h, w).reshape(len(full), BANDS, ROWS)
            key = band_seed[None, :]
            for j in range(ROWS):
                key = mix(key * np.uint64(31) + s[:, :, j])
            total = np.add.reduceat(w.astype(np.float64), starts[full])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(full)), pa.array(total),
                 pa.FixedSizeListArray.from_arrays(pa.array(key.view(np.int64).ravel()), BANDS).cast(
                     pa.list_(pa.int64()))], ["node", "total", "keys"])
    return run


def _verify(idf, similarity):
    def run(batches):
        weigh = Weigher(idf.value)
        for batch in batches:
            lengths = pa.compute.add(pa.compute.binary_length(batch.column(2)),
                                     pa.compute.binary_length(batch.column(3))).to_pylist()
            for i, j in groups_of_size(lengths, _SLICE):
                part = batch.slice(i, j - i)
                at: dict[str, int] = {}
                pairs = [tuple(at.setdefault(t, len(at)) for t in p)
                         for p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                starts, h, w = weigh.weights(list(at))
                keep = []
                for x, y in pairs:
                    hx, hy = h[starts[x]:starts[x + 1]], h[starts[y]:starts[y + 1]]
                    wx, wy = w[starts[x]:starts[x + 1]].astype(np.float64), w[starts[y]:starts[y + 1]].astype(np.float64)
                    k = np.minimum(np.searchsorted(hy, hx), max(len(hy) - 1, 0))
                    same = hy[k] == hx if len(hy) else np.zeros(len(hx), bool)
                    common = np.minimum(wx[same], wy[k[same]]).sum()
                    union = wx.sum() + wy.sum() - common
                    keep.append(union > 0 and common >= similarity * union)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep))
    return run


def _weights_of(idf):
    def run(batches):
        weigh = Weigher(idf.value)
        for part in text_slices(batches, max_bytes=_SLICE):
            starts, h, w = weigh.weights(part.column(1).to_pylist())
            row = np.repeat(np.arange(part.num_rows), np.diff(starts))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array(h.view(np.int64)), pa.array(w.astype(np.float64))],
                ["node", "shingle", "weight"])
    return run


def _shared_weight(texts: DataFrame, idf) -> DataFrame:
    """``node, shared``: the weight of a node's shingles that another of ``texts`` holds."""
    rows = texts.select("node", "text").mapInArrow(_weights_of(idf), "node string, shingle long, weight double")
    held = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(held, "shingle").groupBy("node").agg(F.sum("weight").alias("shared"))


def _linked(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_verify(idf, similarity), "a string, b string")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """``id, node, class_id, class_node, kept`` for every row of ``docs``.

    ``node`` is the digest of the row's text, ``class_id`` the smallest id of
    its class and ``class_node`` the node of that document. ``kept`` marks rows
    of that id and node. Null texts count as empty; texts without words are
    near-duplicates of equal texts only; texts of fewer than five words have
    one shingle. Null ids come after all others. Repeated rows are all
    returned (and all kept or not); an empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.md5(F.encode("text", "UTF-8")).alias("node"), "text")
    idf = spark.sparkContext.broadcast(idf_table(rows.select("text")))   # one number per bucket
    signed = saved(rows.select("node", "text").mapInArrow(
        _signatures(idf), "node string, total double, keys array<long>").dropDuplicates(["node"]), "minhash-signatures")
    bands = signed.select("node", "total", F.posexplode("keys").alias("band", "key"))

    bucket = ["band", "key"]
    shared = bands.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = bands.join(shared, bucket)
    degree = live.groupBy("node").agg(F.sum("n").alias("degree"))
    live = saved(live.join(degree, "node").select("node", "total", *bucket, "degree"), "minhash-live")
    one = rows.groupBy("node").agg(F.first("text").alias("text"))
    texts = saved(one.join(live.select("node").distinct(), "node", "left_semi"), "minhash-texts")

    def alike(a, b, share_a=None, share_b=None):
        close = F.least(a, b) >= similarity * F.greatest(a, b) - SLACK
        if share_a is None:
            return close
        return close & (F.least(share_a, share_b) >= similarity / (1 + similarity) * (a + b) - SLACK)

    def led(rows, best, condition):
        """Every other node of a bucket with the leader ``best``."""
        leader = rows.groupBy(*bucket).agg(F.max(F.struct(*best, "node", *condition)).alias("lead"))
        return rows.join(leader, bucket).where("node <> lead.node")

    def open_buckets(rows, component):
        """The rows of buckets in which several components meet."""
        rows = rows.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = rows.groupBy(*bucket).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        return rows.join(mixed, bucket, "left_semi")

    def verified(pairs):
        return saved(_linked(pairs.distinct(), texts, idf, similarity), "minhash-links")

    # a leader per bucket; it has met everyone there and leaves
    rest = led(live, ["degree"], ["total"])
    links = verified(rest.where(alike(F.col("total"), F.col("lead.total"))).select(
        F.col("lead.node").alias("a"), F.col("node").alias("b")))
    component = saved(connected_components(links), "minhash-components")
    rest = saved(open_buckets(rest.select("node", "total", *bucket), component).drop("component"), "minhash-open")

    # the bound, then a second leader: the node with least of its own
    open_texts = texts.join(rest.select("node").distinct(), "node", "left_semi")
    share = saved(_shared_weight(open_texts, idf), "minhash-shares")
    rest = rest.join(share, "node").where(F.col("shared") >= similarity * F.col("total") - SLACK)
    rest = saved(open_buckets(rest, component).withColumn("own", F.round(F.col("shared") / F.col("total"), 2))
                 .drop("component"), "minhash-open")
    size = ["total", "shared"]
    second = led(rest, ["own"], size)
    links = links.union(verified(second.where(alike(
        F.col("total"), F.col("lead.total"), F.col("shared"), F.col("lead.shared"))).select(
        F.col("lead.node").alias("a"), F.col("node").alias("b"))))
    component = saved(connected_components(links), "minhash-components")

    # pairs across the components that still meet, each in the first band it shares
    last = open_buckets(second.select("node", *size, *bucket), component).join(
        signed.select("node", "keys"), "node")
    a, b = last.alias("a"), last.alias("b")
    first = F.array_position(F.zip_with("a.keys", "b.keys", lambda x, y: x == y), True) == F.col("a.band") + 1
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
                   & alike(F.col("a.total"), F.col("b.total"), F.col("a.shared"), F.col("b.shared")) & first)
    links = links.union(verified(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))))
    component = saved(connected_components(links), "minhash-components")

    held = rows.select("id", "node")
    placed = held.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = placed.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "node")).alias("f"))
    placed = placed.join(first, "component").select(
        "id", "node", F.col("f.id").alias("class_id"), F.col("f.node").alias("class_node"))
    return placed.withColumn("kept", F.col("id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node")))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, with its columns: that of the smallest id."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select("id", "node").distinct()
    keyed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__node": F.md5(F.encode(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8"))})
    kept = kept.select(F.col("id").alias("__kept_id"), F.col("node").alias("__kept_node"))
    match = F.col("__id").eqNullSafe(F.col("__kept_id")) & (F.col("__node") == F.col("__kept_node"))
    return keyed.join(kept, match, "left_semi").dropDuplicates(["__id", "__node"]).select(*docs.columns)
