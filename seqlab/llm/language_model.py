"""Language-model scores by deleted interpolation.

The probability of a token mixes the maximum-likelihood estimates of all orders
up to ``order`` and the uniform distribution; the weights depend on the longest
context seen in training and on how often it was seen, in buckets of powers of
two, and are learned by expectation-maximisation.

1. Texts are taken in batches as they are read from a written copy. A batch
   sends the hashes of its distinct n-grams, with how often its training texts
   hold them, to hash ranges; a range adds up the counts of all batches.
2. Each batch gets back the corpus counts of exactly its own n-grams. A frequent
   n-gram is one entry per batch, so no range holds more than its share.
3. Held-out counts: in a fold of the training texts (``tune_every``) each text's
   own occurrences are deleted from the counts. What every order then says about
   each of its tokens is written as a table that grows with the corpus;
   expectation-maximisation aggregates it per bucket until the likelihood
   settles. Only sums per bucket reach the driver.
4. All batches are scored with the weights.

Tokens are runs of bytes other than ASCII white space, A-Z in lower case, and
one end per text; contexts before the first token are padded. N-grams are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import saved, text_slices, work_folder
from seqlab.llm.hashing import mix

ORDER = 2
BATCH_BYTES = 8 << 20
RANGE_BYTES = 32 << 20          # text per hash range
TUNE_EVERY = 10
LEVELS = 40                     # context counts up to 2^40 have buckets of their own
MAX_ITERATIONS, SETTLED = 12, 1e-4
_END, _BEGIN = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_STEP = np.uint64(0xD6E8FEB86659FD93)


# ------------------------------------------------------------ n-grams ----
class Grams:
    """The n-grams of a batch of texts."""

    def __init__(self, texts: pa.Array, order: int):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = lists.flatten()
        doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        words, doc = words.filter(pa.array(real)).dictionary_encode(), doc[real]
        known = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words.dictionary), np.uint64,
                            len(words.dictionary))
        self.lengths = np.bincount(doc, minlength=len(texts)).astype(np.int64) + 1     # with the end
        self.ends = np.cumsum(self.lengths) - 1
        self.first = self.ends - self.lengths + 1
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        token = np.full(len(self.doc), _END, np.uint64)
        inner = np.ones(len(token), bool)
        inner[self.ends] = False
        token[inner] = known[words.indices.to_numpy()] if len(doc) else 0
        self.at_first = np.zeros(len(token), bool)
        self.at_first[self.first] = True
        # hash of the n tokens that end at each position, padded at the beginning
        self.keys, before, context = [mix(token)], token, np.full(len(texts), mix(np.array([_BEGIN]))[0])
        for n in range(2, order + 1):
            last = self.keys[-1]
            left = np.empty_like(last)
            left[1:] = last[:-1]
            left[self.first] = context
            self.keys.append(mix(left * _STEP + token + np.uint64(n)))
            context = mix(context * _STEP + _BEGIN + np.uint64(n))


def _pack(keys: np.ndarray) -> bytes:
    """Ascending keys as byte planes of their differences (high planes are zeros)."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(counts) or counts.max() <= np.iinfo(k).max)
    return kind[-1].encode() + counts.astype(kind).tobytes()


def _unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u" + chr(data[0]), offset=1).astype(np.int64)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Ascending with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


# ------------------------------------------------------------- batches ----
_TEXTS = "batch bigint, ids array<bigint>, train array<boolean>, sizes array<int>, packed binary"


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Numbered batches of (id, text, train, tune) rows, those to tune by with odd
    numbers. The numbers come from the task's partition and place, which are the
    same whenever the written copy is read."""
    first, count = TaskContext.get().partitionId() << 32, 0
    open_parts: dict[bool, list] = {True: [], False: []}
    size = {True: 0, False: 0}

    def close(tune):
        nonlocal count
        table = pa.Table.from_batches(open_parts[tune]).combine_chunks()
        open_parts[tune], size[tune], count = [], 0, count + 1
        return first + 2 * count + tune, table.to_batches()[0]

    for part in text_slices(rows):
        for tune in (False, True):
            mine = part.filter(pc.equal(part.column(3), tune))
            if mine.num_rows:
                open_parts[tune].append(mine)
                size[tune] += pc.sum(pc.binary_length(mine.column(1))).as_py()
                if size[tune] >= BATCH_BYTES:
                    yield close(tune)
    for tune in (False, True):
        if open_parts[tune]:
            yield close(tune)


def _requests(order: int, ranges: int):
    """A batch's distinct n-grams by order and range, with their training counts."""
    def run(rows):
        for number, batch in _batches(rows):
            grams = Grams(batch.column(1), order)
            train = batch.column(2).to_numpy(zero_copy_only=False)[grams.doc]
            out = []
            for n, keys in enumerate(grams.keys, 1):
                by_key = np.argsort(keys, kind="stable")
                ordered = keys[by_key]
                new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                counts = np.add.reduceat(train[by_key].astype(np.int64), new)
                distinct = ordered[new]
                part = _range_of(distinct, ranges)
                cuts = np.flatnonzero(np.concatenate([[True], np.diff(part) != 0]))
                for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(distinct)]):
                    out.append((n, int(part[a]), number, _pack(distinct[a:z]), _pack_counts(counts[a:z])))
            for i in range(0, len(out), 64):
                n, part, batch_no, keys, counts = zip(*out[i:i + 64])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n, pa.int32()), pa.array(part, pa.int64()), pa.array(batch_no, pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                    names=["n", "part", "batch", "keys", "counts"])
    return run


def _count(table: pa.Table) -> pa.Table:
    """All requests of a range -> its corpus counts for each batch; the row without
    a batch holds the types and tokens of the range's training counts."""
    table = table.sort_by("batch")
    keys = [_unpack(k) for k in table["keys"].to_pylist()]
    sizes = np.cumsum([len(k) for k in keys])[:-1]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, np.concatenate([_unpack_counts(c) for c in table["counts"].to_pylist()]))
    answers = [_pack_counts(total[a]) for a in np.split(at, sizes)]
    n, part, more = table["n"][0].as_py(), table["part"][0].as_py(), len(answers) + 1
    return pa.table({"batch": pa.array([*table["batch"].to_pylist(), None], pa.int64()),
                     "n": pa.array([n] * more, pa.int32()), "part": pa.array([part] * more, pa.int64()),
                     "counts": pa.array([*answers, None], pa.binary()),
                     "types": pa.array([None] * (more - 1) + [int((total > 0).sum())], pa.int64()),
                     "tokens": pa.array([None] * (more - 1) + [int(total.sum())], pa.int64())})


def _packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, batch in _batches(rows):
        ids, texts, train, _ = batch.columns
        sizes = pc.binary_length(texts).cast(pa.int32())
        raw = b"".join(t.as_buffer() for t in texts)
        packed = pa.py_buffer(len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True))
        one = pa.array([0, batch.num_rows], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, train),
             pa.ListArray.from_arrays(one, sizes), pa.array([packed.to_pybytes()], pa.binary())],
            names=["batch", "ids", "train", "sizes", "packed"])


def _unpacked(table: pa.Table):
    """(ids, train, texts) of a batch."""
    ids, train, sizes = (table[c].combine_chunks().flatten() for c in ("ids", "train", "sizes"))
    data = table["packed"][0].as_py()
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd")
    offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(), dtype=np.int64)])
    texts = pa.Array.from_buffers(pa.large_string(), len(ids), [None, pa.py_buffer(offsets), raw])
    return ids, train.to_numpy(zero_copy_only=False), texts


# ---------------------------------------------------------- estimates ----
class Counted:
    """A batch's n-grams with the corpus counts that came back."""

    def __init__(self, texts: pa.Array, answers: pa.Table, order: int):
        self.grams = Grams(texts, order)
        answers = answers.sort_by([("n", "ascending"), ("part", "ascending")])
        numbers = answers["n"].to_numpy()
        self.at, self.counts = [], []
        for n, keys in enumerate(self.grams.keys, 1):
            distinct, at = np.unique(keys, return_inverse=True)
            parts = [_unpack_counts(c) for c, k in zip(answers["counts"].to_pylist(), numbers) if k == n]
            counts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            if len(counts) != len(distinct):
                raise ValueError("a batch was read differently than when its n-grams were counted")
            self.at.append(at)
            self.counts.append(counts[at])

    def own(self) -> list[np.ndarray]:
        """Occurrences of each n-gram within its own text."""
        out = []
        for at in self.at:
            pair = self.grams.doc * (int(at.max()) + 1) + at
            _, of, many = np.unique(pair, return_inverse=True, return_counts=True)
            out.append(many[of])
        return out


def estimates(grams: Grams, counts: list[np.ndarray], tokens: np.ndarray | int, texts: np.ndarray | int
              ) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, maximum-likelihood estimates by order) of every token, given the
    counts of its n-grams and of all training tokens and texts. The bucket is
    ``m * LEVELS`` plus the level of the context's count, for the highest order
    ``m`` whose context occurs (0 if nothing does)."""
    size = len(grams.doc)
    bucket, out = np.zeros(size, np.int32), np.zeros((size, len(counts)))
    for n, count in enumerate(counts, 1):
        if n == 1:
            context = np.broadcast_to(tokens, size)
        else:
            context = np.empty(size, np.int64)
            context[1:] = counts[n - 2][:-1]
            context[grams.at_first] = np.broadcast_to(texts, size)[grams.at_first]
        seen = context > 0
        out[seen, n - 1] = count[seen] / context[seen]
        level = np.frexp(np.maximum(context, 1).astype(float))[1] - 1
        bucket[seen] = (n * LEVELS + np.minimum(level if n > 1 else 0, LEVELS - 1) * np.ones(size, int))[seen]
    return bucket, out


def _events(order: int, tokens: int, texts: int):
    """Bucket and estimates of every token of the texts to tune by, each text
    deleted from the counts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, strings = _unpacked(left)
        counted = Counted(strings, right, order)
        grams = counted.grams
        counts = [c - own for c, own in zip(counted.counts, counted.own())]
        bucket, ml = estimates(grams, counts, tokens - grams.lengths[grams.doc], texts - 1)
        return pa.table({"bucket": pa.array(bucket), **{f"f{n}": pa.array(ml[:, n - 1].astype(np.float32))
                                                        for n in range(1, order + 1)}})
    return run


def fit_weights(events: DataFrame, order: int, uniform: float) -> np.ndarray:
    """Weights by bucket (rows) of the uniform distribution and the orders, by
    expectation-maximisation over ``events`` (``bucket, f1, ...``). Each
    component that a bucket has counts half an event more; a bucket without
    events weighs its components alike."""
    highest = np.arange((order + 1) * LEVELS) // LEVELS
    defined = np.arange(order + 1)[None] <= highest[:, None]
    weights = defined / defined.sum(axis=1, keepdims=True)
    before = None
    for _ in range(MAX_ITERATIONS):
        of = [F.get(F.split(F.lit(",".join(map(repr, weights[:, n].tolist()))), ",").cast("array<double>"), F.col("bucket"))
              for n in range(order + 1)]
        parts = [of[0] * F.lit(uniform)] + [of[n] * F.col(f"f{n}").cast("double") for n in range(1, order + 1)]
        total = sum(parts[1:], parts[0])
        sums = events.withColumns({"__t": total, **{f"__p{n}": p for n, p in enumerate(parts)}}).groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.log("__t")).alias("likelihood"),
            *[F.sum(F.col(f"__p{n}") / F.col("__t")).alias(f"s{n}") for n in range(order + 1)]).collect()   # per bucket
        if not sums:
            return weights
        shares = np.zeros_like(weights)
        for r in sums:
            shares[r["bucket"]] = [r[f"s{n}"] for n in range(order + 1)]
        shares = np.where(defined, shares + 0.5, 0)
        weights = shares / shares.sum(axis=1, keepdims=True)
        likelihood, n = sum(r["likelihood"] for r in sums), sum(r["n"] for r in sums)
        if before is not None and likelihood - before < SETTLED * n:
            break
        before = likelihood
    return weights


_SCORES = ("id bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def _scores(order: int, tokens: int, types: int, texts: int, weights: np.ndarray):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, train, strings = _unpacked(left)
        counted = Counted(strings, right, order)
        grams = counted.grams
        bucket, ml = estimates(grams, counted.counts, tokens, texts)
        weight = weights[bucket]
        chance = weight[:, 0] / (types + 1) + (weight[:, 1:] * ml).sum(axis=1)
        base = (counted.counts[0] + 0.5) / (tokens + 0.5 * (types + 1))
        add = lambda x: np.add.reduceat(x, grams.first)
        return pa.table({"id": ids, "train": pa.array(train), "n_tokens": pa.array(grams.lengths),
                         "n_known": pa.array(add((counted.counts[0] > 0).astype(np.int64))),
                         "base_score": pa.array(add(np.log10(base))), "score": pa.array(add(np.log10(chance)))})
    return run


def score_texts(docs: DataFrame, train: Column, tune: Column, id_col: str = "doc_id", text_col: str = "text",
                order: int = ORDER) -> tuple[DataFrame, dict]:
    """(``id, train, n_tokens, n_known, base_score, score`` per row, the model).

    Learns from the rows for which ``train`` is true and tunes its weights by
    those of them for which ``tune`` is. ``score`` is the log10 probability of
    the text, ``base_score`` that of an add-half unigram model, ``n_known`` the
    tokens that occur in training. A null or blank text is one end token; rows
    of one id, and equal rows, count each; null conditions count as false.
    Without training rows every probability is one. The model holds ``tokens,
    types, texts`` (of training) and ``weights``. An empty table gives no rows.
    Other columns are neither read nor returned.
    """
    spark = docs.sparkSession
    train = F.coalesce(train, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), train.alias("train"),
                       (train & F.coalesce(tune, F.lit(False))).alias("tune"))
    path = work_folder(spark, "lm-texts")
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    size, texts = rows.agg(F.sum(F.octet_length("text").cast("long")), F.count_if("train")).first()
    ranges = max(1, -(-(size or 0) // RANGE_BYTES))
    asked = rows.mapInArrow(_requests(order, ranges), "n int, part bigint, batch bigint, keys binary, counts binary")
    answers = saved(asked.groupBy("n", "part").applyInArrow(
        _count, "batch bigint, n int, part bigint, counts binary, types bigint, tokens bigint"), "lm-counts")
    types, tokens = answers.where("batch is null and n = 1").agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = types or 0, tokens or 0
    answers = answers.where("batch is not null").select("batch", "n", "part", "counts")

    def with_answers(some: DataFrame, condition: str, fn, schema: str) -> DataFrame:
        packed = some.mapInArrow(_packed, _TEXTS).where(condition)
        return packed.groupBy("batch").cogroup(answers.where(condition).groupBy("batch")).applyInArrow(fn, schema)

    fields = ", ".join(["bucket int", *[f"f{n} float" for n in range(1, order + 1)]])
    events = saved(with_answers(rows, "batch % 2 = 1", _events(order, tokens, texts), fields), "lm-events")
    weights = fit_weights(events, order, 1 / (types + 1))
    scored = with_answers(rows, "batch is not null", _scores(order, tokens, types, texts, weights), _SCORES)
    return scored, {"tokens": tokens, "types": types, "texts": texts, "weights": weights}


def fold(id_col: str, of: int, skip: int = 1) -> Column:
    """Remainder of ``crc32(id as text) div skip`` by ``of`` (a null id: empty text)."""
    number = F.crc32(F.encode(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), "UTF-8"))
    return F.floor(number / skip) % of
