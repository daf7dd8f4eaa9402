import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_data import AWKWARD, docs
from seqlab.llm import language_model as L


def tokens_of(text):
    return (text or "").encode().lower().split() + [None]        # the end


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def grams_of(toks, n):
    padded = [b" begin"] * (n - 1) + toks
    return [tuple(padded[i:i + n]) for i in range(len(toks))]


def said(toks, counts, order, total, texts):
    """Per token (bucket, estimates) given counts by order."""
    out, grams = [], [grams_of(toks, n) for n in range(1, order + 1)]
    for i in range(len(toks)):
        bucket, ml = 0, []
        for n in range(1, order + 1):
            context = total if n == 1 else texts if i == 0 else counts[n - 2][grams[n - 2][i - 1]]
            ml.append(counts[n - 1][grams[n - 1][i]] / context if context else 0.0)
            if context:
                bucket = n * L.LEVELS + (min(context.bit_length() - 1, L.LEVELS - 1) if n > 1 else 0)
        out.append((bucket, ml))
    return out


def brute(rows, order):
    train = [crc(i) % 5 != 1 for i, _ in rows]
    tune = [t and crc(i) // 5 % L.TUNE_EVERY == 0 for (i, _), t in zip(rows, train)]
    toks = [tokens_of(t) for _, t in rows]
    counts = [Counter(g for x, t in zip(toks, train) if t for g in grams_of(x, n)) for n in range(1, order + 1)]
    total, texts, types = sum(counts[0].values()), sum(train), len(counts[0])
    events = []
    for x, t in zip(toks, tune):
        if t:
            less = [c - Counter(grams_of(x, n)) for n, c in enumerate(counts, 1)]
            events += said(x, less, order, total - len(x), texts - 1)
    uniform = 1 / (types + 1)
    weights = {b: [1 / (b // L.LEVELS + 1) if k <= b // L.LEVELS else 0.0 for k in range(order + 1)]
               for b in range((order + 1) * L.LEVELS)}
    before = None
    for _ in range(L.MAX_ITERATIONS if events else 0):
        shares, likelihood = {b: [0.5 if w else 0.0 for w in ws] for b, ws in weights.items()}, 0.0
        for b, ml in events:
            parts = [w * f for w, f in zip(weights[b], [uniform, *map(float, np.float32(ml))])]
            likelihood += math.log(sum(parts))
            for k, p in enumerate(parts):
                shares[b][k] += p / sum(parts)
        weights = {b: [s / sum(ss) for s in ss] for b, ss in shares.items()}
        if before is not None and likelihood - before < L.SETTLED * len(events):
            break
        before = likelihood
    out = []
    for (i, _), t, x in zip(rows, train, toks):
        base = sum(math.log10((counts[0][w,] + 0.5) / (total + 0.5 * (types + 1))) for w in x)
        score = sum(math.log10(sum(w * f for w, f in zip(weights[b], [uniform, *ml])))
                    for b, ml in said(x, counts, order, total, texts))
        out.append((i, t, len(x), sum(counts[0][w,] > 0 for w in x), base, score))
    return sorted(out, key=repr), (total, types, texts)


def found(spark, rows, order):
    scored, model = L.score_texts(docs(spark, rows).repartition(3), L.fold("doc_id", 5) != 1,
                                  L.fold("doc_id", L.TUNE_EVERY, skip=5) == 0, order=order)
    return sorted(map(tuple, scored.collect()), key=repr), (model["tokens"], model["types"], model["texts"])


def alike(got, want):
    assert got[1] == want[1] and len(got[0]) == len(want[0])
    for a, b in zip(sorted(got[0], key=lambda r: repr(r[:4]) + f"{r[4]:.3f}"), sorted(want[0], key=lambda r: repr(r[:4]) + f"{r[4]:.3f}")):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-5, abs=1e-7)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "É", "a\x1cb", "x" * 50, *(f"w{i}" for i in range(60))]
    rows = []
    for i in range(n):
        text = [rng.choice(words[:rng.choice([3, 10, 66])]) for _ in range(rng.choice([0, 1, 5, 40]))]
        rows.append((i, rng.choice([" ", "\n", "\t \v"]).join(text)))
    return rows


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, order):
    rows = prose(order, 150)
    alike(found(spark, rows, order), brute(rows, order))


def test_awkward_rows(spark):
    rows = AWKWARD + prose(5, 60) + [(900, "same words here")] * 40
    alike(found(spark, rows, 2), brute(rows, 2))


def test_nothing_to_learn_from(spark):
    assert found(spark, [], 2) == ([], (0, 0, 0))
    held = [(i, "some text") for i in range(200) if crc(i) % 5 == 1]
    got, counts = found(spark, held, 2)
    assert counts == (0, 0, 0) and all(r[2:] == (3, 0, 0.0, 0.0) for r in got)


def test_probabilities_of_all_words_add_up_to_one(spark):
    rows = prose(9, 200)
    _, model = L.score_texts(docs(spark, rows), L.fold("doc_id", 5) != 1, L.fold("doc_id", L.TUNE_EVERY, skip=5) == 0)
    train = [tokens_of(t) for i, t in rows if crc(i) % 5 != 1]
    counts = [Counter(g for x in train for g in grams_of(x, n)) for n in (1, 2)]
    words = [w for w, in counts[0]]
    for context in [b"the", b"w1", b"never seen"]:
        total = 0.0
        for w in [*words, b"an unknown word"]:
            bucket, ml = said([context, w], counts, 2, model["tokens"], model["texts"])[1]
            total += model["weights"][bucket] @ [1 / (model["types"] + 1), *ml]
        assert total == pytest.approx(1, abs=1e-9)


def test_weights_trust_bigrams_of_frequent_contexts(spark):
    rows = [(i, "alpha beta gamma delta " * 5) for i in range(300)]
    _, model = L.score_texts(docs(spark, rows), L.fold("doc_id", 5) != 1, L.fold("doc_id", L.TUNE_EVERY, skip=5) == 0)
    level = int(math.log2(sum(crc(i) % 5 != 1 for i, _ in rows) * 5))
    assert model["weights"][2 * L.LEVELS + level][2] > 0.9


def test_packed_keys_and_counts():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    for k in (keys, keys[:1], keys[:0]):
        assert (L._unpack(L._pack(k)) == k).all()
    for counts in ([], [0, 1], [255, 256], [70_000], [1 << 40]):
        assert L._unpack_counts(L._pack_counts(np.array(counts, np.int64))).tolist() == counts


def test_batches_split_and_keep_all_rows(monkeypatch):
    monkeypatch.setattr(L, "BATCH_BYTES", 50)
    monkeypatch.setattr(L, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 3})())}))
    rows = [(i, "t" * (i % 30), i % 2 == 0, i % 4 == 0) for i in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["id", "text", "train", "tune"])
    small = [batch.slice(i, 7) for i in range(0, 100, 7)]
    out = list(L._batches(iter(small + small)))
    assert len({n for n, _ in out}) == len(out) > 10 and all(n >> 32 == 3 for n, _ in out)
    assert all(set(b.column(3).to_pylist()) == {bool(n % 2)} for n, b in out)
    assert sorted(r["id"] for _, b in out for r in b.to_pylist()) == sorted(2 * list(range(100)))
    table = pa.Table.from_batches(list(L._packed(iter([batch])))[:1])
    ids, train, texts = L._unpacked(table)
    assert [(i, t) for i, t in zip(ids.to_pylist(), texts.to_pylist())] == [(i, t) for i, t, _, u in rows if i in ids.to_pylist()]
