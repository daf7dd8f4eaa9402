import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_data import AWKWARD, docs
from seqlab.llm.infill import Units, fill_in_middle, rebuilt


def brute(i, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, text, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:z], text[z:]
    if h4 % 100 < 20:
        return i, n, "spm", a, z - a, f"<S>{suf}<P>{pre}<M>{mid}", text
    return i, n, "psm", a, z - a, f"<P>{pre}<S>{suf}<M>{mid}", text


def found(spark, rows):
    out = fill_in_middle(docs(spark, rows)).withColumn("text", rebuilt(F.col("output"), F.col("form")))
    return sorted(map(tuple, out.collect()), key=repr)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    letters = "ab <>PSM\néß中\U0001f600́\x00"
    return [(rng.randrange(10 ** 6), "".join(rng.choices(letters, k=rng.choice([1, 3, 7, 8, 9, 40, 500])))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found(spark, rows) == sorted((brute(*r) for r in rows), key=repr)


def test_awkward_rows(spark):
    rows = AWKWARD + [(20, "<P>"), (21, "<S"), (22, "<<P<S<M"), (23, "P><S"), (24, "\U0001f600" * 9),
                      (25, "é\U0001f600" * 900_000), (26, "x"), (27, "aé" * 1_500_000)]     # beyond a slice
    rows += [(i, t) for i in range(30, 60) for t in ("<", "x<", "<S", "M>")]
    assert found(spark, rows) == sorted((brute(*r) for r in rows), key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=12))
def test_rank_and_select(texts):
    data = "".join(texts).encode()
    units = Units(np.frombuffer(data, np.uint8))
    ends = [i + 1 for i in range(len(data)) if i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80]
    assert units.rank(np.arange(len(data) + 1)).tolist() == [sum(e <= p for e in ends) for p in range(len(data) + 1)]
    if ends:
        assert units.select(np.arange(1, len(ends) + 1)).tolist() == ends
