"""Comparator order against Python's sorted."""

import random
from functools import cmp_to_key

import pytest

from seqlab.operators.comparing import comparator_order
from seqlab.plans.queries import _natural


def _letters():
    """Case and accents count only between otherwise equal words; None first."""
    import unicodedata

    def plain(v):
        return "".join(c for c in unicodedata.normalize("NFD", v.lower()) if not unicodedata.combining(c))

    def compare(a, b):
        x, y = a[0], b[0]
        if x is None or y is None:
            return (x is not None) - (y is not None)
        return ((plain(x) > plain(y)) - (plain(x) < plain(y))) or ((x > y) - (x < y))
    return compare


def _modulo():
    """A preorder with large classes of equal keys."""
    return lambda a, b: (a[0] or 0) % 3 - (b[0] or 0) % 3


@pytest.mark.parametrize("ranges", [1, 5, 40])
@pytest.mark.parametrize("compare,kind", [(_letters, "word"), (_natural, "number"), (_modulo, "int")])
def test_equals_sorted(spark, ranges, compare, kind):
    rng = random.Random(f"{kind}{ranges}")
    words = ["a", "A", "á", "b", "Ába", "aba", "z", "", None]
    pool = {"word": lambda: "".join(rng.choices([w for w in words if w], k=rng.randint(0, 3))) if rng.random() > 0.1 else None,
            "number": lambda: f"{rng.choice(['s', '', 'x'])}{rng.randrange(200)}-{rng.randrange(12)}",
            "int": lambda: rng.choice([None, *range(40)])}[kind]
    hot = pool()
    rows = [(hot if rng.random() < 0.34 else pool(), i) for i in range(600)]      # one key holds a third
    df = spark.createDataFrame(rows, f"k {'bigint' if kind == 'int' else 'string'}, i int").repartition(4)
    got = sorted(comparator_order(df, ["k"], compare(), num_ranges=ranges).collect(), key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(600)) and sorted(r.i for r in got) == list(range(600))
    c = compare()
    want = sorted((k for k, _ in rows), key=cmp_to_key(lambda a, b: c((a,), (b,))))
    assert all(c((r.k,), (w,)) == 0 for r, w in zip(got, want))
    if kind != "int":
        assert [r.k for r in got] == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, i int")
    assert comparator_order(df, ["k"], _letters()).collect() == []
