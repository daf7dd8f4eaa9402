import random

from hypothesis import given, settings, strategies as st

from llm_data import AWKWARD, docs
from seqlab.llm import decontamination as D

ITEM = ("The quick brown fox jumps over the lazy dog while seventeen violet wizards "
        "quietly judge my vow, and nobody expects a second verse of this song today")


def edits(a: bytes, b: bytes) -> int:
    """Least edits from ``a`` to a substring of ``b``, the whole table."""
    row = [0] * (len(b) + 1)
    for i, c in enumerate(a, 1):
        last, row = row, [i]
        for j, e in enumerate(b, 1):
            row.append(min(last[j - 1] + (c != e), last[j] + 1, row[-1] + 1))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=12), st.binary(max_size=20), st.integers(0, 4))
def test_banded_alignment_equals_the_whole_table(a, b, most):
    a, b = bytes(97 + c % 3 for c in a), bytes(97 + c % 3 for c in b)
    want = edits(a, b)
    assert D.aligned(a, b, -len(a), len(b), most) == (want if want <= most else None)


def brute(item: str, text: str) -> bool:
    data, t = D.normal_form(item), D.normal_form(text)
    return any(edits(data[s:s + D.PIECE], t) <= D.budget(len(data[s:s + D.PIECE]))
               for s in D.Matcher._starts(len(data), D.PIECE))


def test_finds_what_the_whole_table_finds(spark):
    rng = random.Random(5)
    other = "completely different words about rivers, mountains, glaciers and the weather in late autumn " * 3
    rows = []
    for i in range(60):
        chars = list(ITEM[:rng.choice([60, 100, len(ITEM)])])
        for _ in range(rng.choice([0, 1, 4, 8, 15, 30])):
            k = rng.randrange(len(chars))
            chars[k:k + 1] = rng.choice([[], ["q"], [chars[k], "z"]])
        at = rng.randrange(100)
        rows.append((i, other[:at] + " " + "".join(chars) + " " + other[at:]))
    rows += [(100, other), (101, ITEM.upper().replace(" ", " - "))]
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    out = D.mark_contamination(docs(spark, rows), bench)
    got = {r["doc_id"]: bool(r["contamination"]) for r in out.collect()}
    assert got == {i: brute(ITEM, t) for i, t in rows} and got[101] and not got[100]


def test_awkward_items_blocks_and_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "tiny"), (5, ITEM), (5, ITEM), (None, ITEM[::-1])],
                                  "item_id long, text string")
    rows = AWKWARD + [(20, "a tiny thing"), (21, "tinyness"), (22, ITEM), (22, ITEM), (23, "x " + ITEM[::-1])]
    for block in (D.BLOCK_BYTES, 100):   # one block, several blocks
        d = docs(spark, rows)
        out = D.mark_contamination(d, bench, block_bytes=block)
        assert out.columns == [*d.columns, "contamination"]
        found = sorted((r["doc_id"], c["item_id"]) for r in out.collect() for c in r["contamination"] if c["item_id"])
        assert found == [(20, 4), (22, 5), (22, 5)]
        assert {r["doc_id"] for r in out.collect() if any(c["item_id"] is None for c in r["contamination"])} == {23}
    kept = D.drop_contaminated(d, bench)
    assert kept.columns == d.columns and kept.count() == len(AWKWARD) + 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(docs(spark, AWKWARD), none).count() == len(AWKWARD)
    assert D.mark_contamination(docs(spark, []), none).count() == 0


def test_quotes_at_every_offset():
    """Against the whole table, without a stride: verbatim and edited quotes."""
    rng = random.Random(11)
    item = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(55))[:300].strip()
    data = D.normal_form(item)
    other = "completely different words about rivers and mountains "
    matcher = D.Matcher([(7, item)])
    for size in (75, 86, 88, 96, 100, 110):
        quotes = [data[s:s + size].decode() for s in range(0, len(data) - size + 1, 7)]
        texts = [D.normal_form(other + q + " " + other) for q in quotes]
        edited = [t.replace(t[80:83], b"q") for t in texts] if size > 96 else []
        for t, found in zip(texts + edited, matcher.find(texts + edited)):
            want = min(edits(data[s:s + D.PIECE], t) for s in range(len(data) - D.PIECE + 1)) if size in (86, 88) else None
            if want is None:
                assert bool(found) == (size > 88), (size, t)
            else:
                assert (found[7][0] if found else None) == (want if want <= D.budget(D.PIECE) else None)


def _least_edits(piece, text):
    row = [0] * (len(text) + 1)
    for c in piece:
        new = [row[0] + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (x != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_lanes_equal_dynamic_programming():
    import random
    rng = random.Random(4)
    for _ in range(150):
        item = bytes(rng.choices(b"ab c", k=rng.randint(5, 40)))
        m = rng.randint(1, len(item))
        windows = sorted(rng.sample(range(len(item) - m + 1), rng.randint(1, len(item) - m + 1)))
        text = bytes(rng.choices(b"ab c", k=rng.randint(1, 50)))
        best = min(_least_edits(item[w:w + m], text) for w in windows)
        lanes = D.Lanes(item, windows, m)
        assert [lanes.within(text, k) for k in range(m)] == [best <= k for k in range(m)]


def test_repetitive_texts_and_items_take_no_long_time():
    import random
    import time
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(45)]
    item = " ".join(words)
    started = time.time()
    # a line of 60 bytes alone is no piece of 96, however often it is repeated
    assert D.Matcher([(1, item)]).find([D.normal_form((item[60:120] + "\n") * 4000)]) == [{}]
    # an item that repeats itself, in a text that repeats it
    phrase = "the quick brown fox and so on "
    found = D.Matcher([(2, (phrase * 26)[:760])]).find([D.normal_form(phrase * 600)])
    assert list(found[0]) == [2] and min(found[0][2]) == 0
    assert time.time() - started < 20
