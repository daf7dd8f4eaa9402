import tracemalloc

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_data import AWKWARD, docs
from seqlab.llm.bpe import FragmentCoder, encode_decode
from seqlab.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def coder():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return FragmentCoder(f.read())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


PIECES = st.sampled_from(["'s", "'", " ", "  ", "\n", "\n\n", "\t", " ", " ", "　", "\x85", "word", "Xq", "é", "ß",
                          "12", "...", "!!'", "<|endoftext|>", "漢字", "🙂", "'ll", "_", "\x00", "\x1c", "ñ"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(PIECES, max_size=30).map("".join), st.text(max_size=60)))
def test_equals_the_library(library, coder, text):
    assert coder.round_trip(text) == expected(library, text)


def test_fragments_are_cut_and_join_to_the_text(coder):
    data = "some words, and more of them".encode()
    parts = coder.fragments(data)
    assert b"".join(parts) == data and len(parts) >= 6


def test_awkward_rows(spark, library):
    got = encode_decode(docs(spark, AWKWARD), tokenizer_path()).collect()
    assert len(got) == len(AWKWARD)
    want = sorted((str(i), *map(str, expected(library, t or ""))) for i, t in AWKWARD)
    assert sorted((str(r["id"]), str(r["ids"]), str(r["decoded"])) for r in got) == want


def test_empty_table(spark):
    assert encode_decode(docs(spark, []), tokenizer_path()).count() == 0


def test_what_a_worker_holds(coder):
    """More distinct fragments than are kept, coded text by text."""
    texts = ["".join(f" {i * 7919:x}~{i:x}" for i in range(at, at + 500)) for at in range(0, 190_000, 500)]
    coder.cache.clear()
    tracemalloc.start()
    try:
        assert [coder.round_trip(t)[1] for t in texts] == texts
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 24e6, most
