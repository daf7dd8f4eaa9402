"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged over,
so the position between its two bytes is a certain cut. Each text is cut at
all such positions, the fragments are encoded independently (each distinct
fragment once per task and cache generation) and their ids concatenated.

A cut must also leave the pre-tokenizer's pieces alone. Its pattern only looks
ahead over white space and only the apostrophe starts a contraction, so a
position is used when

* the character before it is not white space (a run of blanks is split by what
  follows it),
* the character after it is not an apostrophe (``'s`` would become a
  contraction at the start of a fragment),
* it lies between two characters, never inside a multi-byte one.

Left of such a cut no piece can reach over it other than a run of one class,
whose two halves are pieces of the same class and cannot merge over the cut;
right of it matching starts anew exactly as it does at any piece boundary.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from seqlab.llm.common import id_and_text, text_slices

# fixed values: the byte-level pre-tokenizer's pattern
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")
_CACHE_ENTRIES = 100_000
_CACHE_FRAGMENT = 64
_SLICE = 1 << 20        # bytes of text that are coded before a batch is sent
SCHEMA = "id long, ids array<int>, decoded string"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary -> byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class FragmentCoder:
    """Encoder and decoder for one byte-level BPE tokenizer file (its JSON)."""

    def __init__(self, spec: str):
        t = json.loads(spec)
        pre = t.get("pre_tokenizer") or {}
        if t["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or t.get("normalizer") \
                or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE files without normalizer or prefix space")
        alphabet = byte_alphabet()
        vocab = t["model"]["vocab"]
        added = {a["content"]: a["id"] for a in t.get("added_tokens") or []}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in added}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in t["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("token ids must follow the merge order")
        self.token_bytes = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in added.items()}
        self.added = added
        self.special = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.bpe = tiktoken.Encoding("fragments", pat_str=BYTE_LEVEL_PATTERN,
                                     mergeable_ranks=ranks, special_tokens={})
        self.cut = self._cut_table(ranks)
        self.cache: dict[bytes, tuple[bytes, bytes]] = {}

    @staticmethod
    def _cut_table(tokens) -> np.ndarray:
        inside = np.zeros(65536, bool)
        for b in tokens:
            for x, y in zip(b, b[1:]):
                inside[x << 8 | y] = True
        first, second = np.arange(65536) >> 8, np.arange(65536) & 255
        blank = ((first >= 9) & (first <= 13)) | ((first >= 28) & (first <= 32))
        starts = (second < 0x80) | (second >= 0xC0)
        return ~inside & ~blank & starts & (second != ord("'"))

    def fragments(self, data: bytes) -> list[bytes]:
        if len(data) < 2:
            return [data] if data else []
        a = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(self.cut[a[:-1].astype(np.uint16) << 8 | a[1:]])
        if len(at):
            # the character before may be multi-byte white space: those end in
            # a continuation byte after one of these bytes, so keep them whole
            last, before = a[at], a[np.maximum(at - 1, 0)]
            at = at[~((last & 0xC0 == 0x80) & np.isin(before, (0xC2, 0x80, 0x81, 0x9A)))]
        ends = [0, *(at + 1).tolist(), len(data)]
        return [data[i:j] for i, j in zip(ends, ends[1:])]

    def _code(self, fragment: bytes) -> tuple[bytes, bytes]:
        ids = self.bpe.encode_ordinary(fragment.decode("utf-8"))
        decoded = b"".join(map(self.token_bytes.__getitem__, ids))
        out = array("i", ids).tobytes(), fragment if decoded == fragment else decoded    # equal bytes are held once
        if len(fragment) <= _CACHE_FRAGMENT:
            if len(self.cache) >= _CACHE_ENTRIES:
                self.cache.clear()
            self.cache[fragment] = out
        return out

    def packed(self, text: str) -> tuple[bytes, bytes]:
        """Ids of ``text`` as 32-bit integers, and the bytes those ids decode to."""
        coded: list[tuple[bytes, bytes]] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.added:
                i = self.added[part]
                coded.append((array("i", [i]).tobytes(), self.token_bytes[i]))
            elif part:
                get, code = self.cache.get, self._code
                coded += [get(f) or code(f) for f in self.fragments(part.encode("utf-8"))]
        return b"".join([c[0] for c in coded]), b"".join([c[1] for c in coded])

    def round_trip(self, text: str) -> tuple[list[int], str]:
        """Ids of ``text``, and the text those ids decode to."""
        ids, decoded = self.packed(text)
        return array("i", ids).tolist(), decoded.decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id, ids array<int>, decoded`` for every row of ``docs``.

    ``ids`` equal the tokenizers library's ids without added special tokens
    (their strings in a text are matched, as that library does); ``decoded``
    is the text of the ids, special tokens kept. Null and empty texts give no
    ids and an empty text; a null id stays null; repeated rows give repeated
    results; an empty table gives an empty table. Map-side only: no shuffle.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one tokenizer file, about 1.5 MB

    def run(batches):
        coder = FragmentCoder(spec.value)
        for part in text_slices(batches, max_bytes=_SLICE):
            ids, decoded = zip(*[coder.packed(t.as_py()) for t in part.column(1)])
            ends = np.cumsum([0, *map(len, ids)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            decoded = pa.array([d.decode("utf-8", "replace") for d in decoded], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), ids, decoded], ["id", "ids", "decoded"])
            del ids, decoded

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
