"""Fill-in-middle transformation: texts cut at two code points.

A document is cut into prefix, middle and suffix and written in one of two
orders, ``psm`` and ``spm``, or left ``plain``. The cuts are numbers of units
(code points); their places in the UTF-8 bytes are found eight bytes at a time:

1. the bytes of a slice of texts are viewed as little-endian uint64 words; a
   byte ends a unit if the next one is no continuation byte (``10xxxxxx``),
   which shifts and masks tell for a whole word;
2. ``bitwise_count`` of each word and a running sum give the units before it;
3. a unit's word is found by binary search in the running sums, its byte in the
   word by the byte-wise prefix sums that one multiplication makes.

Texts are never decoded, and a task holds one slice of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_U = np.uint64


class Units:
    """Rank and select over the code points of UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        # one word more than needed, so that ranks at the end have a word
        padded = np.zeros(len(data) // 8 * 8 + 8, np.uint8)
        padded[:len(data)] = data
        words = padded.view("<u8")
        follows = (words >> _U(7)) & ~(words >> _U(6)) & _ONES       # continuation bytes
        shifted = follows >> _U(8)
        shifted[:-1] |= follows[1:] << _U(56)
        self.ends = ~shifted & _ONES
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end before each byte position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        mask = (_U(1) << (byte * _U(8))) - _U(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & mask)

    def select(self, unit: np.ndarray) -> np.ndarray:
        """Byte position after the ``unit``-th unit (from 1)."""
        word = np.searchsorted(self.before, unit, side="left") - 1
        left = (unit - 1 - self.before[word]).astype(np.uint64)      # units of the word before it
        sums = self.ends[word] * _ONES                               # byte i: units that end in bytes 0 to i
        beyond = (sums + (_U(127) - left) * _ONES) & _HIGH           # bytes whose sum is larger than left
        return 8 * word + 8 - np.bitwise_count(beyond).astype(np.int64) + 1


def cut(data: np.ndarray, starts: np.ndarray, first: np.ndarray, second: np.ndarray
        ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts that fill ``data`` from ``starts[i]`` to ``starts[i + 1]``: their
    units, and units and byte positions of both cuts, drawn from ``first`` and
    ``second`` modulo the units plus one."""
    units = Units(data)
    base = units.rank(starts[:-1])
    n = units.rank(starts[1:]) - base
    low = np.minimum(first % (n + 1), second % (n + 1))
    high = np.maximum(first % (n + 1), second % (n + 1))
    at = [np.where(k > 0, units.select(np.maximum(base + k, 1)), starts[:-1]) for k in (low, high)]
    return n, low, high, *at


_SCHEMA = ("id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    for part in text_slices(batches):
        ids, texts, form, first, second = part.columns
        buffers = texts.buffers()
        wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        starts = np.frombuffer(buffers[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        whole = memoryview(buffers[2] if buffers[2] is not None else b"")[starts[0]:starts[-1]]
        starts = starts - starts[0]
        n, low, high, a, z = cut(np.frombuffer(whole, np.uint8), starts, first.to_numpy(), second.to_numpy())
        out, forms, places = [], form.to_pylist(), zip(starts[:-1].tolist(), a.tolist(), z.tolist(), starts[1:].tolist())
        for i, (b, x, y, e) in enumerate(places):
            if b == e:
                forms[i] = "plain"
            if forms[i] == "psm":
                out.append(b"".join((p, whole[b:x], s, whole[y:e], m, whole[x:y])))
            elif forms[i] == "spm":
                out.append(b"".join((s, whole[y:e], p, whole[b:x], m, whole[x:y])))
            else:
                out.append(bytes(whole[b:e]))
        plain = np.array([f == "plain" for f in forms], bool)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n), pa.array(forms, pa.string()), pa.array(low, mask=plain), pa.array(high - low, mask=plain),
             pa.array(out, pa.binary()).cast(pa.string())], schema=pa.schema(list(zip(names, kinds))))


def _drawn(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
                   plain_share: int = 10, spm_share: int = 20) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` of each row.

    The four draws are the first 32-bit groups of the sha256 of ``seed:id``: two
    cuts, plain (``plain_share`` of 100) and spm (``spm_share`` of 100 of the
    others). A null text counts as empty; empty texts and texts that contain a
    marker stay plain (their character counts are null). Rows of one id are cut
    by the same draws, rows of a null id by those of an empty id. Other columns
    of ``docs`` are neither read nor returned.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when(marked | (_drawn(digest, 2) % 100 >= 100 - plain_share), "plain") \
        .when(_drawn(digest, 3) % 100 < spm_share, "spm").otherwise("psm")
    rows = docs.select(ident.alias("id"), text.alias("text"), form.alias("form"),
                       _drawn(digest, 0).alias("first"), _drawn(digest, 1).alias("second"))
    return rows.mapInArrow(_transform, _SCHEMA)


def rebuilt(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    rest = F.substring(output, 4, 2 ** 31 - 1)
    before = F.substring_index(rest, MIDDLE, 1)
    middle = F.substring_index(rest, MIDDLE, -1)
    psm = F.concat(F.substring_index(before, SUFFIX, 1), middle, F.substring_index(before, SUFFIX, -1))
    spm = F.concat(F.substring_index(before, PREFIX, -1), middle, F.substring_index(before, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
