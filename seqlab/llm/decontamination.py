"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared as runs of lower-case letters and digits with single blanks,
in UTF-8. A piece is any PIECE bytes of a benchmark item, from every byte on (a
shorter item is one piece), so a quote is found wherever in the item it begins;
a piece of length m leaks into a document when some region of it is within
``k = rate * m`` edits. The q-gram lemma bounds what such a region must share:
at least ``(m - q + 1) - k * q`` q-grams, on diagonals (position in the document
minus position in the item) that differ by k at most.

1. all q-grams of a document are looked up in the benchmark's q-grams;
2. (document, item) pairs with too few hits are dropped;
3. hits are put in diagonal bands of width 2 (k + 1) that overlap by half, so
   some band holds all hits of a region; where a piece's length of the item has
   hits enough in a band, the pieces around these hits stay;
4. the pieces kept are verified: a bit-parallel search over all of them tells
   whether any is near at all, and if so a banded alignment finds the least
   edits, those that share most first; a band counts a q-gram of the item once, and a region that was seen
   before (a repeated line) is not aligned again.

The benchmark travels to the documents in blocks of bounded size, read one after
the other; a worker holds the index of every block. The documents are never
shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import release_memory
from seqlab.llm.hashing import Roller, groups_of_size, join_bytes

Q = 8
RATE = 0.1
PIECE = 96
LEAST_SHARED = 4
BLOCK_BYTES = 8 << 20
_SLICE = 1 << 20
_WINDOWS = 16               # windows aligned at a time
_LANES = 128                # pieces searched for at once
_KEPT_LANES = 256
_CACHE_BYTES = 4 << 20      # regions seen before (repeated lines) are not aligned again
_WORD = re.compile(r"[^\W_]+")
FOUND = "array<struct<item_id:bigint,pieces:int,edits:int>>"


def normal_form(text: str | None) -> bytes:
    return " ".join(_WORD.findall((text or "").lower())).encode("utf-8")


def budget(m: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed for a piece of length m: the rate's share, but so few that
    a match must still share LEAST_SHARED q-grams."""
    return max(0, min(int(rate * m), (m - q + 1 - LEAST_SHARED) // q))


def aligned(piece: bytes, region: bytes, low: int, high: int, most: int) -> int | None:
    """Least edits that turn ``piece`` into a substring of ``region``, over
    paths on diagonals ``low`` to ``high`` (region minus piece position); None
    above ``most``."""
    far = most + 1
    width = high - low + 1
    # row i, column d: cost of piece[:i] against a region part ending at i + low + d
    row = [0 if 0 <= low + d <= len(region) else far for d in range(width)]
    for i in range(1, len(piece) + 1):
        last, row, c = row, [], piece[i - 1]
        for d in range(width):
            j = i + low + d
            if j < 0 or j > len(region):
                row.append(far)
                continue
            best = last[d] + (region[j - 1] != c) if j > 0 else far
            if d + 1 < width and last[d + 1] + 1 < best:
                best = last[d + 1] + 1
            if d and row[d - 1] + 1 < best:
                best = row[d - 1] + 1
            row.append(min(best, far))
        if min(row) > most:
            return None
    return min(row)


def windows_aligned(item: np.ndarray, at: np.ndarray, m: int, text: np.ndarray, low: int, high: int,
                    most: int) -> np.ndarray:
    """For each start in ``at`` the result of ``aligned`` for the ``m`` bytes of
    ``item`` from there on diagonals ``low`` to ``high`` (text minus item
    position); ``most + 1`` instead of None."""
    far, width = np.int16(most + 1), high - low + 1
    d = np.arange(width, dtype=np.int16)
    j = at[:, None] + low + np.arange(width)       # text read before the first byte
    row = np.where((j >= 0) & (j <= len(text)), np.int16(0), far)
    # all text that is compared, with a byte that no item holds beyond both ends
    first, last = int(at.min()) + low, int(at.max()) + high + m
    span = np.zeros(last - first + 1, np.uint8)
    a, z = max(0, first), min(len(text), last)
    if z > a:
        span[a - first:z - first] = text[a:z]
    offset = at - int(at.min())
    edge = first < 0 or last > len(text)
    for i in range(m):
        cost = np.lib.stride_tricks.sliding_window_view(span[i:], width)[offset] != item[at + i][:, None]
        best = row + cost
        if edge:
            j += 1
            best[j <= 0] = far
        np.minimum(best[:, :-1], row[:, 1:] + np.int16(1), out=best[:, :-1])
        if edge:
            best[(j < 0) | (j > len(text))] = far
        best -= d
        np.minimum.accumulate(best, axis=1, out=best)
        best += d
        if edge:
            best[(j < 0) | (j > len(text))] = far
        row = np.minimum(best, far)
        if i % 8 == 7 and row.min() > most:
            break
    return row.min(axis=1).astype(np.int64)


def runs(item: np.ndarray, windows: np.ndarray, m: int, text: np.ndarray, low: int, high: int) -> bool:
    """Whether the ``m`` bytes of ``item`` from one of ``windows`` on stand in
    ``text`` as they are, on a diagonal of the band."""
    a, z = int(windows[0]), int(windows[-1]) + m
    span = np.zeros(z - a + high - low, np.uint8)
    first, last = max(0, a + low), min(len(text), z + high)
    if last > first:
        span[first - a - low:last - a - low] = text[first:last]
    same = np.lib.stride_tricks.sliding_window_view(span, z - a) == item[a:z]
    count = np.zeros((len(same), z - a + 1), np.int32)
    np.cumsum(same, axis=1, out=count[:, 1:])
    return bool((count[:, windows - a + m] - count[:, windows - a] == m).any())


class Lanes:
    """Bit-parallel approximate search of many pieces of one item at once: one lane
    of an integer per piece, with a bit more that takes the carry."""

    def __init__(self, item: bytes, windows: list[int], m: int):
        self.m, lane = m, m + 1
        self.low = sum(1 << lane * i for i in range(len(windows)))       # the first bit of every lane
        self.rows = self.low * ((1 << m) - 1)
        self.equal = {}
        for c in set(item[windows[0]:windows[-1] + m]):
            bits = int("".join("1" if x == c else "0" for x in reversed(item)), 2)
            whole = 0
            for i, w in enumerate(windows):
                whole |= (bits >> w & (1 << m) - 1) << lane * i
            self.equal[c] = whole

    def within(self, text: bytes, most: int) -> bool:
        """Whether some part of ``text`` is within ``most`` edits of some piece."""
        m, low, rows, equal = self.m, self.low, self.rows, self.equal
        guard = low << m
        more, less, score = rows, 0, low * m
        limit = low * most + guard
        for c in text:
            eq = equal.get(c, 0)
            vertical = eq | less
            across = (((eq & more) + more & rows) ^ more | eq) & rows
            up, down = less | rows & ~(across | more), more & across
            score += (up >> m - 1 & low) - (down >> m - 1 & low)
            if limit - score & guard:            # the guard stays where score <= most
                return True
            up, down = up << 1 & rows, down << 1 & rows
            more, less = down | rows & ~(vertical | up), up & vertical
        return False


class Matcher:
    """Finds the items of one block of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE, piece: int = PIECE):
        self.q, self.texts, self.item = q, [], []
        self.cache, self.held, self.lanes = {}, 0, {}
        for item_id, data in dict.fromkeys((i, normal_form(t)) for i, t in items):
            if data:
                self.texts.append(data)
                self.item.append(item_id)
        sizes = [len(p) for p in self.texts]
        self.shift = max(sizes, default=0) + piece
        self.length = np.minimum(np.array(sizes, np.int64), piece)
        self.edits = np.array([budget(m, q, rate) for m in self.length.tolist()], np.int64)
        self.least = self.length - q + 1 - self.edits * q
        # items shorter than a few q-grams must occur as whole words, exactly
        self.short = [i for i, m in enumerate(sizes) if m < q + LEAST_SHARED]
        self.roller = Roller()
        grams, where, at = [], [], []
        short = set(self.short)
        for i, p in enumerate(self.texts):
            if i not in short:
                g = self.roller.grams(self.roller.prefix(np.frombuffer(p, np.uint8)), q)
                grams.append(g)
                where.append(np.full(len(g), i))
                at.append(np.arange(len(g)))
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        g = cat(grams, np.uint64)
        order = np.argsort(g, kind="stable")
        self.grams, self.first, self.count = np.unique(g[order], return_index=True, return_counts=True)
        self.where, self.at = cat(where, np.int64)[order], cat(at, np.int64)[order]
        self.bits = 24
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[self.grams >> np.uint64(64 - self.bits)] = True

    @staticmethod
    def _starts(n: int, piece: int) -> list[int]:
        return [*range(max(1, n - piece + 1))]

    def find(self, texts: list[bytes]) -> list[dict[int, list[int]]]:
        """Per text {item id: least edits of each region found}."""
        out: list[dict[int, list[int]]] = [{} for _ in texts]
        for i in self.short:
            needle = b" " + self.texts[i] + b" "
            for d, t in enumerate(texts):
                if needle in b" " + t + b" ":
                    out[d].setdefault(self.item[i], []).append(0)
        if not len(self.grams):
            return out
        data, starts = join_bytes(texts)
        g = self.roller.grams(self.roller.prefix(data), self.q)
        pos = np.flatnonzero(self.filter[g >> np.uint64(64 - self.bits)])
        at = np.minimum(np.searchsorted(self.grams, g[pos]), len(self.grams) - 1)
        hit = self.grams[at] == g[pos]
        pos, at = pos[hit], at[hit]
        n = self.count[at]
        # every hit with every place of that q-gram in the block
        post = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        pos = np.repeat(pos, n)
        doc = np.searchsorted(starts, pos, side="right") - 1
        piece = self.where[post]
        pair, of, many = np.unique(doc * len(self.texts) + piece, return_inverse=True, return_counts=True)
        keep = (many >= self.least[pair % len(self.texts)])[of]
        pos, doc, piece, at = pos[keep], doc[keep], piece[keep], self.at[post[keep]]
        if not len(pos):
            return out
        k1 = self.edits[piece] + 1
        band = (pos - starts[doc] - at + self.shift) // k1    # no diagonal is below -shift
        order = np.lexsort((at, band, piece, doc))
        doc, piece, band, at = doc[order], piece[order], band[order], at[order]
        # a band counts each q-gram of the item once, however often the text repeats it
        once = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(piece) != 0) | (np.diff(band) != 0) | (np.diff(at) != 0)])
        doc, piece, band, at = doc[once], piece[once], band[once], at[once]
        new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(piece) != 0) | (np.diff(band) != 0)])
        first = np.flatnonzero(new)
        ends = np.concatenate([first[1:], [len(doc)]])
        doc, piece, band = doc[first], piece[first], band[first]
        follows = np.concatenate([(doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1]) & (band[1:] == band[:-1] + 1),
                                  [False]])
        ends = np.where(follows, np.concatenate([ends[1:], [0]]), ends)
        last = None
        for i in np.flatnonzero(ends - first >= self.least[piece]).tolist():
            d, p, b = int(doc[i]), int(piece[i]), int(band[i])
            low = b * (int(self.edits[p]) + 1) - self.shift
            edits = self._verify(texts[d], p, low, np.unique(at[first[i]:ends[i]]))
            if edits is None:
                continue
            found = out[d].setdefault(self.item[p], [])
            if last == (d, p, b - 1):    # the same region in the next band
                found[-1] = min(found[-1], edits)
            else:
                found.append(edits)
            last = (d, p, b)
        return out

    def _verify(self, text: bytes, p: int, low: int, at: np.ndarray) -> int | None:
        """Least edits of a piece of item ``p`` around the hits ``at`` (distinct
        item positions, sorted) of a band; None if no piece is within its edits.

        A window with ``h`` of its q-grams hit takes ``(m - q + 1 - h) / q`` edits
        at least: windows are aligned from the least bound on, and those whose
        bound is no better than what was found are not. Windows that stand in the
        text as they are need no alignment."""
        m, k, q = int(self.length[p]), int(self.edits[p]), self.q
        mine = np.frombuffer(self.texts[p], np.uint8)
        # windows that can hold hits enough, by the hits between their ends
        windows = np.arange(max(0, int(at[0]) - (m - q)), min(int(at[-1]), len(mine) - m) + 1)
        if not len(windows):
            return None
        hits = np.searchsorted(at, windows + m - q, side="right") - np.searchsorted(at, windows)
        bound = np.maximum(-((hits - (m - q + 1)) // q), 0)
        windows, bound = windows[bound <= k], bound[bound <= k]
        if not len(windows):
            return None
        low, high = low - k, low + 2 * (k + 1) - 1 + k
        first, last = int(windows[0]) + low, int(windows[-1]) + m + high
        seen = (p, windows.tobytes(), bound.tobytes(), min(first, 0), text[max(0, first):max(0, last)], last > len(text))
        if seen in self.cache:
            return self.cache[seen]
        data, best = np.frombuffer(text, np.uint8), k + 1
        if int(bound.min()) == 0 and runs(mine, windows, m, data, low, high):
            best = 0
        elif self._near(text, p, windows, m, low, high, k):
            windows, bound = windows[np.argsort(bound, kind="stable")], np.sort(bound)
            for w in range(0, len(windows), _WINDOWS):
                if bound[w] >= best:
                    break
                part = windows[w:w + _WINDOWS]
                best = min(best, int(windows_aligned(mine, part, m, data, low, high, best - 1).min()))
        found = best if best <= k else None
        self.held += len(seen[4]) + 8 * len(windows)
        if self.held > _CACHE_BYTES:
            self.cache, self.held = {}, 0
        self.cache[seen] = found
        return found


    def _near(self, text: bytes, p: int, windows: np.ndarray, m: int, low: int, high: int, k: int) -> bool:
        """False if no window is within ``k`` edits of the text around the band."""
        for w in range(0, len(windows), _LANES):
            part = windows[w:w + _LANES].tolist()
            key = (p, part[0], part[-1], len(part)) if part[-1] - part[0] == len(part) - 1 else (p, *part)
            lanes = self.lanes.get(key)
            if lanes is None:
                if len(self.lanes) >= _KEPT_LANES:
                    self.lanes = {}
                lanes = self.lanes[key] = Lanes(self.texts[p], part, m)
            if lanes.within(text[max(0, part[0] + low):max(0, part[-1] + m + high)], k):
                return True
        return False


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                       item_text_col: str = "text", q: int = Q, rate: float = RATE, piece: int = PIECE,
                       block_bytes: int = BLOCK_BYTES, name: str = "contamination") -> DataFrame:
    """``docs`` with ``name array<struct<item_id, pieces, edits>>`` added: the
    benchmark items of which pieces leak into the text, in how many regions
    (bands of diagonals) and the least edits of a piece, by item id.

    Null and empty texts match nothing and neither do items without letters or
    digits; items that fit into ``q`` and a few more letters match only as
    whole words without edits; repeated items of one id count once; a null item
    id is kept as null. An empty table of either kind gives empty arrays.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col).cast("long").alias("i"),
                             F.col(item_text_col).cast("string").alias("t")).where("t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()   # about block_bytes
        sent = spark.sparkContext.broadcast([(r["i"], r["t"]) for r in rows])
        found.append(_scan(sent, q, rate, piece)(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    marks = [f"__marks{b}" for b in range(blocks)]
    out = docs.withColumns(dict(zip(marks, found)))
    return out.select(*docs.columns, F.array_sort(F.concat(*marks)).alias(name))


def _scan(sent, q, rate, piece):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release_memory()
        matcher = Matcher(sent.value, q, rate, piece)
        for texts in batches:
            rows = []
            for i, j in groups_of_size([len(t) for t in texts], _SLICE):
                for hits in matcher.find([normal_form(t) for t in texts.iloc[i:j]]):
                    rows.append([{"item_id": k, "pieces": len(v), "edits": min(v)} for k, v in hits.items()])
            yield pd.Series(rows, dtype=object)
        del matcher
        release_memory()
    return F.pandas_udf(run, FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents into which no benchmark item leaks, with their columns."""
    marked = mark_contamination(docs, benchmark, name="__leaks", **options)
    return marked.where(F.size("__leaks") == 0).select(*docs.columns)
