"""Exact substring deduplication by prefix-free parsing.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts
in a document with a smaller id. Texts are parsed into phrases at rolling-hash
triggers: the trigger of a string is the smallest hash among its substrings of
``TRIGGER`` bytes, so it depends on the string alone, equal strings have equal
triggers, and the starts that share a trigger form a run. A run with the bytes
its strings reach is a phrase; it stands for all its strings at once.

The dictionary is resolved before any single string is looked at:

* a trigger that occurs in one batch only has no strings elsewhere; this is
  settled on 4-byte prints of the triggers, packed per batch and hash bucket;
* a phrase that an earlier batch holds too: all its strings are repeated;
* only the first phrases of triggers with several (the edges of repeated
  passages) send their strings - suffixes of the phrase, cut to ``LENGTH``
  bytes - to be compared across the corpus, packed by batch and hash bucket.

Documents are read in batches of contiguous ids, so corpus order is batch order
first and only the order within a batch needs ids. An id that fills more than a
batch has batches of its own; these count as one place in that order. Every (trigger, batch) and
(string, batch) is sent once, so a passage in a third of all documents costs one
entry per batch, packed by hash bucket. Suffixes are ordered by 104-bit hashes of their ``LENGTH`` bytes
instead of their letters: the groups of equal strings, all that is asked for,
are the same, and no text is shuffled a second time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import id_ranges
from seqlab.llm.hashing import Roller

LENGTH = 50
TRIGGER = 20
BATCH_BYTES = 8 << 20
MAX_RUN = 64
_SLICE = 2 << 20
ALL, SOME, STRING = 1, 2, 3   # what a batch is told: phrase repeated, look at strings, string repeated
_SECOND = 5                    # bytes of the second hash of a string
_STRING_BYTES = 8 << 20        # of text per bucket of strings
_BUCKETS = 16                  # string ranges resolved one after the other in a batch
_NO_ID = (1 << 63) - 1         # comes last
_PRINT_BYTES = 16 << 20       # of text per bucket of prints
OUT = "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


class Parser:
    """Phrases of the texts of one batch."""

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER):
        self.length, self.trigger = length, trigger
        self.one, self.two = Roller(21), Roller(22)

    def slices(self, table: pa.Table):
        """(ids, starts, data) of some documents at a time; starts has one more entry."""
        column = table.column("text").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        n = len(column)
        if not n:
            return
        offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        ids = table.column("id").to_numpy()
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _SLICE, side="right")) - 1)
            last = min(last, n)
            yield ids[first:last], offsets[first:last + 1] - offsets[first], data[offsets[first]:offsets[last]]
            first = last

    def runs(self, starts: np.ndarray, data: np.ndarray):
        """Trigger, first start, last start and document of every run."""
        n = np.maximum(np.diff(starts) - self.length + 1, 0)    # strings that start in each document
        if not n.sum():
            empty = np.zeros(0, np.int64)
            return empty.astype(np.uint64), empty, empty, empty, None
        prefix = self.one.prefix(data)
        low = self.one.grams(prefix, self.trigger)
        have, want = 1, self.length - self.trigger + 1
        while have < want:                                       # minimum over `want` neighbours
            step = min(have, want - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        p = np.repeat(starts[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        v = low[p]
        new = np.ones(len(p), bool)
        new[1:] = (v[1:] != v[:-1]) | (p[1:] != p[:-1] + 1)
        at = np.flatnonzero(new)
        new[(np.arange(len(p)) - np.repeat(at, np.diff(np.concatenate([at, [len(p)]])))) % MAX_RUN == 0] = True
        at = np.flatnonzero(new)
        end = np.concatenate([at[1:], [len(p)]]) - 1
        doc = np.searchsorted(starts, p[at], side="right") - 1
        return v[at], p[at], p[end], doc, prefix

    def phrases(self, prefix, first, last):
        return self.one.spans(prefix, first, last + self.length)

    def strings(self, data, prefix, first, last):
        """Both hashes and the start of every string of the runs, and each one's run."""
        n = last - first + 1
        run = np.repeat(np.arange(len(first)), n)
        p = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else first
        second = self.two.prefix(data)
        return (self.one.spans(prefix, p, p + self.length), self.two.spans(second, p, p + self.length), p, run)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False))


def _planes(values: np.ndarray, width: int = 8) -> bytes:
    """The low ``width`` bytes of 64-bit values, byte plane by byte plane."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _pack(group: np.ndarray, x: np.ndarray, y: np.ndarray | None = None) -> tuple[np.ndarray, list, list]:
    """Per distinct value of ``group``: its hashes, in order, as differences, and
    the second ones (``_SECOND`` bytes) beside them."""
    order = np.lexsort((y, x, group)) if y is not None else np.lexsort((x, group))
    group, x = group[order], x[order]
    at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(x) else np.zeros(0, np.intp)
    ends = [*at[1:].tolist(), len(x)]
    xs = [_planes(np.diff(x[a:z], prepend=np.uint64(0))) for a, z in zip(at.tolist(), ends)]
    ys = [_planes(y[order[a:z]], _SECOND) if y is not None else b"" for a, z in zip(at.tolist(), ends)]
    return group[at], xs, ys


def _unpack(xs, ys=None) -> tuple[list, list]:
    return ([np.cumsum(_from_planes(v), dtype=np.uint64) for v in xs],
            [_from_planes(v, _SECOND) for v in ys or ()])


def _print_batch(bits: int):
    """One row per hash bucket: the prints (the next 32 bits) of its triggers."""
    def run(key, table):
        parser = Parser()
        seen = [parser.runs(starts, data)[0] for _, starts, data in parser.slices(table)]
        v = np.unique(np.concatenate(seen) >> np.uint64(32 - bits)) if seen else np.zeros(0, np.uint64)
        bucket = (v >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], np.diff(bucket) > 0])) if len(v) else np.zeros(0, np.intp)
        parts = np.split(v.astype(np.uint32), at[1:]) if len(v) else []
        return pa.table([pa.array(bucket[at]), pa.array([key[0].as_py()] * len(at), pa.int64()),
                         pa.array([p.tobytes() for p in parts], pa.binary())], ["bucket", "batch", "prints"])
    return run


def _resolve_prints(table):
    """A bucket: give each batch its prints that other batches have too."""
    prints = [np.frombuffer(p.as_py(), np.uint32) for p in table.column("prints")]
    order = np.sort(np.concatenate(prints))
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    kept = [p[np.isin(p, twice, assume_unique=True)] for p in prints]
    some = np.array([len(k) > 0 for k in kept])
    return pa.table([table.column("bucket").filter(pa.array(some)), table.column("batch").filter(pa.array(some)),
                     pa.array([k.tobytes() for k in kept if len(k)], pa.binary())], ["bucket", "batch", "prints"])


def _parse_batch(bits: int):
    """One row per shared trigger of the batch: its phrase, or that it has several."""
    def run(key, table, shared):
        parser, triggers, phrases = Parser(), [], []
        held = np.sort(np.concatenate([np.zeros(0, np.uint64), *[
            np.uint64(b.as_py() << 32) + np.frombuffer(p.as_py(), np.uint32).astype(np.uint64)
            for b, p in zip(shared.column("bucket"), shared.column("prints"))]]))
        for _, starts, data in parser.slices(table) if len(held) else ():
            v, first, last, _, prefix = parser.runs(starts, data)
            if prefix is None:
                continue
            open_ = _among(v >> np.uint64(32 - bits), held)
            v, e = v[open_], parser.phrases(prefix, first[open_], last[open_])
            order = np.lexsort((e, v))
            v, e = v[order], e[order]
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (e[1:] != e[:-1])
            triggers.append(v[new])
            phrases.append(e[new])
        v = np.concatenate(triggers) if triggers else np.zeros(0, np.uint64)
        e = np.concatenate(phrases) if phrases else np.zeros(0, np.uint64)
        order = np.lexsort((e, v))
        v, e = v[order], e[order]
        at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.intp)
        several = np.maximum.reduceat(e, at) != e[at] if len(v) else np.zeros(0, bool)
        tag = np.full(len(at), key[0].as_py() * 2) + several
        return pa.table([_long(v[at]), _long(e[at]), _long(tag)], ["trigger", "phrase", "tag"])
    return run


def _whole(batches) -> list[np.ndarray]:
    parts = list(batches)
    if not parts:
        return []
    return [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts])
            for i in range(parts[0].num_columns)]


def _owner(batch: np.ndarray, divided: list) -> np.ndarray:
    """Batches by number; those of one divided id all by its first."""
    if not divided:
        return batch
    first, parts = np.array(sorted(divided), np.int64).T
    at = np.maximum(np.searchsorted(first, batch.astype(np.int64), side="right") - 1, 0)
    inside = (batch % 2 == 1) & (batch >= first[at]) & (batch < first[at] + 2 * parts[at])
    return np.where(inside, first[at], batch.astype(np.int64))


def _from_another(same: np.ndarray, batch: np.ndarray, divided: list) -> np.ndarray:
    """Of sorted entries, where ``same`` marks one equal to the one before: those
    whose first equal is of another id range."""
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    owner = _owner(batch, divided)
    return same & (owner != owner[start])


def _phrase_resolver(divided: list):
    return lambda batches: _resolve_phrases(batches, divided)


def _resolve_phrases(batches, divided):
    """A shuffle partition of triggers: tell the batches that share one."""
    columns = _whole(batches)
    if not columns or not len(columns[0]):
        return
    v, e, tag = columns
    order = np.lexsort((tag >> 1, e, tag & 1, v))     # a trigger's single phrases first, by batch
    v, e, tag = v[order], e[order], tag[order]
    at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    n = np.diff(np.concatenate([at, [len(v)]]))
    group = np.repeat(np.arange(len(at)), n)
    several = (tag & 1) > 0
    mixed = ((np.minimum.reduceat(e, at) != np.maximum.reduceat(e, at))
             | (np.maximum.reduceat(tag & 1, at) > 0))[group]
    again = np.concatenate([[False], (v[1:] == v[:-1]) & (e[1:] == e[:-1]) & ~several[1:] & ~several[:-1]])
    again = _from_another(again, tag >> 1, divided)
    tell = (n > 1)[group] & (mixed | again)
    both, xs, ys = _pack(2 * (tag[tell] >> 1) + again[tell], v[tell].view(np.uint64))
    what = np.where(both & 1, ALL, SOME).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(both >> 1), pa.array(what), pa.array(xs, pa.binary()), pa.array(ys, pa.binary())],
                                     ["batch", "what", "xs", "ys"])


def _told(table: pa.Table, what: int) -> np.ndarray:
    rows = table.filter(pa.compute.equal(table.column("what"), what))
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *_unpack(rows.column("xs").to_pylist())[0]]))


def _among(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    if not len(held):
        return np.zeros(len(values), bool)
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values


def _send_strings(bits: int):
    """The strings of phrases whose trigger has several: one row per batch and hash
    bucket, each string once."""
    def run(key, table, told):
        parser, some, xs, ys = Parser(), _told(told, SOME), [], []
        if len(some):
            for _, starts, data in parser.slices(table):
                v, first, last, _, prefix = parser.runs(starts, data)
                if prefix is not None and (look := _among(v, some)).any():
                    x, y, _, _ = parser.strings(data, prefix, first[look], last[look])
                    xs.append(x)
                    ys.append(_second(y))
        x = np.concatenate(xs) if xs else np.zeros(0, np.uint64)
        y = np.concatenate(ys) if ys else np.zeros(0, np.uint64)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.zeros(0, bool)
        x, y = x[new], y[new]
        bucket, xs, ys = _pack((x >> np.uint64(64 - bits)).astype(np.int64), x, y)
        return pa.table([pa.array(bucket), pa.array([key[0].as_py()] * len(xs), pa.int64()),
                         pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["bucket", "batch", "xs", "ys"])
    return run


def _second(y: np.ndarray) -> np.ndarray:
    return y >> np.uint64(64 - 8 * _SECOND)


def _string_resolver(divided: list):
    def run(table):
        """A bucket of strings: tell all batches but the first that hold one."""
        xs, ys = _unpack(table.column("xs").to_pylist(), table.column("ys").to_pylist())
        batch = np.repeat(table.column("batch").to_numpy(), [len(x) for x in xs])
        x, y = np.concatenate(xs), np.concatenate(ys)
        order = np.lexsort((batch, y, x))
        x, y, batch = x[order], y[order], batch[order]
        same = np.concatenate([[False], (x[1:] == x[:-1]) & (y[1:] == y[:-1])])
        again = _from_another(same, batch, divided)
        to, xs, ys = _pack(batch[again], x[again], y[again])
        return pa.table([pa.array(to), pa.array([STRING] * len(xs), pa.int32()), pa.array(xs, pa.binary()),
                         pa.array(ys, pa.binary())], ["batch", "what", "xs", "ys"])
    return run


def _local(parser: Parser, table: pa.Table, every: np.ndarray, some: np.ndarray):
    """Triggers to look at string by string within the batch: told so, or
    occurring again in the batch and not settled already."""
    seen = []
    for _, starts, data in parser.slices(table):
        v, *_ = parser.runs(starts, data)
        seen.append(v)
    v = np.sort(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
    twice = np.unique(v[1:][v[1:] == v[:-1]])
    return np.union1d(twice[~_among(twice, every)], some)


def _remove(key, table, told):
    parser = Parser()
    table = table.sort_by("id")
    every, some = _told(told, ALL), _told(told, SOME)
    rows = told.filter(pa.compute.equal(told.column("what"), STRING))
    far = _unpack(rows.column("xs").to_pylist(), rows.column("ys").to_pylist())
    far = np.stack([np.concatenate([np.zeros(0, np.uint64), *v]) for v in far])
    far = far[:, np.lexsort((far[1], far[0]))]
    look = _local(parser, table, every, some)

    # strings of the batch by hash range, each with the place of its document's id
    edges, parts, rank, last_id = [], [[] for _ in range(_BUCKETS)], 0, None
    for k, (ids, starts, data) in enumerate(parser.slices(table)):
        edge = np.zeros(len(data) + 1, np.int32)      # +1 where a removed part begins, -1 where it ends
        edges.append(edge)
        v, first, last, doc, prefix = parser.runs(starts, data)
        ranks = rank + np.cumsum(np.concatenate([[last_id is not None and ids[0] != last_id], ids[1:] != ids[:-1]]))
        rank, last_id = int(ranks[-1]), ids[-1]
        if prefix is None:
            continue
        gone = _among(v, every)
        edge[first[gone]] += 1                        # no two runs begin or end together
        edge[last[gone] + parser.length] -= 1
        mine = _among(v, look)
        if not mine.any():
            continue
        x, y, p, run = parser.strings(data, prefix, first[mine], last[mine])
        owner, y, p = ranks[doc[mine]].astype(np.int32)[run], _second(y), p.astype(np.int32)
        bucket = (x >> np.uint64(60)).astype(np.uint8)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(_BUCKETS + 1))
        for b in range(_BUCKETS):
            take = order[ends[b]:ends[b + 1]]
            if len(take):
                parts[b].append((x[take], y[take], owner[take], np.full(len(take), k, np.int32), p[take]))
    for b in range(_BUCKETS):
        if not parts[b]:
            continue
        x, y, owner, at_slice, p = (np.concatenate(c) for c in zip(*parts[b]))
        parts[b] = None
        order = np.lexsort((owner, y, x))
        x, y, owner, at_slice, p = x[order], y[order], owner[order], at_slice[order], p[order]
        at = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        n = np.diff(np.concatenate([at, [len(x)]]))
        earlier = np.zeros(len(at), bool)
        if far.shape[1]:
            # equal (x, y) among those told: a range of equal x holds few y
            i = np.searchsorted(far[0], x[at])
            while (open_ := (i < far.shape[1]) & ~earlier).any():
                j = np.minimum(i, far.shape[1] - 1)
                here = open_ & (far[0][j] == x[at])
                if not here.any():
                    break
                earlier |= here & (far[1][j] == y[at])
                i = np.where(here, i + 1, far.shape[1])
        gone = np.repeat(earlier, n) | (owner > np.repeat(owner[at], n))
        at_slice, p = at_slice[gone], p[gone]
        for k in np.unique(at_slice):
            q = p[at_slice == k]
            edges[k][q] += 1                          # every string begins at a place of its own
            edges[k][q + parser.length] -= 1

    out = {"id": [], "n_bytes": [], "spans": [], "kept": []}
    for k, (ids, starts, data) in enumerate(parser.slices(table)):
        covered = np.cumsum(edges[k][:-1]) > 0
        # runs end with their document, even if the next one starts removed
        inner = np.concatenate([[False], covered, [False]])
        up, down = inner[1:-1] & ~inner[:-2], inner[1:-1] & ~inner[2:]
        full = starts[:-1][np.diff(starts) > 0]
        up[full] = covered[full]
        ends = starts[1:][np.diff(starts) > 0] - 1
        down[ends] = covered[ends]
        begin, end = np.flatnonzero(up), np.flatnonzero(down) + 1
        held = np.searchsorted(begin, starts)
        for d in range(len(ids)):
            s, e = starts[d], starts[d + 1]
            mine = slice(held[d], held[d + 1])
            out["id"].append(int(ids[d]))
            out["n_bytes"].append(int(e - s))
            out["spans"].append([{"start": a, "end": b} for a, b in
                                 zip((begin[mine] - s).tolist(), (end[mine] - s).tolist())])
            out["kept"].append(data[s:e][~covered[s:e]].tobytes() if held[d + 1] > held[d] else data[s:e].tobytes())
    return pa.table(out, schema=pa.schema([
        ("id", pa.int64()), ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``id, n_bytes, spans, kept`` for every row of ``docs``: the maximal
    removed runs (bytes, end exclusive) and the bytes that stay.

    Null and empty texts, and texts shorter than ``LENGTH`` bytes, keep all.
    Rows with one id are one document: they do not remove each other's bytes.
    Null ids come after all others (and count as one id, as 2^63 - 1); they are
    returned as null. An empty table gives an empty table. What a task holds is
    bounded by ``batch_bytes`` (or one text) wherever the ids lie.
    """
    last = F.lit(_NO_ID)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), last).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = min(31, max(4, (total // _PRINT_BYTES).bit_length()))
    known, divided = id_ranges(rows, F.octet_length("text"), batch_bytes)
    rows = known.select("batch", "id", "text")
    # one exchange of the texts serves every pass below
    by_batch = rows.repartition("batch").groupBy("batch")
    blob = "bucket long, batch long, prints binary"
    shared = by_batch.applyInArrow(_print_batch(bits), blob).groupBy("bucket").applyInArrow(_resolve_prints, blob)
    triggers = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(
        _parse_batch(bits), "trigger long, phrase long, tag long")
    message = "batch long, what int, xs binary, ys binary"
    told = triggers.repartition("trigger").mapInArrow(_phrase_resolver(divided), message)
    string_bits = min(31, max(4, (total // _STRING_BYTES).bit_length()))
    sent = by_batch.cogroup(told.where(F.col("what") == SOME).groupBy("batch")).applyInArrow(
        _send_strings(string_bits), "bucket long, batch long, xs binary, ys binary")
    again = sent.groupBy("bucket").applyInArrow(_string_resolver(divided), message)
    done = by_batch.cogroup(told.union(again).groupBy("batch")).applyInArrow(_remove, OUT)
    return done.withColumn("id", F.when(F.col("id") != last, F.col("id")))
