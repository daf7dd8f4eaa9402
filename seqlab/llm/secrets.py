"""Secret scan with multipart credential linking.

Format matches (``BASE``) are always reported. Weak candidates - account
identifiers, free-standing high-entropy strings, service endpoints - say
little alone; they become intervals ``[start, end)`` within a document and are
joined on overlap of their *scopes*: two parts are linked when the gap between
them is at most ``scope`` code points. A weak candidate is reported only when
parts of complementary kinds (an identifier for a secret, a secret for an
identifier, both for an endpoint) lie in its scope. The join is a semi-join on
(document, scope cell): one row per candidate whatever the number of partners.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import id_and_text, saved, text_slices

# fixed values: base formats, in the order of their kinds
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]{14,}")),   # of the whole run of A-Z0-9: 18 or more
    ("hex", re.compile(r"[0-9a-f]{16,}")),          # a whole run of 16 or more
)
MIN_ASSIGNED = 12
WEAK = (
    ("identifier", re.compile(r"""(?:AKIA|ASIA)[A-Z0-9]{8,}|(?:user(?:name)?|login|client_?id|account)["']?"""
                              r"""\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)),
    ("key", re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")),
    ("endpoint", re.compile(r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+"
                            r"|[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5}(?![0-9])")),
)
# which partners make a weak candidate worth reporting
PARTNERS = {"identifier": ("key",), "key": ("identifier", "endpoint"), "endpoint": ("key",)}
# a run of a key that is no word: long enough, with digits and letters
_RUN = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z]).{16,}")
SCOPE = 200
MIN_ENTROPY = 3.5
_SPAN = "struct<start:int,rank:int,kind:string,end:int>"
SCHEMA = f"id long, row_hash long, base array<{_SPAN}>, weak array<{_SPAN}>"
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()),
                                  ("kind", pa.string()), ("end", pa.int32())]))
_ARROW = pa.schema([("id", pa.int64()), ("row_hash", pa.int64()),
                    ("base", _ARROW_SPAN), ("weak", _ARROW_SPAN)])


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """Format matches as (start, rank of the kind, kind, end), sorted."""
    return sorted((m.start(), rank, kind, m.end()) for rank, (kind, pattern) in enumerate(BASE)
                  for m in pattern.finditer(text)
                  if kind != "assign" or len(m.group(2)) >= MIN_ASSIGNED)


def weak_spans(text: str, base: list) -> list[tuple[int, int, str, int]]:
    """Weak candidates that overlap no format match, sorted."""
    found = []
    for rank, (kind, pattern) in enumerate(WEAK, len(BASE)):
        for m in pattern.finditer(text):
            s = m.group()
            if kind == "key" and not (entropy(s) >= MIN_ENTROPY and any(map(_RUN.fullmatch, re.split("[/_-]+", s)))):
                continue
            found.append((m.start(), rank, kind, m.end()))
    starts = [b[0] for b in base]
    reach = list(accumulate((b[3] for b in base), max, initial=0))   # the furthest end of the first bases
    return [span for span in sorted(found) if reach[bisect_left(starts, span[3])] <= span[0]]


def _scan(batches):
    names = [f.name for f in _ARROW_SPAN.value_type]
    for part in text_slices(batches, column=2):
        rows = []
        for i, h, text in zip(*(part.column(c).to_pylist() for c in range(3))):
            base = base_spans(text)
            weak = weak_spans(text, base)
            rows.append({"id": i, "row_hash": h, "base": [dict(zip(names, x)) for x in base],
                         "weak": [dict(zip(names, x)) for x in weak]})
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _cells(start, end, width):
    return F.explode(F.sequence(F.floor(start / width).cast("int"), F.floor(end / width).cast("int")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 scope: int = SCOPE) -> DataFrame:
    """``id, base, linked``: per row of ``docs`` the format matches and the
    weak candidates with a complementary part within ``scope`` code points,
    each a sorted array of (start, rank, kind, end).

    Null and empty texts have no spans; a null id stays null and its parts
    link only within the same text; repeated rows get the same result each;
    an empty table gives an empty table. The scan runs once and its spans
    (no texts) are written to the shared folder; only those are shuffled.
    """
    rows = id_and_text(docs, id_col, text_col).select("id", F.xxhash64("text").alias("row_hash"), "text")
    scan = saved(rows.mapInArrow(_scan, SCHEMA), "secrets")
    doc = ["id", "row_hash"]
    weak = scan.where(F.size("weak") > 0).select(*doc, "base", "weak").dropDuplicates(doc)

    # as partners the format matches play the part their format shows
    role = F.when(F.col("p.kind") == "access", "identifier").when(
        F.col("p.kind").isin("assign", "hex"), "key").otherwise(F.col("p.kind"))
    width = max(1, 4 * scope)
    partners = weak.select(*doc, F.explode(F.concat("base", "weak")).alias("p")).select(
        *doc, role.alias("role"), F.col("p.start").alias("p_start"), F.col("p.end").alias("p_end"),
        _cells(F.col("p.start"), F.col("p.end"), width).alias("cell"))
    wanted = F.create_map(*[x for k, v in PARTNERS.items()
                            for x in (F.lit(k), F.array(*map(F.lit, v)))])
    asked = weak.select(*doc, F.explode("weak").alias("w")).select(
        *doc, "w", F.explode(wanted[F.col("w.kind")]).alias("role")).select(
        *doc, "w", "role", _cells(F.greatest(F.col("w.start") - scope, F.lit(0)),
                                  F.col("w.end") + scope, width).alias("cell"))
    a, p = asked.alias("a"), partners.alias("p")
    near = ((F.col("p.p_start") - F.col("a.w.end") <= scope)
            & (F.col("a.w.start") - F.col("p.p_end") <= scope)
            & ((F.col("p.p_start") >= F.col("a.w.end")) | (F.col("p.p_end") <= F.col("a.w.start"))))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*doc, "cell", "role"]]
    on = near
    for c in same:
        on = on & c
    linked = a.join(p, on, "left_semi").groupBy(*doc).agg(F.collect_set("w").alias("linked"))
    s, k = scan.alias("s"), linked.alias("k")
    empty = F.array().cast(f"array<{_SPAN}>")
    return s.join(k, F.col("s.id").eqNullSafe(F.col("k.id")) & (F.col("s.row_hash") == F.col("k.row_hash")),
                  "left").select("s.id", "s.base",
                                 F.array_sort(F.coalesce("k.linked", empty)).alias("linked"))
