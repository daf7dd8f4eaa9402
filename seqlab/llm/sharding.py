"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring of hash values. A row's key is
hashed onto the ring and belongs to the arc that ends at the next point
clockwise. A shard holds at most its capacity; what overflows continues to the
next point clockwise, and so on, until it meets a shard with room.

Capacities are ``ceil(n / shards)`` for the first ``n mod shards`` shards and
``floor(n / shards)`` for the others: they add up to ``n``, so every shard ends
exactly full and row counts are at most one apart (law ``rows``).

The overflow is settled on counts per arc (``shards * vnodes`` numbers, bounded
by the ring, whatever the input), not on rows. The rows then only need their
rank within their arc: arcs are cut into narrow cells of the hash space whose
number follows the row count, ranks within a cell come from a window over that
cell, and cell offsets from a window over the counts. Everything is DataFrame
functions; no row meets Python.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VNODES = 64
ROWS_PER_CELL = 20_000
_RING_BITS = 32


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(point, shard) clockwise. A shard's points depend on its number only,
    so one more shard adds points and moves none."""
    points = {}
    for s in range(shards):
        for v in range(vnodes):
            p = zlib.crc32(f"shard {s} point {v}".encode())
            while p in points:
                p = (p + 1) % (1 << _RING_BITS)
            points[p] = s
    return sorted(points.items())


def settle(points: list[tuple[int, int]], demand: dict[int, int], capacity: list[int]
           ) -> list[tuple[int, int, int, int, int]]:
    """Pieces (arc, first rank, last rank + 1, shard, first slot): each round
    every arc offers what it still holds to the next point clockwise."""
    room, used, pieces = list(capacity), [0] * len(capacity), []
    waiting = [(arc, 0, demand.get(arc, 0)) for arc in range(len(points))]
    for step in range(len(points)):
        later = []
        for arc, lo, hi in waiting:
            if lo == hi:
                continue
            shard = points[(arc + step) % len(points)][1]
            n = min(room[shard], hi - lo)
            if n:
                pieces.append((arc, lo, lo + n, shard, used[shard]))
                room[shard] -= n
                used[shard] += n
            if lo + n < hi:
                later.append((arc, lo + n, hi))
        waiting = later
        if not waiting:
            break
    return pieces


def _small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows (bounded by the ring) as a table, without Python rows in the plan."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    return spark.range(1).select(F.inline(parsed))


def assign_shards(rows: DataFrame, shards: int, key: str, ties: list[str] | None = None,
                  vnodes: int = VNODES, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``rows`` with ``shard int`` and ``slot long`` (gapless from 0 in each shard).

    ``key`` is hashed onto the ring; within an arc rows are ordered by hash,
    key and ``ties``. Rows equal in all of these are interchangeable. Rows with
    a null key are hashed by their ``ties``; an empty table gives an empty
    table. ``key`` should tell rows apart (an id): rows of one key share a cell.
    """
    spark = rows.sparkSession
    points = ring(shards, vnodes)
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    # cells: equal ranges of the hash space, their number a power of two
    bits = min(30, max(8, (max(1, total // rows_per_cell) - 1).bit_length()))
    width = 1 << (_RING_BITS - bits)

    # the ring as 256 rows: a sector's points, and how many lie before them
    sector = 1 << (_RING_BITS - 8)
    hashes = [p for p, _ in points]
    cuts = [bisect_left(hashes, i * sector) for i in range(257)]
    sectors = _small_table(spark, [
        {"sector": i, "before": cuts[i], "points": hashes[cuts[i]:cuts[i + 1]]} for i in range(256)],
        "sector int, before int, points array<bigint>")
    names = rows.columns
    h = F.col("__h")
    hashed = F.coalesce(F.when(F.col(key).isNotNull(), F.xxhash64(F.lit("ring"), key)),
                        F.xxhash64(F.lit("ring"), *(ties or [key])))
    placed = rows.withColumn("__h", F.shiftrightunsigned(hashed, 64 - _RING_BITS))
    placed = placed.join(F.broadcast(sectors), F.floor(h / sector).cast("int") == F.col("sector"))
    arc = (F.col("before") + F.size(F.filter("points", lambda p: p < h))) % len(points)
    placed = placed.select(*names, "__h", arc.cast("int").alias("__arc"), F.floor(h / width).cast("int").alias("__cell"))

    counts = placed.groupBy("__arc", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    # at most one number per point of the ring
    demand = {r["__arc"]: r["n"] for r in counts.groupBy("__arc").agg(F.sum("__n").alias("n")).collect()}
    fields = ("p_arc", "p_lo", "p_hi", "p_shard", "p_slot")
    pieces = _small_table(spark, [dict(zip(fields, x)) for x in settle(points, demand, capacity)],
                          "p_arc int, p_lo bigint, p_hi bigint, p_shard int, p_slot bigint")

    # the last arc wraps around: its high hashes come first, then the low ones
    turn = F.when((F.col("__arc") == 0) & (F.col("__cell") >= (1 << bits) // 2), -1).otherwise(0)
    before = Window.partitionBy("__arc").orderBy(turn, "__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__arc").alias("o_arc"), F.col("__cell").alias("o_cell"),
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("o_before"))
    order = [h.asc(), F.col(key).asc(), *[F.col(c).asc() for c in ties or []]]
    within = Window.partitionBy("__arc", "__cell").orderBy(*order)
    ranked = placed.withColumn("__r", F.row_number().over(within) - 1)
    ranked = ranked.join(offsets, (F.col("__arc") == F.col("o_arc")) & (F.col("__cell") == F.col("o_cell")))
    ranked = ranked.withColumn("__rank", F.col("o_before") + F.col("__r"))
    # pieces: at most one per point and round with room, bounded by the ring
    return ranked.join(F.broadcast(pieces), (F.col("__arc") == F.col("p_arc"))
                       & (F.col("__rank") >= F.col("p_lo")) & (F.col("__rank") < F.col("p_hi"))).select(
        *names, F.col("p_shard").alias("shard"), (F.col("p_slot") + F.col("__rank") - F.col("p_lo")).alias("slot"))
