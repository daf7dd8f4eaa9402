"""Near-duplicate embeddings by an exact metric range join.

Vectors of one label and dimension are scaled to length one; cosine of at least
``similarity`` is then a distance of at most ``eps = sqrt(2 - 2 * similarity)``.
Sampled pivots partition a label's vectors into cells (nearest pivot). A vector
is replicated into another cell only where the triangle inequality allows a
partner: its distance to that pivot is at most the cell's radius plus eps, and
its distance to the bisecting plane of the two pivots is at most eps. Every pair
within eps therefore meets in the home cell of either vector, and cells join
independently of each other.

A cell is cut into blocks of bounded size that meet block by block (home block
times member block), so a cell may hold any share of the rows. A task counts
links and gives back one row per vector: never pairs. Equal vectors are one
node with a count.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.common import saved
from seqlab.llm.components import connected_components

SIMILARITY = 0.93
CELL = 1024
BLOCK = 1024
MAX_PIVOTS = 4096
_SLACK = 1e-9   # for rounding of distances: replication may be too wide, never too narrow
NODE = "vec_id long, label long, dim int, node string, unit binary"


def _parse(batches):
    for batch in batches:
        nodes, units, dims = [], [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            node = unit = dim = None
            if label is not None and vector and None not in vector:
                x = np.array(vector, np.float64)
                size = np.abs(x).max()
                if np.isfinite(size) and size > 0:
                    x = x / size                     # the norm of what remains cannot overflow
                    x = x / np.sqrt(x @ x) + 0.0     # no negative zeros
                    unit, dim = x.tobytes(), len(x)
                    node = hashlib.blake2b(unit, digest_size=16, key=f"{label}:{dim}".encode()).hexdigest()
            nodes.append(node)
            units.append(unit)
            dims.append(dim)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(nodes, pa.string()),
             pa.array(units, pa.binary())], ["vec_id", "label", "dim", "node", "unit"])


class Pivots:
    """The pivots of the labels that have any, and the geometry of their cells."""

    def __init__(self, rows: list[tuple[int, int, bytes]]):
        by: dict[tuple[int, int], list[bytes]] = {}
        for label, dim, unit in rows:
            by.setdefault((label, dim), []).append(unit)
        self.points = {k: np.stack([np.frombuffer(u) for u in sorted(set(v))]) for k, v in by.items()}

    def groups(self, batch):
        """Rows of a batch by (label, dim), as indices and a matrix."""
        by: dict[tuple[int, int], list[int]] = {}
        for i, k in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist())):
            by.setdefault(k, []).append(i)
        units = batch.column("unit")
        for k, rows in by.items():
            yield k, rows, np.stack([np.frombuffer(units[i].as_py()) for i in rows])

    def distances(self, key, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ self.points[key].T)))


def _homes(pivots):
    def run(batches):
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for k, rows, x in pivots.value.groups(batch):
                if k in pivots.value.points:
                    d = pivots.value.distances(k, x)
                    cell[rows], far[rows] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("dim"), pa.array(cell),
                                              pa.array(far)], ["label", "dim", "cell", "far"])
    return run


def _cells_of(p, radius, eps, key, x):
    """Home cell of each row, and the cells in which it may have partners."""
    if key not in p.points:
        home = np.zeros(len(x), np.intp)
        return home, np.ones((len(x), 1), bool)
    d = p.distances(key, x)
    home = d.argmin(axis=1)
    near = d.min(axis=1)[:, None]
    between = np.sqrt(np.maximum(0.0, 2 - 2 * (p.points[key] @ p.points[key].T)))[home]
    reach = np.array([radius.get((*key, c), -1.0) for c in range(d.shape[1])])
    into = (d <= reach + eps + _SLACK) & (reach >= 0) & (d * d - near * near <= 2 * eps * between + _SLACK)
    into[np.arange(len(x)), home] = True
    return home, into


def _block(node: str, blocks: int) -> int:
    return int(node[:15], 16) % blocks


def _members(pivots, radius, eps):
    def run(batches):
        for batch in batches:
            out = {"label": [], "dim": [], "cell": [], "home": []}
            for k, _, x in pivots.value.groups(batch):
                home, into = _cells_of(pivots.value, radius.value, eps, k, x)
                row, cell = np.nonzero(into)
                out["label"] += [k[0]] * len(row)
                out["dim"] += [k[1]] * len(row)
                out["cell"] += cell.tolist()
                out["home"] += (home[row] == cell).tolist()
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("label", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("home", pa.bool_())]))
    return run


_DEALT = pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("home_block", pa.int32()),
                    ("block", pa.int32()), ("home", pa.bool_()), ("node", pa.string()), ("n", pa.int64()),
                    ("unit", pa.binary())])


def _deal(pivots, radius, blocks, eps):
    """Copies of every node for the (home block, member block) pairs it takes part in."""
    def run(batches):
        for batch in batches:
            nodes, counts, units = (batch.column(c).to_pylist() for c in ("node", "n", "unit"))
            sizes = batch.column("group_n").to_pylist()
            rows = []
            for k, index, x in pivots.value.groups(batch):
                home, into = _cells_of(pivots.value, radius.value, eps, k, x)
                for r, i in enumerate(index):
                    for c in np.flatnonzero(into[r]).tolist():
                        whole = -(-sizes[i] // BLOCK)   # a label without pivots is one cell
                        homes, members = blocks.value.get((*k, c), (whole, whole))
                        own, mine = _block(nodes[i], homes), _block(nodes[i], members)
                        copies = [(b, mine, False) for b in range(homes)]
                        if home[r] == c:
                            copies += [(own, b, True) for b in range(members)]
                        rows += [(k[0], k[1], c, a, b, is_home, nodes[i], counts[i], units[i])
                                 for a, b, is_home in copies]
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, f.type) for v, f in zip(zip(*rows), _DEALT)], schema=_DEALT)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _DEALT)],
                                                 schema=_DEALT)
    return run


def _meet(similarity):
    def run(table):
        # links of the home block with the member block, and what they connect
        flag = table.column("home").to_numpy()
        nodes, n = table.column("node").to_pylist(), table.column("n").to_numpy()
        x = np.stack([np.frombuffer(u.as_py()) for u in table.column("unit")])
        h, m = np.flatnonzero(flag), np.flatnonzero(~flag)
        if not len(h) or not len(m):
            return pa.Table.from_pylist([], schema=_MET)
        link = x[h] @ x[m].T >= similarity
        links = link @ n[m]
        # smallest node around, until nothing changes: components of this pair of blocks
        rank = {v: i for i, v in enumerate(sorted(set(nodes)))}
        label = np.array([rank[v] for v in nodes], np.int64)
        top = len(rank)
        while True:
            a = np.minimum(label[h], np.where(link, label[m][None, :], top).min(axis=1))
            b = np.minimum(label[m], np.where(link, a[:, None], top).min(axis=0))
            if (a == label[h]).all() and (b == label[m]).all():
                break
            label[h], label[m] = a, b
        names = sorted(rank)
        seen = link.any(axis=0)
        out_nodes = [nodes[i] for i in h] + [nodes[i] for i in m[seen]]
        return pa.table({"node": out_nodes, "links": np.concatenate([links, np.zeros(int(seen.sum()), np.int64)]),
                         "root": [names[i] for i in label[h]] + [names[i] for i in label[m[seen]]]}, schema=_MET)
    return run


_MET = pa.schema([("node", pa.string()), ("links", pa.int64()), ("root", pa.string())])


def link_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", similarity: float = SIMILARITY) -> DataFrame:
    """``vec_id, n_links, component_id`` for every row of ``vectors``.

    Rows whose label is null, or whose vector is null, empty, zero or holds
    null or non-finite components, have no links and are their own component;
    vectors of different length never link. Repeated rows count as further
    vectors. Null ids count as links but are never a component's id unless all
    are null. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    eps = math.sqrt(2 - 2 * similarity)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    parsed = saved(rows.mapInArrow(_parse, NODE), "vectors")
    nodes = parsed.where("node is not null").groupBy("label", "dim", "node").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("unit").alias("unit"))
    groups = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("group_n"))
    nodes = saved(nodes.join(groups, ["label", "dim"]), "vector-nodes")

    # a share of the nodes, by hash, as pivots of labels larger than a cell; MAX_PIVOTS about in all
    total = nodes.count()
    share = min(1 / CELL, MAX_PIVOTS / max(total, 1))
    draw = F.pmod(F.xxhash64(F.lit("pivot"), "node"), F.lit(1 << 30)) / float(1 << 30)
    chosen = nodes.where((F.col("group_n") > CELL) & (draw < share)).select("label", "dim", "unit").collect()
    pivots = spark.sparkContext.broadcast(Pivots([tuple(r) for r in chosen]))
    units = nodes.select("label", "dim", "node", "n", "unit", "group_n")
    keyed = groups_with(spark, pivots.value.points)
    pivoted = units.join(F.broadcast(keyed), ["label", "dim"])
    far = pivoted.mapInArrow(_homes(pivots), "label long, dim int, cell int, far double").groupBy(
        "label", "dim", "cell").agg(F.max("far").alias("far"))
    radius = spark.sparkContext.broadcast({   # one row per cell: about MAX_PIVOTS
        (r["label"], r["dim"], r["cell"]): r["far"] for r in far.collect()})
    counts = pivoted.mapInArrow(_members(pivots, radius, eps), "label long, dim int, cell int, home boolean")
    counts = counts.groupBy("label", "dim", "cell").agg(
        F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("members"))
    blocks = spark.sparkContext.broadcast({
        (r["label"], r["dim"], r["cell"]): (max(1, -(-r["homes"] // BLOCK)), max(1, -(-r["members"] // BLOCK)))
        for r in counts.collect()})
    dealt = units.mapInArrow(_deal(pivots, radius, blocks, eps),
                             "label long, dim int, cell int, home_block int, block int, home boolean, node string, "
                             "n long, unit binary")
    met = saved(dealt.groupBy("label", "dim", "cell", "home_block", "block").applyInArrow(
        _meet(similarity), "node string, links long, root string"), "vector-links")

    component = connected_components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = met.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "least").join(degree, "node").join(component, "node")
    first = known.groupBy("component").agg(F.min("least").alias("first"))
    known = known.join(first, "component").select("node", "links", "first")
    out = parsed.select("vec_id", "node").join(known, "node", "left")
    return out.select("vec_id", F.coalesce(F.col("links") - 1, F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("first", "vec_id").alias("component_id"))


def groups_with(spark, keys) -> DataFrame:
    """The (label, dim) pairs that have pivots, as a table (at most MAX_PIVOTS rows)."""
    return spark.createDataFrame(sorted(keys), "label long, dim int")
