"""Embedding near-duplicates by dual traversal of cover trees."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempoflow.llm.common import staged
from tempoflow.llm.components import components
from tempoflow.llm.vectors import matrix, usable

THRESHOLD = 0.98
BLOCK = 2048
PIVOTS = 2048
LAST_RADIUS = 0.25
SLACK = 1e-9


class CoverTree:
    """Nested levels of centres with halving radii over unit vectors; each level keeps the covering radius that it has in fact.

    ``levels[l]`` has the members' centre of that level for each point; the first level is one node over all points.
    """

    def __init__(self, points: np.ndarray, last: float = LAST_RADIUS):
        self.points = points
        distance = np.sqrt(np.maximum(0, 2 - 2 * (points @ points.T))) if len(points) else np.empty((0, 0))
        self.levels: list[np.ndarray] = [np.zeros(len(points), np.int64)]
        radius = 1.0
        while radius >= last and len(points):
            parent, centre = self.levels[-1], np.full(len(points), -1)
            for top in np.unique(parent):
                members = np.flatnonzero(parent == top)
                open_ = np.ones(len(members), bool)
                at = int(np.flatnonzero(members == top)[0])
                while True:
                    near = open_ & (distance[members[at], members] <= radius)
                    near[at] = True
                    centre[members[near]] = members[at]
                    open_ &= ~near
                    if not open_.any():
                        break
                    at = int(open_.argmax())
            self.levels.append(centre)
            radius /= 2
        self.nodes = [np.unique(level) for level in self.levels]
        self.radii = []
        for level, nodes in zip(self.levels, self.nodes, strict=True):
            reach = np.zeros(len(points))
            np.maximum.at(reach, level, distance[np.arange(len(points)), level] if len(points) else [])
            self.radii.append(reach[nodes])


def threshold_pairs(a: CoverTree, b: CoverTree, originals: tuple[np.ndarray, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a point of ``a`` and one of ``b`` with at least that cosine.

    Both trees are descended together. A pair of nodes is dropped, with all below it, if its centres are farther apart than
    the covering radii and the threshold allow; what is left at the last level is compared point by point.
    """
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    alive = np.ones((1, 1), bool)
    for level in range(len(a.levels)):
        rows, columns = a.nodes[level], b.nodes[level]
        if level:
            up_r = np.searchsorted(a.nodes[level - 1], a.levels[level - 1][rows])
            up_c = np.searchsorted(b.nodes[level - 1], b.levels[level - 1][columns])
            alive = alive[np.ix_(up_r, up_c)]
        limit = a.radii[level][:, None] + b.radii[level][None, :] + reach
        if alive.mean() > 1 / 16:
            apart = np.sqrt(np.maximum(0, 2 - 2 * (a.points[rows] @ b.points[columns].T)))
            alive &= apart <= limit + SLACK
        else:
            i, j = np.nonzero(alive)
            for k in range(0, len(i), 100_000):
                x, y = i[k : k + 100_000], j[k : k + 100_000]
                apart = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", a.points[rows[x]], b.points[columns[y]])))
                alive[x, y] = apart <= limit[x, y] + SLACK
        if not alive.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
    left = np.searchsorted(a.nodes[-1], a.levels[-1])
    right = np.searchsorted(b.nodes[-1], b.levels[-1])
    x, y = originals
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    found_i, found_j = [], []
    width = max(1, 2_000_000 // max(1, len(right)))
    for k in range(0, len(left), width):
        i, j = np.nonzero(alive[np.ix_(left[k : k + width], right)])
        i += k
        for m in range(0, len(i), 100_000):
            p, q = i[m : m + 100_000], j[m : m + 100_000]
            cosine = (x[p] * y[q]).sum(axis=1) / (nx[p] * ny[q])
            found_i.append(p[cosine >= threshold])
            found_j.append(q[cosine >= threshold])
    return np.concatenate(found_i), np.concatenate(found_j)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Rows of (i, j) that connect what all of them connect."""
    label, keep = np.arange(n), []
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    bounds = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1], [True]))) if len(i) else [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own, others = i[a], j[a:b]
        new, first = np.unique(label[others], return_index=True)
        joined = new != label[own]
        keep += (a + first[joined]).tolist()
        label[np.isin(label, new)] = label[own]
    return np.stack((i[keep], j[keep])) if keep else np.empty((2, 0), np.int64)


OUT = "kind int, a long, b long"


def _unit(threshold: float):
    """Work of one pair of blocks: links of each vector (kind 0: vector, weight) and edges that connect them (kind 1)."""

    def run(table: pa.Table) -> pa.Table:
        node, n = table["node"].to_numpy(), table["n"].to_numpy()
        side, x = table["side"].to_numpy(), matrix(table["embedding"])
        unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        first = np.flatnonzero(side == 0)
        second = first if table["same"][0].as_py() else np.flatnonzero(side == 1)
        if not len(first) or not len(second):
            return pa.table({"kind": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        own = CoverTree(unit[first])
        other = own if second is first else CoverTree(unit[second])
        i, j = threshold_pairs(own, other, (x[first], x[second]), threshold)
        i, j = first[i], second[j]
        if second is first:
            i, j = i[i != j], j[i != j]
            weight = np.bincount(i, n[j], len(node))
        else:
            weight = np.bincount(i, n[j], len(node)) + np.bincount(j, n[i], len(node))
        edges = _forest(i, j, len(node))
        linked = np.flatnonzero(weight)
        kind = np.repeat([0, 1], [len(linked), edges.shape[1]])
        a = np.concatenate((node[linked], node[edges[0]]))
        b = np.concatenate((weight[linked].astype(np.int64), node[edges[1]]))
        return pa.table({"kind": pa.array(kind, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


class Cells:
    """The top of the cover tree over a whole label: pivots, and after :meth:`measure` the cells' radii and sizes.

    At most :data:`PIVOTS` pivots in all, so the table that every task gets has a fixed bound.
    """

    def __init__(self, pivots: dict):
        self.pivots = pivots
        self.radius: dict = {}
        self.blocks: dict = {}

    def nearest(self, group: tuple, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each unit vector, and its distance to every pivot of its group."""
        pivots = self.pivots.get(group)
        if pivots is None:
            return np.zeros(len(x), np.int64), np.zeros((len(x), 1))
        apart = np.sqrt(np.maximum(0, 2 - 2 * (x @ pivots.T)))
        return apart.argmin(axis=1), apart

    def measure(self, rows, block: int) -> None:
        for r in rows:
            group = (r.label, r.dim)
            self.radius.setdefault(group, {})[r.cell] = r.radius
            self.blocks.setdefault(group, {})[r.cell] = -(-r.size // block)


def _pivots(distinct: DataFrame, block: int, pivots: int) -> list:
    """At most ``pivots`` rows ``label, dim, embedding``: for each label above one block about one vector a block.

    The largest labels come first and get their share of the budget. A hash of the node lets through about twice a label's share
    before any shuffle, so no task ever holds a whole label.
    """
    sizes = distinct.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    large = sizes.orderBy(F.desc("size"), "label", "dim").limit(pivots).collect()
    wanted = [-(-r["size"] // block) for r in large]
    scale = min(1.0, pivots / max(1, sum(wanted)))
    shares = [max(1, int(w * scale)) for w in wanted]
    while sum(shares) > pivots:
        shares[shares.index(max(shares))] -= 1
    if not shares:
        return []
    bounds = [(r.label, r.dim, share, (2 * share + 32) / r["size"]) for r, share in zip(large, shares, strict=True)]
    limits = distinct.sparkSession.createDataFrame(bounds, "label long, dim int, share int, part double")
    near = F.shiftrightunsigned(F.xxhash64("node"), 1) / F.lit(2.0**63)
    some = distinct.join(F.broadcast(limits), ["label", "dim"]).where(near < F.col("part"))  # one row a label, at most ``pivots``
    ranked = Window.partitionBy("label", "dim").orderBy(F.shiftrightunsigned(F.xxhash64("node"), 1), "node")
    return some.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= F.col("share")).select("label", "dim", "embedding").collect()


def links(distinct: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``kind, a, b`` (see :func:`_unit`) over different vectors ``label, dim, node, n, embedding``.

    Every vector goes to the cell of its nearest pivot. A cell is cut by a hash into blocks, and each pair of blocks of a label is
    one unit of work, unless covering radii part the cells; of a cell, only vectors that lie near enough to the other one are
    sent there. No task holds more than two blocks, whatever a label's size.
    """
    spark = distinct.sparkSession
    distinct = distinct.withColumn("label", F.col("label").cast("long"))
    held: dict = {}
    for r in _pivots(distinct, block, pivots):
        v = np.array(r.embedding, np.float64)
        held.setdefault((r.label, r.dim), []).append(v / math.sqrt(v @ v))
    cells = Cells({k: np.stack(v) for k, v in held.items()})
    first = spark.sparkContext.broadcast(cells)

    def groups(batch: pa.RecordBatch):
        label, dim = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
        for key in set(zip(label.tolist(), dim.tolist(), strict=True)):
            rows = np.flatnonzero((label == key[0]) & (dim == key[1]))
            x = matrix(batch.column("embedding").take(pa.array(rows)))
            yield key, rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def assign(batches):
        for batch in batches:
            cell, reach = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for key, rows, x in groups(batch):
                cell[rows], apart = first.value.nearest(key, x)
                reach[rows] = apart.min(axis=1)
            cut = pa.array([key in first.value.pivots for key in zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("dim"), pa.array(cell), pa.array(reach), cut], names=["label", "dim", "cell", "reach", "cut"])

    placed = distinct.select("label", "dim", "embedding").mapInArrow(assign, "label long, dim int, cell long, reach double, cut boolean")
    # groups without pivots have one cell; only the others are measured, at most one row per pivot
    known = placed.groupBy("label", "dim", "cell").agg(F.max("reach").alias("radius"), F.count(F.lit(1)).alias("size"), F.max("cut").alias("cut"))
    big = known.where((F.col("size") > block) | F.col("cut"))
    cells.measure(big.collect(), block)
    second = spark.sparkContext.broadcast(cells)
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    names = ["label", "dim", "c1", "b1", "c2", "b2", "node", "n", "side", "same", "embedding"]

    def deal(batches):
        for batch in batches:
            node = batch.column("node").to_numpy()
            out = [[] for _ in range(7)]
            for key, rows, x in groups(batch):
                all_ = second.value
                cell, apart = all_.nearest(key, x)
                radius, blocks = all_.radius.get(key, {}), all_.blocks.get(key, {})
                pivots_ = all_.pivots.get(key)
                for c in range(apart.shape[1]):
                    mine = rows[cell == c]
                    if not len(mine):
                        continue
                    count = blocks.get(c, 1)
                    own = (node[mine].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % count
                    for d in range(apart.shape[1]):
                        take = np.ones(len(mine), bool)
                        if d != c:
                            if d not in radius or np.sqrt(max(0, 2 - 2 * float(pivots_[c] @ pivots_[d]))) > radius.get(c, 0) + radius[d] + reach:
                                continue
                            take = apart[cell == c, d] <= radius[d] + reach
                        for e in range(blocks.get(d, 1)):
                            sel, b = mine[take], own[take]
                            swap = (d < c) | ((d == c) & (e < b))
                            same = (d == c) & (b == e)
                            for o, v in zip(out, (sel, np.where(swap, d, c), np.where(swap, e, b), np.where(swap, c, d), np.where(swap, b, e), np.where(swap, 1, 0), same), strict=True):
                                o.append(np.broadcast_to(v, sel.shape))
            if not out[0]:
                continue
            at, c1, b1, c2, b2, side, same = (np.concatenate(o) for o in out)
            taken = batch.take(pa.array(at))
            columns = [taken.column("label"), taken.column("dim"), *(pa.array(v.astype(np.int32)) for v in (c1, b1, c2, b2)), taken.column("node"), taken.column("n"), pa.array(side.astype(np.int32)), pa.array(same), taken.column("embedding")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(distinct.dtypes)["embedding"]
    schema = f"label long, dim int, c1 int, b1 int, c2 int, b2 int, node long, n long, side int, same boolean, embedding {kind}"
    dealt = distinct.select("label", "dim", "node", "n", "embedding").mapInArrow(deal, schema)
    return dealt.groupBy("label", "dim", "c1", "b1", "c2", "b2").applyInArrow(_unit(threshold), OUT)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: vectors of one label linked by a cosine of at least ``threshold``.

    Cosines are taken in double precision on the vectors as they are. Vectors without a label, null, empty, zero or with a null or
    non-finite component link with nothing, and so do vectors of different lengths. ``n_links`` counts rows, equal vectors included;
    those are one node with a count from the first grouping on and are never paired. ``component_id`` is the smallest id
    that links reach, ``kept`` says that it is the row's own. Rows with a null id take part and have a null ``kept``; of
    repeated rows each is one more vector with that id; other columns are ignored, an empty table gives no rows. Labels that are not
    integers are compared by 64 bits of their text.
    """
    keys = [F.xxhash64("label", "embedding").alias("v1"), F.xxhash64(F.lit(5), F.col("embedding"), F.col("label")).alias("v2")]
    valid = usable() & F.col("label").isNotNull()
    whole = dict(vectors.dtypes)["label"] in ("tinyint", "smallint", "int", "bigint")
    label = F.col("label").cast("long") if whole else F.when(F.col("label").isNotNull(), F.xxhash64(F.col("label").cast("string")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding")
    grouped = rows.where(valid).select("*", *keys).groupBy("v1", "v2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
    distinct = staged(grouped.select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("node")), "vectors")
    found = staged(links(distinct, threshold, block, pivots), "links")
    weights = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    roots = components(found.where("kind = 1").select("a", "b"))
    named = distinct.select("v1", "v2", "node", "n", "first_id").join(weights, "node", "left").join(roots, "node", "left")
    named = named.select("v1", "v2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = named.join(least, "root").select("v1", "v2", "n_links", "component_id").repartition(F.xxhash64("v1", "v2"))
    asked = rows.select("vec_id", *(F.when(valid, k).alias(n) for k, n in zip(keys, ("v1", "v2"), strict=True)))
    joined = asked.join(result, ["v1", "v2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
