"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempoflow.llm.common import staged
from tempoflow.llm.vectors import matrix, usable

SAMPLE = 20_000
BRANCH = 8
LEAF = 40
CALIBRATION = 128
TARGET = 0.97
MEMBERS = 8192
QUERIES = 1024


class Tree:
    """Hierarchical k-means over a sample: nodes are split into ``branch`` clusters until they hold ``leaf`` vectors or fewer.

    The inner product is made a distance by one more coordinate: a vector gets what its squared length lacks of the longest
    one's, a query gets zero; then the largest product is the smallest distance.
    """

    def __init__(self, sample: np.ndarray, longest: float, branch: int = BRANCH, leaf: int = LEAF, seed: int = 3):
        self.longest = longest
        self.children: list[list[int]] = [[]]
        self.leaf_of: list[int] = [-1]
        self.leaves = 0
        centres = [np.zeros(sample.shape[1] + 1)]
        rng = np.random.default_rng(seed)
        todo = [(0, self.lifted(sample))]
        while todo:
            node, points = todo.pop(0)
            groups = self._split(points, branch, rng) if len(points) > leaf else []
            if len(groups) < 2:
                self.leaf_of[node] = self.leaves
                self.leaves += 1
                continue
            for centre, members in groups:
                self.children[node].append(len(centres))
                todo.append((len(centres), members))
                centres.append(centre)
                self.children.append([])
                self.leaf_of.append(-1)
        self.centres = np.stack(centres)
        self.squares = (self.centres**2).sum(axis=1)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.longest - (x * x).sum(axis=1)))
        return np.column_stack((x, rest))

    @staticmethod
    def _split(points: np.ndarray, branch: int, rng) -> list[tuple[np.ndarray, np.ndarray]]:
        centres = points[rng.choice(len(points), min(branch, len(points)), replace=False)]
        label = np.zeros(len(points), int)
        for _ in range(8):
            label = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
            centres = np.stack([points[label == k].mean(axis=0) if (label == k).any() else centres[k] for k in range(len(centres))])
        label = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        return [(centres[k], points[label == k]) for k in range(len(centres)) if (label == k).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector, by the nearest centre at every level."""
        points, node = self.lifted(x), np.zeros(len(x), int)
        out = np.full(len(x), -1)
        while (live := np.flatnonzero(out < 0)).size:
            for parent in np.unique(node[live]):
                rows = live[node[live] == parent]
                if not self.children[parent]:
                    out[rows] = self.leaf_of[parent]
                    continue
                kids = np.array(self.children[parent])
                node[rows] = kids[(self.squares[kids] - 2 * points[rows] @ self.centres[kids].T).argmin(axis=1)]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves for a query: of all open nodes, the one with the nearest centre is taken next."""
        distance = self.squares - 2 * self.centres[:, :-1] @ query
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if self.leaf_of[node] >= 0:
                found.append(self.leaf_of[node])
            for kid in self.children[node]:
                heapq.heappush(queue, (distance[kid], kid))
        return found

    def top(self) -> np.ndarray:
        """Of each leaf, which child of the root it hangs under."""
        out = np.zeros(self.leaves, int)
        for k, child in enumerate(self.children[0]):
            todo = [child]
            while todo:
                node = todo.pop()
                if self.leaf_of[node] >= 0:
                    out[self.leaf_of[node]] = k
                todo += self.children[node]
        return out


def best(query: np.ndarray, ids: np.ndarray, x: np.ndarray, rough: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest products and their ids, ties to the smaller id.

    ``rough`` products of a matrix product may differ in the last bits with a vector's place; whatever comes near enough to
    the k-th is worked out again one by one.
    """
    rough = np.where(ids == own, -np.inf, rough) if own is not None else rough
    finite = np.isfinite(rough)
    if finite.sum() > k:
        edge = np.partition(rough, len(rough) - k)[len(rough) - k]
        finite &= rough >= edge - 1e-9 * max(1.0, abs(edge))
    at = np.flatnonzero(finite)
    score = (x[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -score))[:k]
    return ids[at][order], score[order]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """``query_id, vec_id, score``, exact, for a bounded list of queries against all rows; each task keeps k per batch and query."""
    asked = [(i, np.array(v, np.float64)) for i, v in queries]
    held = vectors.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            rows = [(i, *pair) for i, q in held.value if len(ids) for pair in zip(*best(q, ids, x, x @ q, i, k), strict=True)]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    found = vectors.select("vec_id", "embedding").mapInArrow(run, "query_id long, vec_id long, score double")
    return _ranked(found, k).select("query_id", "vec_id", "score")


def calibrate(tree: Tree, queries: list[tuple[int, list[float]]], truth: list, k: int, target: float) -> tuple[int, float]:
    """Smallest number of leaves, widened by a quarter at a time, at which the sample's mean recall reaches ``target``; that recall."""
    wanted: dict[int, list] = {}
    for r in truth:
        wanted.setdefault(r.query_id, []).append(np.array(r.embedding, np.float64))
    leaves = {i: tree.assign(np.stack(v)) for i, v in wanted.items()}
    place = []
    for i, q in queries:
        if i in leaves:
            order = np.empty(tree.leaves, int)
            order[tree.visits(np.array(q, np.float64), tree.leaves)] = np.arange(tree.leaves)
            place.append(order[leaves[i]])
    most, recall = 1, 0.0
    while True:
        recall = float(np.mean([(p < most).mean() for p in place])) if place else 1.0
        if recall >= target or most >= tree.leaves:
            return most, recall
        most = min(tree.leaves, most + max(1, most // 4))


def search(vectors: DataFrame, is_query, k: int = 20, target: float = TARGET, sample: int = SAMPLE, branch: int = BRANCH, leaf: int = LEAF, members: int = MEMBERS, asked: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every row for which ``is_query``, by inner product in double precision.

    The tree is fitted on at most ``sample`` vectors (chosen by a hash), every row is put into a leaf, and the number of leaves that a
    query visits is widened until a calibration sample, compared with brute force over all rows, reaches ``target``. A query meets the
    rows of one branch of the root in one place, cut by hashes into blocks of members and of queries, so no task holds more than
    one block of either. A row is no candidate of a query with its own id. Vectors that are null, empty, zero, of a length other than
    the most frequent one, or have null or non-finite components take no part, and neither do rows without an id. Repeated
    rows are candidates each; fewer candidates than ``k`` give fewer rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asks"))
    schema = "query_id long, rank int, vec_id long, score double"
    common = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("longest")).orderBy(F.desc("n"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == common.dim)
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(sample).select("embedding").collect()
    tree = Tree(np.array([r.embedding for r in chosen], np.float64), common.longest, branch, leaf)
    held = spark.sparkContext.broadcast(tree)  # at most 2 * sample centres

    probes = [(r.vec_id, r.embedding) for r in rows.where("asks").orderBy(F.xxhash64("vec_id", F.lit(2)), "vec_id").limit(CALIBRATION).collect()]
    truth = brute_force(rows, probes, k).join(rows.select("vec_id", "embedding").dropDuplicates(["vec_id"]), "vec_id").collect()
    most, _ = calibrate(tree, probes, truth, k, target)
    top = tree.top()
    tops = int(top.max()) + 1

    def put(batches):
        for batch in batches:
            leaf_ = held.value.assign(matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf_), pa.array(top[leaf_])], names=["vec_id", "embedding", "leaf", "top"])

    kind = dict(rows.dtypes)["embedding"]
    placed = staged(rows.select("vec_id", "embedding").mapInArrow(put, f"vec_id long, embedding {kind}, leaf long, top long"), "leaves")

    def go(batches):
        for batch in batches:
            out = []
            for i, (number, q) in enumerate(zip(batch.column(0).to_pylist(), matrix(batch.column(1)), strict=True)):
                leaves = np.array(held.value.visits(q, most))
                under = top[leaves]
                out += [(i, number, int(t), leaves[under == t]) for t in np.unique(under)]
            if out:
                at, number, under, leaves = zip(*out, strict=True)
                columns = [pa.array(number, pa.int64()), batch.column(1).take(pa.array(at)), pa.array(under, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "embedding", "top", "leaves"])

    going = rows.where("asks").select("vec_id", "embedding").mapInArrow(go, f"vec_id long, embedding {kind}, top long, leaves array<long>")
    going = staged(going, "visits")

    def sizes(df: DataFrame, most_rows: int) -> list[int]:
        found = {r.top: r.n for r in df.groupBy("top").agg(F.count(F.lit(1)).alias("n")).collect()}
        return [max(1, -(-found.get(t, 0) // most_rows)) for t in range(tops)]

    m, q = sizes(placed, members), sizes(going, asked)  # one number per branch of the root
    per = lambda counts: F.element_at(F.array(*map(F.lit, counts)), (F.col("top") + 1).cast("int"))
    number = F.xxhash64("vec_id", F.lit(4))
    left = placed.select("*", F.pmod(number, per(m)).cast("int").alias("mb"), F.explode(F.sequence(F.lit(0), per(q) - 1)).alias("qb"))
    right = going.select("*", F.pmod(number, per(q)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), per(m) - 1)).alias("mb"))
    keys = ["top", "mb", "qb"]

    def unit(table: pa.Table, questions: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        names = ["query_id", "vec_id", "score"]
        if not table.num_rows or not questions.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        ids, x, leaf_ = table["vec_id"].to_numpy(), matrix(table["embedding"]), table["leaf"].to_numpy()
        asks, who = matrix(questions["embedding"]), questions["vec_id"].to_numpy()
        order = np.argsort(leaf_, kind="stable")
        ids, x, leaf_ = ids[order], x[order], leaf_[order]
        out: list[list] = [[], [], []]
        opened = np.zeros(int(leaf_.max()) + 2, bool)
        visited = questions["leaves"].combine_chunks()
        for a in range(0, len(who), 64):
            scores = asks[a : a + 64] @ x.T
            for i in range(a, min(len(who), a + 64)):
                own = visited[i].values.to_numpy()
                opened[:] = False
                opened[own[own < len(opened)]] = True
                rough = np.where(opened[leaf_], scores[i - a], -np.inf)
                near, score = best(asks[i], ids, x, rough, int(who[i]), k)
                out[0].append(np.full(len(near), who[i]))
                out[1].append(near)
                out[2].append(score)
        return pa.table([pa.array(np.concatenate(o), t) for o, t in zip(out, kinds, strict=True)], names=names)

    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(unit, "query_id long, vec_id long, score double")
    return _ranked(met, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
