"""Vector operators against brute force."""

import numpy as np
import pytest

from pyspark.sql import functions as F
from tempoflow.llm import covertree, kmtree
from tempoflow.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n int"


@pytest.fixture(scope="module")
def table(spark):
    rng, rows = np.random.default_rng(1), []
    for i in range(200):
        centre = rng.normal(size=8)
        for _ in range(int(rng.integers(1, 5))):
            vector = [float(np.float32(x)) for x in centre + rng.normal(size=8) * 0.12]
            rows.append((len(rows), vector, int(rng.integers(0, 2)) if i % 9 else None))
    rows += [(9000 + i, rows[3][1], 1) for i in range(40)]
    unit = [2.0] + [0.0] * 7
    rows += [(5, None, 1), (None, unit, 0), (7000, [0.0] * 8, 0), (7001, [None, *unit[1:]], 0), (7002, [float("nan")] * 8, 0)]
    rows += [(7003, unit, 0), (7003, unit, 0), (7005, [1.0, 0.0], 0), (7006, [], 0), (7007, [float("inf")] * 8, 0)]
    return rows


def usable(rows):
    return [i for i, (_, e, _) in enumerate(rows) if e and all(x is not None and np.isfinite(x) for x in e) and any(e)]


@pytest.mark.parametrize("options", [{}, {"block": 32}, {"block": 20, "pivots": 7}])
def test_cover_trees_find_every_link(spark, table, options):
    x = {i: np.array(table[i][1], float) for i in usable(table) if table[i][2] is not None}
    links, label = [0] * len(table), list(range(len(table)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for i in x:
        for j in x:
            if i < j and table[i][2] == table[j][2] and len(x[i]) == len(x[j]):
                if (x[i] * x[j]).sum() / (np.sqrt((x[i] ** 2).sum()) * np.sqrt((x[j] ** 2).sum())) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    label[find(i)] = find(j)
    ids = {}
    for i, (v, _, _) in enumerate(table):
        ids.setdefault(find(i), []).append(v)
    want = []
    for i, (v, _, _) in enumerate(table):
        component = min((w for w in ids[find(i)] if w is not None), default=None)
        want.append((v, links[i], component, None if v is None else v == component))
    df = spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in covertree.near_duplicates(df, **options).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_links_of_a_pivot_alone_in_its_cell(spark):
    """As many pivots as vectors allow: cell 0 may hold its pivot alone, at radius 0, with partners in the other cells."""
    rng = np.random.default_rng(3)
    for _ in range(4):
        a = np.eye(1, 8)[0]
        rows = [(k, [float(x) for x in np.float32(a + 0.02 * (k > 0) * rng.normal(size=8))], 0, "x", 1) for k in range(6)]
        df = spark.createDataFrame(rows, SCHEMA)
        at = F.when(F.col("vec_id") == 0, F.lit(0)).otherwise(F.col("vec_id"))
        distinct = df.select("label", F.lit(8).alias("dim"), at.alias("node"), F.lit(1).cast("long").alias("n"), "embedding")
        found = covertree.links(distinct, block=2, pivots=6).where("kind = 0").collect()
        weight = {}
        for r in found:
            weight[r.a] = weight.get(r.a, 0) + r.b
        x = np.array([r[1] for r in rows], float)
        cosine = x @ x.T / np.outer(np.sqrt((x * x).sum(axis=1)), np.sqrt((x * x).sum(axis=1)))
        assert weight == {k: int(n) for k, n in enumerate((cosine >= 0.98).sum(axis=1) - 1) if n}


def test_pivots_are_shared_out_by_size(spark):
    rows = [(0, i, [1.0, float(i)]) for i in range(3000)] + [(1, 5000 + i, [1.0, float(i)]) for i in range(300)] + [(2, 9000 + i, [1.0, 2.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "label long, node long, embedding array<float>").selectExpr("label", "2 dim", "node", "1l n", "embedding")
    few = [r.label for r in covertree._pivots(df, block=100, pivots=11)]
    assert 9 <= few.count(0) <= 10 and few.count(1) == 1 and 2 not in few
    many = [r.label for r in covertree._pivots(df, block=100, pivots=500)]
    assert (many.count(0), many.count(1), many.count(2)) == (30, 3, 0)
    assert covertree._pivots(df, block=5000, pivots=11) == []


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_labels_of_other_types(spark, kind):
    values = ["x", "y", None] if kind == "string" else [1 << 40, 2 << 40, None]
    rows = [(i, [1.0, 0.01 * i], values[i % 3]) for i in range(9)]
    got = covertree.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {kind}")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (2, i % 3) if i % 3 < 2 else (0, i) for i in range(9)}


def test_cover_tree_levels():
    x = np.random.default_rng(0).normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = covertree.CoverTree(x)
    radius = 2.0
    for level, nodes, reach in zip(tree.levels, tree.nodes, tree.radii):
        away = np.linalg.norm(x - x[level], axis=1)
        assert away.max() <= radius + 1e-9
        assert set(level) == set(nodes) and (level[nodes] == nodes).all()
        assert np.allclose(reach, [away[level == n].max() for n in nodes], atol=1e-6)
        radius = radius / 2


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert covertree.near_duplicates(empty).count() == 0
    assert kmtree.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0, 2.0], 0, None, None), (21, None, 0, None, None)], SCHEMA)
    assert kmtree.search(alone, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("options", [{}, {"members": 64, "asked": 8, "leaf": 10, "branch": 4}])
def test_search_recall_and_order(spark, table, options):
    df = spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA)
    got = {}
    for r in kmtree.search(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = [i for i in usable(table) if len(table[i][1]) == 8 and table[i][0] is not None]
    x, ids = np.array([table[i][1] for i in rows], float), np.array([table[i][0] for i in rows])
    recall = []
    for k, i in enumerate(ids):
        if i % 20 == 0:
            score = np.where(ids == i, -np.inf, (x * x[k]).sum(axis=1))
            best = np.lexsort((ids, -score))[:20]
            assert [r for r, _, _ in got[i]] == list(range(1, 21))
            recall.append(len(set(ids[best]) & {v for _, v, _ in got[i]}) / len(set(ids[best])))
            for _, v, s in got[i]:
                assert s == (np.array(x[ids == v][0]) * x[k]).sum()
            assert [v for _, v, s in got[i]] == [v for _, v, s in sorted(got[i], key=lambda t: (-t[2], t[1]))]
    assert len(recall) > 20 and np.mean(recall) >= 0.9


def test_widening_reaches_the_target():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 16))
    tree = kmtree.Tree(x, (x * x).sum(axis=1).max())
    assert sorted(tree.visits(x[0], tree.leaves)) == list(range(tree.leaves))
    asked = [(i, x[i].tolist()) for i in range(30)]

    class Row:
        def __init__(self, q, e):
            self.query_id, self.embedding = q, e

    truth = [Row(i, x[j].tolist()) for i in range(30) for j in np.argsort(-(x @ x[i]))[:20]]
    few, low = kmtree.calibrate(tree, asked, truth, 20, 0.5)
    most, high = kmtree.calibrate(tree, asked, truth, 20, 0.99)
    assert few < most and low >= 0.5 and high >= 0.99


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(300, 7), (5, 5), (900, 800), (800, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 301)]} | {900: 800, 800: 800}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
