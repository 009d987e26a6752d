"""Ancestors at any depth, and numbering beyond the digits of ids."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import cluster, tree
from tilewright.sources import tables

NODES = "node_id string, parent_id string, is_leaf boolean"


def test_closure_of_a_long_chain(spark):
    n = 3000
    nodes = spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None, i == n - 1) for i in range(n)], NODES).repartition(3)
    got = tree.closure(nodes)
    number = lambda c: F.substring(c, 2, 9).cast("int")
    r = got.agg(F.count("*").alias("n"), F.countDistinct("ancestor", "node_id").alias("pairs"), F.sum((number("node_id") - number("ancestor") != F.col("distance")).cast("int")).alias("wrong")).first()
    assert (r.n, r.pairs, r.wrong) == (n * (n + 1) // 2, n * (n + 1) // 2, 0)
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]


def random_tree(rng, n):
    """Leaves joined up at random, some at nodes of many children: rows, and each node's parent."""
    above, tops, inner = {}, [f"leaf{i}" for i in range(n)], 0
    leaves = set(tops)
    while len(tops) > 1:
        k = min(len(tops), rng.choice([2, 2, 2, 3, 9]))
        # mostly the newest nodes, so that the tree gets deep
        own = [tops.pop(rng.randrange(max(0, len(tops) - 4), len(tops)) if rng.random() < 0.7 else rng.randrange(len(tops))) for _ in range(k)]
        name, inner = f"in{inner}", inner + 1
        above.update(dict.fromkeys(own, name))
        tops.append(name)
    above[tops[0]] = None
    return [(x, p, x in leaves) for x, p in above.items()], above


@pytest.mark.parametrize("n", [2, 2000])
def test_lowest_common_ancestors(spark, n):
    rng = random.Random(n)
    rows, above = random_tree(rng, n)

    def path(x):
        out = []
        while x is not None:
            out.append(x)
            x = above[x]
        return out

    under = Counter(a for x, _, leaf in rows if leaf for a in path(x))
    members = {f"c{i}": rng.sample([x for x, _, leaf in rows if leaf], rng.randrange(1, min(6, n) + 1)) for i in range(60)}
    want = {}
    for c, own in members.items():
        common = set.intersection(*(set(path(x)) for x in own))
        lowest = next(a for a in path(own[0]) if a in common)
        want[c] = (lowest, round(100.0 * len(own) / under[lowest], 9))
    got = tree.assign_lca(spark.createDataFrame([(c, x) for c, own in members.items() for x in own], "cluster_id string, taxon_id string"), spark.createDataFrame(rows, NODES).repartition(4))
    assert {r.cluster_id: (r.node_id, round(r.penetrance, 9)) for r in got.collect()} == want
    assert n < 2000 or max(len(path(x)) for x, *_ in rows) > 100


def test_odd_trees(spark):
    nodes = spark.createDataFrame([("a", "gone", True), ("b", None, True), ("c", "b", True)], NODES)
    assert {(r.ancestor, r.node_id, r.distance) for r in tree.closure(nodes).collect()} == {("a", "a", 0), ("gone", "a", 1), ("b", "b", 0), ("c", "c", 0), ("b", "c", 1)}
    assert tree.closure(nodes.where("false")).count() == 0
    with pytest.raises(ValueError):
        tree.closure(spark.createDataFrame([("a", "b", True), ("b", "a", True)], NODES))


def test_numbers_outgrow_their_digits(spark):
    got = tables.numbered(spark.range(120_000), ["id"], "TGT_", 5, "name")
    r = got.agg(F.countDistinct("name").alias("n"), F.min("name").alias("first"), F.max(F.struct("id", "name")).alias("last")).first()
    assert (r.n, r.first, r.last.name) == (120_000, "TGT_00000", "TGT_119999")


# ---------------------------------------------------------------- average linkage


def slow_parts(n, merges, cut, reroot):
    """Leaves by subtree, from all paths of the tree as a graph."""
    height = [0.0] * n + [h for *_, h in merges]
    edges = {(n + k, x): h - height[x] for k, (a, b, h) in enumerate(merges) for x in (a, b)}
    root = n + len(merges) - 1
    at_root = [e for e in edges if e[0] == root]
    longest = max((e for e in edges if e[0] != root), key=lambda e: (edges[e], -e[1]), default=None)
    if reroot and longest and edges[longest] > sum(edges[e] for e in at_root):
        joined = sum(edges.pop(e) for e in at_root)
        edges[at_root[0][1], at_root[1][1]] = joined
        half = edges.pop(longest) / 2
        edges |= {(root, x): half for x in longest}
    near = {}
    for (a, b), m in edges.items():
        near.setdefault(a, {})[b] = m
        near.setdefault(b, {})[a] = m

    def leaves(node, above):
        """Leaf -> distance, below a node."""
        if node < n:
            return {node: 0.0}
        return {x: d + m for c, m in near[node].items() if c != above for x, d in leaves(c, node).items()}

    def parts(node, above):
        own = leaves(node, above)
        if node < n or max(own.values()) <= cut:
            return [frozenset(own)]
        return [p for c in near[node] if c != above for p in parts(c, node)]

    return set(parts(root, None))


def test_parts_of_trees_by_all_paths():
    rng = np.random.default_rng(6)
    moved = 0
    for n in [1, 2, 3] + [int(x) for x in rng.integers(4, 14, 80)]:
        at = rng.random((n, 3)) * rng.choice([1, 1, 4], size=(n, 1))
        d = np.sqrt(((at[:, None] - at[None]) ** 2).sum(axis=2))
        merges = cluster.upgma_tree(n, d)
        for cut in (0.0, 0.2, 0.5, 0.9, 5.0):
            both = []
            for reroot in (False, True):
                label = cluster.upgma_labels(n, d, cut, reroot)
                got = {frozenset(i for i in range(n) if label[i] == k) for k in set(label)}
                if n > 1:
                    assert got == slow_parts(n, merges, cut, reroot)
                assert sorted(set(label)) == list(range(max(label) + 1)) and label[0] == 0
                both.append(got)
            moved += both[0] != both[1]
    assert moved


def test_a_long_branch_becomes_the_root():
    """Three close pairs of merges and one leaf far out that joins just before the top: its branch is the longest, and the rest stays together when the root moves there."""
    merges = [(0, 1, 0.05), (4, 2, 0.48), (5, 3, 0.5)]  # leaf 2 and leaf 3 each hang on long branches
    assert cluster.cut_tree(4, merges, 0.49) == [0, 0, 0, 1]
    assert cluster.cut_tree(4, merges, 0.49, reroot=False) == [0, 0, 0, 1] and cluster.cut_tree(4, merges, 0.05, reroot=True) == [0, 0, 1, 2]
    # branches: 0-1 to the node above 0.43, leaf 2 0.48, root's 0.02 and 0.5: together 0.52, so the root stays; with a lower top it moves
    lower = [(0, 1, 0.05), (2, 3, 0.48), (4, 5, 0.485)]
    assert cluster.cut_tree(4, lower, 0.485) == [0, 0, 0, 0] and cluster.cut_tree(4, lower, 0.3) == [0, 0, 1, 2]
    assert cluster.cut_tree(4, lower, 0.3, reroot=True) != cluster.cut_tree(4, lower, 0.48)
