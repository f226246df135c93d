"""Lifting against walks up the tree, node by node."""

import random

import pytest
from pyspark.sql import functions as F

from sitewise.operators import ancestry as A
from sitewise.operators import trees as T

EDGES = "node_id int, parent_id int, name string, branch_length double"


def grown(seed, n, kind):
    """(node, parent, name, length): a chain, a star, or random attachments; some lengths negative."""
    rng = random.Random(seed)
    parent = {0: None}
    for k in range(1, n):
        parent[k] = k - 1 if kind == "chain" else 0 if kind == "star" else rng.randrange(k) if kind == "any" else max(0, k - rng.randint(1, 3))
    ids = list(range(n))
    rng.shuffle(ids)
    return [(ids[k], None if p is None else ids[p], f"n{ids[k] % (n - 3) if kind == 'any' else ids[k]}", rng.randint(-2, 9) / 8) for k, p in parent.items()]


def walk(rows):
    up = {n: (p, w) for n, p, _, w in rows}

    def path(n):
        out, far = [(n, 0.0)], 0.0
        while up[n][0] is not None:
            far += up[n][1]
            n = up[n][0]
            out.append((n, far))
        return out

    return {n: path(n) for n in up}


@pytest.mark.parametrize("kind", ["chain", "star", "any", "deep"])
def test_pairs_sets_and_farthest(spark, kind):
    rng = random.Random(7)
    rows = grown(3, 40, kind)
    paths = walk(rows)
    tree = A.lifting(spark.createDataFrame(rows, EDGES))

    def meet(nodes):
        return next(x for x, _ in paths[nodes[0]] if all(x in dict(paths[n]) for n in nodes))

    assert {(r.node, r.k): r.ancestor for r in tree.jumps.collect()} == {(n, k): p[1 << k][0] for n, p in paths.items() for k in range(6) if 1 << k < len(p)}
    pairs = [(k, rng.choice(rows)[0], rng.choice(rows)[0]) for k in range(120)] + [(200, 1, 1), (201, None, 1), (202, 1, 999)]
    got = {r.k: (r.ancestor, r.distance) for r in A.pair_ancestors(tree, spark.createDataFrame(pairs, "k int, node1 int, node2 int")).collect()}
    want = {k: (m := meet([a, b]), dict(paths[a])[m] + dict(paths[b])[m]) for k, a, b in pairs if a in paths and b in paths}
    assert got == want
    sets = {s: [rng.choice(rows)[0] for _ in range(rng.randint(1, 6))] for s in range(40)}
    df = spark.createDataFrame([(s, n) for s, m in sets.items() for n in m] + [(50, None), (51, 999)], "set_id int, node int")
    assert {r.set_id: (r.n, r.ancestor) for r in A.set_ancestors(tree, df).collect()} == {s: (len(set(m)), meet(m)) for s, m in sets.items()}
    names = sorted({r[2] for r in rows})[::2] + ["absent"]
    members = [(r[0], r[2]) for r in rows if r[2] in names]
    want = {}
    for a, s in members:
        for b, t in members:
            if a != b:
                m = meet([a, b])
                want[s] = max(want.get(s, (float("-inf"), "")), (dict(paths[a])[m] + dict(paths[b])[m], t))
    got = {r.species1: (r.distance, r.farthest) for r in A.farthest_members(tree, spark.createDataFrame([(n,) for n in names], "species string")).collect()}
    assert got == want


def test_two_trees_and_degenerate_ones(spark):
    edges = spark.createDataFrame([(1, None, "a", None), (2, 1, "b", None), (3, None, "c", 1.0), (4, 77, "d", 1.0)], EDGES)
    tree = A.lifting(edges)
    got = {(r.node1, r.node2): (r.ancestor, r.distance) for r in A.pair_ancestors(tree, spark.createDataFrame([(1, 2), (2, 3), (4, 4)], "node1 int, node2 int")).collect()}
    assert got == {(1, 2): (1, 0.0), (2, 3): (None, None), (4, 4): (4, 0.0)}
    assert {r.set_id: r.ancestor for r in A.set_ancestors(tree, spark.createDataFrame([(0, 2), (0, 4), (1, 1), (1, 2)], "set_id int, node int")).collect()} == {0: None, 1: 1}
    assert [tuple(r) for r in A.farthest_members(tree, spark.createDataFrame([("a",), ("b",), ("c",)], "species string")).orderBy("species1").collect()] == [("a", "b", 0.0), ("b", "a", 0.0)]
    none = A.lifting(edges.where("false"))
    assert none.levels == 0 and none.nodes.isEmpty()


def test_a_chain_of_20000_nodes(spark):
    n = 20_000
    edges = spark.range(n).select(F.col("id").cast("int").alias("node_id"), F.when(F.col("id") > 0, F.col("id") - 1).cast("int").alias("parent_id"), F.concat(F.lit("n"), "id").alias("name"), F.lit(0.5).alias("branch_length"))
    tree = A.lifting(edges)
    assert tree.levels == 15 and tree.jumps.count() == sum(n - (1 << k) for k in range(15))
    pairs = spark.range(500).select((F.col("id") * 39).cast("int").alias("node1"), (n - 1 - F.col("id") * 7).cast("int").alias("node2"))
    bad = A.pair_ancestors(tree, pairs).where("ancestor <> least(node1, node2) OR distance <> abs(node1 - node2) / 2")
    assert bad.count() == 0
    far = A.farthest_members(tree, edges.select(F.col("name").alias("species")))
    assert far.where("distance <> greatest(cast(substr(species1, 2) as int), 19999 - cast(substr(species1, 2) as int)) / 2").count() == 0 and far.count() == n


def test_distance_matrix_agrees_with_paths(spark):
    rows = grown(5, 25, "deep")
    edges = spark.createDataFrame(rows, EDGES)
    sp = spark.createDataFrame([(r[2],) for r in rows], "species string")
    got = {(r.species1, r.species2): r.distance for r in T.patristic(edges, sp).collect()}
    paths, name = walk(rows), {r[0]: r[2] for r in rows}
    for a in paths:
        for b in paths:
            if a != b:
                m = next(x for x, _ in paths[a] if x in dict(paths[b]))
                assert got[name[a], name[b]] == pytest.approx(dict(paths[a])[m] + dict(paths[b])[m])
