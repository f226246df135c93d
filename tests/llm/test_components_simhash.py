import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, prose, table
from sitewise.llm import simhash as H
from sitewise.llm.components import components

xxhash = pytest.importorskip("xxhash")


def reach(nodes, pairs):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    order = list(range(120))
    rng.shuffle(order)
    pairs = list(zip(order, order[1:])) + [(1000 + k, 1000) for k in range(60)] + [(5000, 5000), (7000, 7001), (7000, 7001)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    want = reach({x for p in pairs for x in p}, pairs)
    del want[5000]
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain(text):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = w.translate({i: " " for i in range(9, 14)}).split(" ")
    w = [x for x in w if x]
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint(monkeypatch):
    for _, t, _, _ in awkward():
        assert H.fingerprint(t) & (1 << 64) - 1 == plain(t)
    want = H.fingerprint(awkward()[5][1])
    monkeypatch.setattr(H, "SLICE", 100)
    assert H.fingerprint(awkward()[5][1]) == want


def test_groups_as_brute_force(spark):
    rng = random.Random(3)
    rows = awkward()
    base = prose(rng, 60)
    for k in range(80):  # near-copies: a word changed here and there
        w = base.split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(60)] = "other"
        rows.append((100 + k, " ".join(w), "en", "a"))
    out = H.near_duplicates(table(spark, rows).withColumn("fp", F.lit(1)).withColumn("component", F.lit(2))).collect()
    prints = defaultdict(list)
    for i, t, _, _ in rows:
        prints[plain(t)].append(i)
    fps = sorted(prints)
    top = reach(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    first = defaultdict(list)
    for f in fps:
        first[top[f]] += [i for i in prints[f] if i is not None]
    want = sorted((i or -1, f"{plain(t):016x}", min(first[top[plain(t)]], default=None) or -1) for i, t, _, _ in rows)
    assert sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"] or -1) for r in out) == want


@pytest.mark.parametrize("clusters", [0, 30])
def test_tree_finds_every_close_pair(clusters):
    rng = np.random.default_rng(4)
    points = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    for c in points[:clusters].tolist():
        near = [c ^ int(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 2, dtype=np.uint64))) for _ in range(20)]
        points = np.concatenate([points, np.array(near, np.uint64)])
    points = np.unique(points)
    want = {(i, j) for i in range(len(points)) for j in np.flatnonzero(H.distance(points, points[i]) <= 3).tolist() if i < j}
    tree = H.Tree(points[rng.permutation(len(points))[:256]], 4)
    index, leaf, home = tree.homes(points, 3)
    assert sorted(index[home].tolist()) == list(range(len(points)))
    got = set()
    for k in range(tree.leaves):
        own, asking = index[(leaf == k) & home], index[(leaf == k) & ~home]
        every = np.concatenate([own, asking])
        for a, b in H.close_pairs(points[every], len(own), 3):
            got |= {(min(x, y), max(x, y)) for x, y in zip(every[a].tolist(), every[b].tolist())}
    assert got == want


def test_keep_one(spark):
    rng = random.Random(5)
    a, b = prose(rng, 50), prose(rng, 50)
    rows = [(3, a, "en", "x"), (1, a, "en", "y"), (1, a, "en", "y"), (2, b, "en", "x"), (None, a, "en", "x"), (4, None, None, None), (5, "", None, None)]
    kept = H.keep_one(table(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1) for r in kept) == [-1, 1, 2, 4]
    assert H.keep_one(table(spark, [])).count() == 0
    assert H.near_duplicates(table(spark, [])).count() == 0
