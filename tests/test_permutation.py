"""Permutation tests against plain correlations, one gene and permutation at a time."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.operators import permutation as P


def pearson(x, y):
    if len(x) < 2 or len(set(x)) < 2 or len(set(y)) < 2:
        return None
    return float(np.corrcoef(x, y)[0, 1])


def kendall(x, y):
    s = a = b = 0
    for i, j in itertools.combinations(range(len(x)), 2):
        u, v = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        s, a, b = s + u * v, a + u * u, b + v * v
    return float(s / np.sqrt(a * b)) if a and b else None


def tables(seed, binary):
    rng = random.Random(seed)
    branches = [f"b{k}" for k in range(14)]
    rates = [(f"g{g}", b, round(rng.gauss(0, 1), 1)) for g in range(25) for b in branches if rng.random() < 0.8]
    rates += [("flat", b, 1.0) for b in branches] + [("short", b, 1.0) for b in branches[:3]] + [("g0", "outside", 9.0), ("g1", None, 1.0), (None, "b1", 1.0), ("g2", "b1", None)]
    value = (lambda: rng.randint(0, 1)) if binary else (lambda: round(rng.gauss(0, 1), 3))
    trait = [(b, value()) for b in branches[:-1]] + [(branches[-1], None)]
    perms = [(p, b, value()) for p in range(40) for b in branches if rng.random() < 0.95] + [(99, "b1", 1), (98, "outside", 1)] + [(97, b, 1) for b in branches]
    kind = "int" if binary else "double"
    cast = int if binary else float
    trait = [(b, None if v is None else cast(v)) for b, v in trait]
    return rates, trait, [(p, b, cast(v)) for p, b, v in perms], kind


@pytest.mark.parametrize("binary", [False, True])
@pytest.mark.parametrize("cells", [1 << 20, 60])
def test_against_plain_correlations(spark, monkeypatch, binary, cells):
    monkeypatch.setattr(P, "CELLS", cells)
    rates, trait, perms, kind = tables(4, binary)
    got = P.permutation_test(spark.createDataFrame(rates, "gene string, branch string, rer double").withColumn("key", F.lit(1)), spark.createDataFrame(trait, f"branch string, value {kind}"),
                             spark.createDataFrame(perms, f"perm int, branch string, value {kind}"), "binary" if binary else "continuous", 6, 2).collect()
    y0 = {b: v for b, v in trait if v is not None}
    by_gene, by_perm, want = {}, {}, {}
    for g, b, v in rates:
        if g and b and v is not None:
            by_gene.setdefault(g, {})[b] = v
    for p, b, v in perms:
        by_perm.setdefault(p, {})[b] = v
    if binary:
        by_perm = {p: {b: d.get(b, 0) for b in y0} for p, d in by_perm.items() if set(d) & set(y0)}
    rho = kendall if binary else pearson
    for g, x in by_gene.items():
        on = [b for b in x if b in y0]
        if len(on) < 6 or binary and sum(y0[b] for b in on) < 2:
            continue
        seen = rho([x[b] for b in on], [y0[b] for b in on])
        null = [rho([x[b] for b in x if b in d], [d[b] for b in x if b in d]) for d in by_perm.values()]
        null = [abs(r) for r in null if r is not None]
        reach = None if seen is None else sum(r >= abs(seen) - 1e-9 for r in null)
        want[g] = (seen, len(on), reach, len(null), None if seen is None else reach / len(null))
    assert {r.gene: (r.N, r.exceedances, r.n_perms, r.p_perm) for r in got} == {g: w[1:] for g, w in want.items()}
    for r in got:
        assert r.Rho == (None if want[r.gene][0] is None else pytest.approx(want[r.gene][0]))


def test_batches_add_up_and_empty_tables(spark):
    rates, trait, perms, _ = tables(5, False)
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    r, t, p = make(rates, "gene string, branch string, rer double"), make(trait, "branch string, value double"), make(perms, "perm int, branch string, value double")
    whole = {x.gene: (x.exceedances, x.n_perms) for x in P.permutation_test(r, t, p, min_branches=6).collect()}
    halves = [{x.gene: (x.exceedances, x.n_perms) for x in P.permutation_test(r, t, p.where(f"perm % 2 = {k}"), min_branches=6).collect()} for k in (0, 1)]
    assert whole == {g: tuple(None if a is None else a + b for a, b in zip(halves[0][g], halves[1][g])) for g in whole}
    assert P.permutation_test(r.where("false"), t, p).collect() == [] and P.permutation_test(r, t.where("false"), p).collect() == []
    alone = P.permutation_test(r, t, p.where("false"), min_branches=6).collect()
    assert alone and all(x.n_perms == 0 and x.p_perm is None for x in alone)
    with pytest.raises(ValueError):
        P.permutation_test(r, t, p, "rank")


def test_winsorised(spark):
    df = spark.createDataFrame([("g", float(k)) for k in range(10)] + [("g", None), ("h", 1.0), ("h", 5.0)], "gene string, rer double")
    got = P.winsorised(df, 2).groupBy("gene").agg(F.sort_array(F.collect_list("rer")).alias("v"), F.count(F.lit(1)).alias("n")).collect()
    assert {r.gene: (r.v, r.n) for r in got} == {"g": ([2.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.0, 7.0], 11), "h": ([1.0, 5.0], 2)}
