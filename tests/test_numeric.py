import math
from itertools import product

import numpy as np
import pytest

from sitewise.functions import numeric as N
from sitewise.operators import accumulation as A


def test_hypergeometric_tail():
    m, n, d = 12, 5, 6
    pmf = {x: math.comb(n, x) * math.comb(m - n, d - x) / math.comb(m, d) for x in range(0, 6) if 0 <= d - x <= m - n}
    for k in range(0, 7):
        assert N.hypergeom_tail(k, m, n, d) == pytest.approx(sum(p for x, p in pmf.items() if x >= k))


def test_binomial_sum_tail():
    ns, ps = [3, 2], [0.3, 0.6]
    dist = {}
    for a, b in product(range(4), range(3)):
        w = math.comb(3, a) * 0.3**a * 0.7 ** (3 - a) * math.comb(2, b) * 0.6**b * 0.4 ** (2 - b)
        dist[a + b] = dist.get(a + b, 0) + w
    for k in range(7):
        assert N.binomial_sum_tail(ns, ps, k) == pytest.approx(sum(w for x, w in dist.items() if x >= k), abs=1e-12)
    assert N.binomial_sum_tail([4], [1.0], 4) == pytest.approx(1.0)


def test_beta_and_intervals():
    xs = np.linspace(0, 1, 200001)
    dens = xs**2.5 * (1 - xs) ** 5.5
    cdf = np.cumsum(dens) / dens.sum()
    assert N.incomplete_beta(3.5, 6.5, 0.4) == pytest.approx(cdf[np.searchsorted(xs, 0.4)], abs=1e-4)
    lo, hi = N.proportion_interval(3, 9)
    a, b = 3.5, 6.5
    assert N.incomplete_beta(a, b, hi) - N.incomplete_beta(a, b, lo) == pytest.approx(0.95, abs=1e-6)
    f = lambda t: (a - 1) * math.log(t) + (b - 1) * math.log(1 - t)
    assert f(lo) == pytest.approx(f(hi), abs=1e-4)
    c_lo, c_hi = N.proportion_interval(3, 9, kind="central")
    assert c_hi - c_lo >= hi - lo
    assert N.proportion_interval(0, 10)[0] == 0.0 and N.proportion_interval(10, 10)[1] == 1.0


def test_fisher_exact():
    p, odds = N.fisher_exact(3, 1, 1, 3)
    assert p == pytest.approx(0.4857142857)
    assert odds == pytest.approx(6.40832, abs=1e-4)


def test_exact_law_agrees_with_simulation(spark):
    law = spark.createDataFrame([("all", "g1", 4, [20, 10], [0.1, 0.2]), ("all", "g2", 0, [20, 10], [0.05, 0.0])],
                                "category string, gene string, actual long, ns array<long>, ps array<double>")
    exact = {r["gene"]: r for r in A.exact_test(law).collect()}
    mc = {r["gene"]: r for r in A.monte_carlo(law, 20_000, seed=3, chunk=3_000).collect()}
    for g in exact:
        assert mc[g]["NumRands"] == 20_000
        assert mc[g]["MeanSim"] == pytest.approx(exact[g]["mean_sim"], abs=0.05)
        assert mc[g]["SD"] == pytest.approx(exact[g]["sd_sim"], abs=0.05)
        assert mc[g]["PValueEmpirical"] == pytest.approx(exact[g]["p_exact"], abs=0.02)
    again = {r["gene"]: r["RandsAbove"] for r in A.monte_carlo(law, 20_000, seed=3, chunk=3_000).collect()}
    assert again == {g: r["RandsAbove"] for g, r in mc.items()}


def test_empirical_p_of_zero_hits(spark):
    parts = spark.createDataFrame([("all", "g", 9, 5, 10, 30.0, 0), ("all", "g", 9, 5, 10, 30.0, 0)],
                                  "category string, gene string, actual long, n_rands long, sum_c long, sum_sq double, n_ge long")
    assert A.merge_moments(parts).collect()[0]["PValueEmpirical"] == pytest.approx(1 / 11)


def test_top_bin_is_skipped_only_in_compatibility_mode(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(5.0,), (95.0,)], "v double")
    bins = [0.0, 50.0, 90.0, 100.0]
    assert [r[0] for r in df.select(A.decile_key(F.col("v"), bins)).collect()] == [1, 3]
    assert [r[0] for r in df.select(A.decile_key(F.col("v"), bins, compat=True)).collect()] == [1, None]
