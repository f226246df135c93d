"""One factor against its likelihood."""

import numpy as np
import pytest

from sitewise.operators import scoring as S


def likelihood(s, loading, unique):
    c = np.outer(loading, loading) + np.diag(unique)
    return np.linalg.slogdet(c)[1] + np.trace(np.linalg.solve(c, s))


def sample(seed, n=400, k=5):
    rng = np.random.default_rng(seed)
    f = rng.normal(size=(n, 1))
    return f @ rng.uniform(0.3, 1.2, size=(1, k)) + rng.normal(size=(n, k)) * rng.uniform(0.5, 1.5, size=k)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_nearby_model_is_likelier(seed):
    s = np.corrcoef(sample(seed).T)
    loading, unique = S.one_factor(s)
    best, rng = likelihood(s, loading, unique), np.random.default_rng(9)
    assert np.abs(loading**2 + unique - 1).max() < 1e-6
    for step in (1e-1, 1e-2, 1e-3):
        for _ in range(300):
            assert likelihood(s, loading + rng.normal(size=5) * step, np.maximum(S.UNIQUE, unique + rng.normal(size=5) * step)) >= best - 1e-10


def test_scores_and_loadings(spark):
    x = sample(4)
    x[:, 3] *= -1
    rows = [(*map(float, r), float(-r[0] - r[1]), 1.0) for r in x] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    names = [f"v{k}" for k in range(5)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "align", "flat"]))
    scored, loadings = S.single_factor(df, [*names, "flat"], "align")
    got = {r.variable: (r.loading, r.uniqueness) for r in loadings.collect()}
    s = np.corrcoef(x.T)
    loading, unique = S.one_factor(s)
    sign = np.sign(loading[0]) * -1  # align falls with the first two
    assert sorted(got) == names
    for k, n in enumerate(names):
        assert got[n] == pytest.approx((sign * loading[k], unique[k]), abs=1e-8)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    want = z @ np.linalg.solve(s, sign * loading)
    have = [r.factor1 for r in scored.collect()]
    assert have[-1] is None and np.abs(np.array(have[:-1]) - want).max() < 1e-8
    with pytest.raises(ValueError):
        S.single_factor(df, ["v0", "v1", "flat"], "align")
