import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, most=32):
    """{(id, position)} by whole numbers, fractions and the eigenvectors of the covariance."""
    x, ids = [], []
    for i, v, _ in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x.append([math.floor(64 * c) + 1_000_000 for c in v])
            ids.append(i)
    n = len(x)
    s = [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(r, s)) for r in x]
    centred = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(r, s)] for r in x])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    keep = min(most, int((e > 1e-9 * e[0]).sum()))
    return ids, n, deviation, centred @ q[:, :keep] / np.sqrt(e[:keep]), e[:keep] / np.trace(cov)


def vectors(seed, n, dim, rank=None, spread=2.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, rank or dim)) * np.logspace(0, -spread, rank or dim) @ rng.normal(size=(rank or dim, dim))
    return [(k, r.tolist(), k % 3) for k, r in enumerate(v)]


def check(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("clash")).withColumn("component", F.lit("clash"))
    got = W.table(df).collect()
    ids, n, deviation, want, explained = brute(rows)
    assert len(got) == len(ids) * len(explained) and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-4)
        assert r.identity_error <= 1e-9
    low = lambda t: tuple((x is not None, x or 0) for x in t)
    for k in range(len(explained)):
        assert sorted((low((i, d)) for i, d, _ in by[k + 1])) == sorted(low(t) for t in zip(ids, deviation))
        a = np.sort([w for _, _, w in by[k + 1]])
        b = np.sort(want[:, k])
        assert min(np.abs(a - b).max(), np.abs(a + b[::-1]).max()) < 1e-7
        if len(set(ids)) == len(ids):
            one = {i: w for i, _, w in by[k + 1]}
            c = np.array([one[i] for i in ids])
            assert min(np.abs(c - want[:, k]).max(), np.abs(c + want[:, k]).max()) < 1e-7
    return got


def test_against_eigenvectors(spark, monkeypatch):
    check(spark, vectors(1, 400, 8))
    monkeypatch.setattr(W, "BLOCK", 8 * 40 * 64)
    monkeypatch.setattr(W, "PARTITION", 8 * 40 * 200)
    check(spark, vectors(2, 900, 40, spread=0.5))


def test_awkward_rows(spark):
    rows = vectors(3, 60, 6) + [(None, [0.5] * 6, 0), (7, [0.25] * 6, None), (7, [0.25] * 6, None), (100, None, 0), (101, [None] + [1.0] * 5, 0), (102, [float("nan")] + [1.0] * 5, 0),
                                (103, [float("inf")] * 6, 0), (104, [-float("inf")] * 6, 0)]
    check(spark, rows)
    shapes = spark.createDataFrame(rows + [(105, [], 0), (106, [1.0, 2.0], 0), (107, [1e300] * 6, 0)], SCHEMA)
    assert {r.vec_id for r in W.table(shapes).collect()} == {r[0] for r in rows if r[0] is None or r[0] < 100}


def test_low_rank_ties_and_equal_rows(spark):
    # the same deviation in every column: components are any basis, the whitened covariance still is the identity
    square = [(k, [(1.0 if k >> b & 1 else -1.0) for b in range(5)], 0) for k in range(32)]
    got = W.table(spark.createDataFrame(square, SCHEMA)).collect()
    assert len(got) == 32 * 5 and max(r.identity_error for r in got) < 1e-12 and all(abs(r.explained - 0.2) < 1e-12 for r in got)
    flat = [(k, [float(k % 7), 2.0 * (k % 7), 0.0, float(k % 5)], 0) for k in range(50)]
    got = W.table(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-12
    assert W.table(spark.createDataFrame([(k, [1.0, 2.0], 0) for k in range(5)], SCHEMA)).collect() == []
    assert W.table(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bidiagonal_form():
    rng = np.random.default_rng(4)
    for rank in (9, 4):
        x = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, 9))
        v, b = W.bidiagonal(lambda c: x.T @ (x @ c), 9)
        assert np.abs(v @ v.T - np.eye(9)).max() < 1e-13 and len(b) == rank
        assert np.abs(np.tril(b, -1)).max() < 1e-9 and np.abs(np.triu(b, 2)).max() < 1e-9
        assert np.abs(np.linalg.svd(b)[1][:rank] - np.linalg.svd(x)[1][:rank]).max() < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    rows = spark.createDataFrame([([2**40, 0],), ([0, 0],)], "x array<bigint>")
    n, total = W.sums(rows)
    assert (n, total) == (2, [2**40, 0])
    assert [r.d for r in rows.select(W.deviation(n, total).alias("d")).collect()] == [None, None]
    assert [r.d for r in rows.select(W.deviation(2, [2**20, 3]).alias("d")).where("d is not null").collect()] == [2**40 + 9]
