import random

import numpy as np
import pytest

from sitewise.operators import ordering as O


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(1)
    # One group holds most rows and one value a third of them.
    rows = [("hot" if rnd.random() < 0.7 else f"g{rnd.randrange(4)}", 0.5 if rnd.random() < 0.33 else round(rnd.random(), 2), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "g string, v double, i int").repartition(7)


def test_quantiles_match_numpy(frame):
    rows, df = frame
    got = {r["g"]: (r["a"], r["b"]) for r in O.quantiles(df, ["g"], "v", {"a": 0.9, "b": 0.37}).collect()}
    for g in {r[0] for r in rows}:
        v = [r[1] for r in rows if r[0] == g]
        assert got[g] == pytest.approx((np.quantile(v, 0.9), np.quantile(v, 0.37)), abs=1e-12)
    whole = O.quantiles(df, [], "v", {"m": 0.5}).collect()[0]["m"]
    assert whole == pytest.approx(np.median([r[1] for r in rows]))


def test_cumulative_counts(frame):
    rows, df = frame
    for order, sign in ((["v"], 1), (["-v"], -1)):
        got = {(r["g"], r["v"]): (r["before"], r["cnt"], r["total"]) for r in O.cumulative_counts(df, ["g"], order).collect()}
        for (g, v), (before, cnt, total) in got.items():
            vals = [r[1] for r in rows if r[0] == g]
            assert (before, cnt, total) == (sum(sign * x < sign * v for x in vals), vals.count(v), len(vals))


def test_ntile_and_nulls(spark, frame):
    rows, df = frame
    got = {r["i"]: r["t"] for r in O.ntile(df, ["v", "i"], 10, "t").collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    size, rem = divmod(len(order), 10)
    want, k = {}, 0
    for t in range(10):
        for _ in range(size + (t < rem)):
            want[order[k][2]] = t + 1
            k += 1
    assert got == want
    null = spark.createDataFrame([(None, 1), (1.0, 2)], "v double, i int")
    assert {r["i"]: r["t"] for r in O.ntile(null, ["v", "i"], 10, "t").collect()} == {1: None, 2: 1}


def test_decile_score_of_ten(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(10)], "p double, i int")
    got = [r["s"] for r in O.decile_score(df, ["p", "i"], "s").orderBy("i").collect()]
    assert got == pytest.approx([1 - i / 9 for i in range(10)])


def test_average_ranks_and_bh(spark, frame, monkeypatch):
    rows, df = frame
    vals = sorted(r[1] for r in rows)
    mean_rank = {v: np.mean([k + 1 for k, x in enumerate(vals) if x == v]) for v in set(vals)}
    for r in O.average_ranks(df, ["v"], "r_").collect():
        assert r["r_v"] == pytest.approx(mean_rank[r["v"]])
    rnd = random.Random(2)
    ps = [round(rnd.random(), 2) for _ in range(200)]
    pdf = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "i int, p double")
    order = sorted(range(200), key=lambda i: -ps[i])
    want, low = {}, 1.0
    for k, i in enumerate(order):
        low = min(low, ps[i] * 200 / (200 - k))
        want[i] = low
    want = {i: min(want[j] for j in want if ps[j] == ps[i]) for i in want}
    for limit in (10**6, 17):
        monkeypatch.setattr(O, "SLICE", limit)
        got = {r["i"]: r["q"] for r in O.bh_adjust(pdf, "p", [], "q").collect()}
        assert got == pytest.approx(want)


@pytest.mark.parametrize("heavy", [1, 3, 10**6])
def test_ranks_of_heavy_light_and_null_values(spark, frame, monkeypatch, heavy):
    monkeypatch.setattr(O, "HEAVY", heavy)
    rows, df = frame
    more = df.unionByName(spark.createDataFrame([("hot", None, -1), (None, 0.5, -2)], "g string, v double, i int"))
    got = {r["i"]: (r["a"], r["m"]) for r in O.min_rank(O.average_rank(more, "v", "a", ["g"]), "v", "m", ["g"]).collect()}
    assert got[-1] == (None, None) and len(got) == len(rows) + 2
    for g, v, i in rows[:200]:
        vals = [r[1] for r in rows if r[0] == g]
        below, ties = sum(x < v for x in vals), vals.count(v)
        assert got[i] == (below + (ties + 1) / 2, below + 1)


def test_tiles_of_ties_and_few_rows(spark):
    import random

    rng = random.Random(6)
    for n in (0, 1, 3, 10, 11, 97):
        rows = [(rng.choice([0.0, 0.0, 1.5, 2.0, None]), rng.choice("abc"), k) for k in range(n)]
        df = spark.createDataFrame(rows, "v double, s string, i int")
        order = sorted((r for r in rows if r[0] is not None))
        size, rem = divmod(len(order), 10)
        want = {r[2]: None for r in rows}
        for at, r in enumerate(order):
            big = rem * (size + 1)
            want[r[2]] = at // (size + 1) + 1 if at < big else rem + (at - big) // size + 1
        assert {r["i"]: r["t"] for r in O.ntile(df, ["v", "s", "i"], 10, "t").collect()} == want
