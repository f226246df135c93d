import random

from sitewise.operators.clusters import clustered_positions, run_length_shares


def brute(positions, maxcaas, minlen):
    u = sorted(set(positions))
    bad = set()
    if len(u) < minlen:
        return bad
    for r in range(len(u)):
        for l in range(r + 1):  # noqa: E741
            span = u[r] - u[l] + 1
            if span >= minlen and (r - l + 1) / span >= maxcaas:
                bad |= set(u[l:r + 1])
    return bad


def test_against_every_interval(spark):
    rnd = random.Random(4)
    groups = {f"g{k}": [rnd.randrange(rnd.choice([15, 40, 90])) for _ in range(rnd.randrange(1, 25))] for k in range(120)}
    groups["doc"] = [10, 11, 12, 50]
    rows = [(g, "US", p) for g, ps in groups.items() for p in ps]
    df = spark.createDataFrame(rows, "Gene string, CAAP_Group string, Position int")
    params = [(3, 0.7), (2, 0.5), (5, 0.35), (4, 1.0)]
    got = {}
    for r in clustered_positions(df, params).where("ClusteringFlag = 'Discarded'").collect():
        got.setdefault((r["Gene"], r["minlen"], r["maxcaas"]), set()).add(r["Position"])
    for g, ps in groups.items():
        for minlen, maxcaas in params:
            assert got.get((g, minlen, maxcaas), set()) == brute(ps, maxcaas, minlen), (g, minlen, maxcaas)
    assert got["doc", 3, 0.7] == {10, 11, 12}


def test_run_lengths(spark):
    df = spark.createDataFrame([("g", p) for p in (1, 2, 3, 9, 11, 12, 20, 21, 22, 23, 24, 25)], "Gene string, Position int")
    got = {r["label"]: (r["n"], r["pct"]) for r in run_length_shares(df).collect()}
    assert got == {"3": (1, 25.0), "Singlet": (1, 25.0), "2": (1, 25.0), "6+": (1, 25.0)}
