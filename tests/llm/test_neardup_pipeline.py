import random

import numpy as np
from pyspark.sql import functions as F

from helpers import awkward, prose, table
from sitewise.llm import neardup as N

import corpus_pipeline


def brute(rows, cosine=0.98):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            x = x / np.abs(x).max()
            ok[k] = (label, x / np.linalg.norm(x))
    n, top = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for a in ok:
        for b in ok:
            if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= cosine:
                n[a] += 1
                n[b] += 1
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    first = {}
    for k, r in enumerate(rows):
        first.setdefault(find(k), []).append(r[0])
    return sorted((i, n[k], min(first[find(k)])) for k, (i, _, _) in enumerate(rows))


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(20):
            c = rng.normal(size=16)
            rows += [(len(rows) + k, (c + rng.normal(size=16) * 0.05).tolist(), label) for k in range(rng.integers(1, 6))]
    c = rng.normal(size=16)
    rows += [(1000 + k, (c + rng.normal(size=16) * 0.03).tolist(), 0) for k in range(120)]  # a dense group
    rows += [(2000 + k, c.tolist(), 0) for k in range(50)] + [(2100, (3 * c).tolist(), 0), (2101, c.tolist(), 1), (2102, c.tolist(), None), (2103, None, 0), (2104, [0.0] * 16, 0)]
    rows += [(2105, [float("nan")] + [1.0] * 15, 0), (2106, [float("inf")] + [1.0] * 15, 0), (2107, [None] + [1.0] * 15, 0), (2108, [], 0), (2109, [1.0, 2.0], 0), (2110, [1.0, 2.01], 0), (2111, [1e300] * 16, 1)]
    return rows


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash"))
    return N.near_duplicates(df).collect()


def test_links_and_components(spark, monkeypatch):
    rows = vectors()
    for block, cell in ((256, 2048), (32, 16)):
        monkeypatch.setattr(N, "BLOCK", block)
        monkeypatch.setattr(N, "CELL", cell)
        got = run(spark, rows)
        want = brute(rows)
        assert sorted(r["vec_id"] for r in got) == [w[0] for w in want]
        found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
        assert all(found[i][0] <= n for i, n, _ in want)
        assert sum(v[0] for v in found.values()) >= 0.99 * sum(w[1] for w in want)
        assert sum(found[i][1] == c for i, _, c in want) >= 0.99 * len(want)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_no_vectors(spark):
    assert run(spark, []) == []
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in run(spark, [(3, None, None), (4, [1.0], None)])] == [(0, 3, True), (0, 4, True)]


def test_count_is_calibrated():
    rng = np.random.default_rng(3)
    p = rng.normal(size=(4000, N.DIRECTIONS)) * N.spread(0.98)
    met = (np.abs(p) <= N.COLLIDE * N.spread(0.98)).sum(1)
    assert (met >= N.least_count()).mean() >= 0.99 > 0.9


def test_cells_lose_no_close_pair():
    rng = np.random.default_rng(4)
    p = rng.normal(size=(60, 3))
    reach = 0.4
    row, cell, own = N.cells(p, 3, reach)
    for a in range(60):
        for b in range(a):
            if (np.abs(p[a] - p[b]) <= reach).all():
                times = sum(((own[i] | own[j]) == 7) for i in np.flatnonzero(row == a) for j in np.flatnonzero(row == b) if (cell[i] == cell[j]).all())
                assert times == 1


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    tongues = {"en": ("the", "ing", "tion", "sh"), "de": ("der", "sch", "ung", "keit")}
    texts = {k: prose(rng, 60, tongues["en" if k % 2 else "de"]) for k in range(60)}
    rows = [(k, t, "en" if k % 2 else "de", "ab"[k % 3 == 0]) for k, t in texts.items()]
    rows += [(100 + k, texts[5], "en", "a") for k in range(9)] + [(200, "12 34 56", "en", "a"), (201, None, None, None)]
    rows += [(300 + k, prose(rng, 40, tongues["en"]) + f' token = "{rng.getrandbits(160):040x}" and', "en", "b") for k in range(12)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        if k < 4:
            assert docs.columns == before.columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
        ids = sorted(r["doc_id"] for r in docs.select("doc_id").distinct().collect())
        if k == 0:
            assert ids == sorted([*texts, *range(100, 109), *range(300, 312)])
        if k == 1:
            assert ids == sorted([*texts, *range(300, 312)])
        if k == 2:
            assert docs.where("text LIKE '%[SECRET]%'").count() == 12 and docs.count() == 72
        if k == 3:
            n = docs.select(F.sum(F.size(F.split("text", " ")))).first()[0]
            m = before.select(F.sum(F.size(F.split("text", " ")))).first()[0]
            assert abs(n - m) <= 4
    assert docs.where("size(ids) <> n_tokens").count() == 0 and docs.count() > 0


def test_pipeline_of_awkward_rows(spark, tmp_path):
    table(spark, awkward()).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
