"""Cases of the findings of round 4."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitewise.functions.hashing import Hashed
from sitewise.operators import resampling as R


def test_hashes_are_those_of_the_expression(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aé€") for _ in range(n)) for n in [*range(40), *range(60, 70)]]
    df = spark.createDataFrame([(t, k, k * 7 - 5) for k, t in enumerate(texts)], "s string, l long, i int").withColumn("p", F.xxhash64(F.lit(3), "l"))
    got = df.select("*", *[F.xxhash64(F.lit(3), "l", c).alias(f"h_{c}") for c in ("s", "l", "i")]).toPandas()
    for c, kind in (("s", pa.string()), ("l", pa.int64()), ("i", pa.int32())):
        assert (Hashed(pa.array(got[c].tolist(), kind)).seeded(got["p"].to_numpy()) == got[f"h_{c}"].to_numpy()).all()


def brownian(spark, cycles, edges, values, config, seed):
    """The draws with a row for each cycle and tip; values differ and node ids are depths, the root 0."""
    parent = {n: p for n, p, _, _ in edges}
    length = {n: x for n, _, _, x in edges}
    keys = [(c, n) for c in set(cycles) for n in parent]
    salted = spark.createDataFrame(keys, "cycle string, node int").select("*", F.xxhash64(F.lit("radius"), F.lit(seed), "cycle", "node").alias("r"), F.xxhash64(F.lit("angle"), F.lit(seed), "cycle", "node").alias("a"))
    z = {(x["cycle"], x["node"]): float(R._normal(x["r"], x["a"])) for x in salted.collect()}
    labels = spark.createDataFrame([(c, s, g) for c in set(cycles) for s in values for g in (0, 1)], "cycle string, species string, grp int")
    h = {(x["cycle"], x["species"], x["grp"]): x["h"] for x in labels.withColumn("h", F.xxhash64(F.lit(seed), F.lit("label"), "cycle", "species", "grp")).collect()}
    node, out = {name: n for n, _, name, _ in edges}, {}
    ranked = sorted(values, key=lambda s: (values[s], s))
    for c in set(cycles):
        def at(s):
            n, x = node[s], 0.0
            while parent[n] is not None:
                x, n = x + length[n] ** 0.5 * z[c, n], parent[n]
            return x
        order = [s for s in sorted(values, key=lambda s: (at(s), s)) for _ in range(cycles.count(c))]
        sides = []
        for g in (1, 0):
            own = {s for s, k in config if k == g}
            ranks = [k for k, s in enumerate(ranked) if values[s] in {values[o] for o in own}]
            sides.append(sorted(sorted((order[k] for k in ranks), key=lambda s: (h[c, s, g], s))[: len(own)]))
        out[c] = tuple(sides)
    return out


@pytest.mark.parametrize("returned", [1 << 20, 30])
def test_permulated_labels_without_a_row_for_each_cycle_and_tip(spark, monkeypatch, returned):
    monkeypatch.setattr(R, "RETURNED", returned)
    rng = random.Random(3)
    edges = [(0, None, "root", 0.0)] + [(k, (k - 1) // 3, f"n{k}", rng.random()) for k in range(1, 60)]
    values = {f"n{k}": float(k * 7 % 31 // 3) for k in range(20, 60)}  # values that several species share
    config = [(s, k % 2) for k, s in enumerate(rng.sample(sorted(values), 12))]
    cycles = ["b_1", "b_2", "b_2", "b_3"]
    drawn = R.permulated_labels(spark.createDataFrame([(c,) for c in cycles], "cycle string"), spark.createDataFrame(edges, "node_id int, parent_id int, name string, branch_length double"),
                                spark.createDataFrame(list(values.items()), "species string, value double"), spark.createDataFrame(config, "species string, grp int"), 5)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert {r["cycle"]: (r["fg"], r["bg"]) for r in drawn.collect()} == brownian(spark, cycles, edges, values, config, 5)


def test_drawn_labels_are_counted_by_species(spark, tmp_path):
    import duckdb

    import __spark_entry__ as entry

    queries, oracle = entry.queries(), entry.oracle_sql()
    con = duckdb.connect()
    tables = {"region": "SELECT 0 AS r_regionkey, 'R' AS r_name", "nation": "SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey",
              "supplier": "SELECT i AS s_suppkey, 0 AS s_nationkey, CAST(i * 700 - 2000 AS DOUBLE) AS s_acctbal FROM range(1, 20) t(i)",
              "lineitem": "SELECT i AS l_suppkey, 'R' AS l_returnflag, 0.1 AS l_discount, 0.2 AS l_tax FROM range(1, 20) t(i)"}
    for name, sql in tables.items():
        con.execute(f"CREATE TABLE {name} AS {sql}")
        con.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet'")
    for key in ("ps06_values", "ps06"):
        got = queries[key](spark, str(tmp_path))
        rel = con.sql(oracle[key])
        assert sorted(map(tuple, got.select(rel.columns).collect())) == sorted(rel.fetchall())
    plan = queries["ps06_values"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [cycle" not in plan


def test_ends_of_tiles_are_found_without_ordering_all_rows(spark, monkeypatch):
    from sitewise.operators import ordering as O

    rng = random.Random(7)
    rows = [(rng.choice([None, 0.1, 0.2, 0.2, 0.3]), f"g{rng.randrange(400)}", rng.choice([None, 1, 2])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "v double, g string, p int")
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1], r[2] is not None, r[2]))
    n, tiles = len(ordered), 7
    want = [(t, ordered[min(t + 1, n % tiles) * (n // tiles + 1) + max(0, t + 1 - n % tiles) * (n // tiles) - 1]) for t in range(tiles)]
    assert O.tile_bounds(df, ["v", "g", "p"], tiles) == (["v", "g", "p"], want)
    seen, counts = [], O.cumulative_counts
    monkeypatch.setattr(O, "cumulative_counts", lambda df, *a, **k: (seen.append(df.count()), counts(df, *a, **k))[1])
    monkeypatch.setattr(O, "SAMPLE", 400)
    monkeypatch.setattr(O, "BETWEEN", 500)
    assert O.tile_bounds(df, ["v", "g", "p"], tiles) == (["v", "g", "p"], want)
    assert max(seen) < n
    monkeypatch.setattr(O, "SAMPLE", 3)  # brackets that often miss
    assert O.tile_bounds(df, ["v", "g", "p"], tiles) == (["v", "g", "p"], want)


def test_ranks_by_broadcast_and_by_shuffle(spark, monkeypatch):
    from sitewise.operators import ordering as O

    rng = random.Random(8)
    rows = [(k, rng.choice([None, 1.0, 2.0, float("nan"), -0.0, 0.0]), rng.random()) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    got = []
    for most in (O.BROADCAST, 0):
        monkeypatch.setattr(O, "BROADCAST", most)
        got.append(sorted((r["k"], r["r_a"], r["r_b"]) for r in O.average_ranks(df, ["a", "b"], "r_", descending=True).collect()))
    assert got[0] == got[1]
    order = sorted((r[2] for r in rows), reverse=True)
    assert [x[2] for x in got[0]] == [order.index(r[2]) + 1 for r in rows]


def test_kept_columns_score_like_whole_rows(spark):
    from sitewise.operators import scoring as S

    rng = random.Random(9)
    change = ["convergent", "codivergent", "divergent", "ambiguous", None]
    rows = [(f"g{k % 30}", k // 30 % 10, ["US", "GS0", "GS1", "GS4"][k // 300], rng.random(), rng.choice([None, rng.random()]), rng.choice(change), rng.choice(change), rng.choice(["both", "top", "none"]),
             rng.choice(["True", "MIXED", None]), rng.choice(["parallel", ""]), rng.choice(["TRUE", "false"]), rng.choice(["yes", "no"]), "true", rng.choice(["1", "2,3", ""]), rng.random(), None, rng.random(), rng.random()) for k in range(1200)]
    sites = spark.createDataFrame(rows, "Gene string, Position int, CAAP_Group string, Pvalue double, pvalue_boot double, change_top string, change_bottom string, change_side string, parallel_top string, parallel_bottom string, "
                                  "is_conserved_meta string, asr_is_conserved string, asr_root_conserved string, conserved_pair string, mrca_1_posterior double, mrca_2_posterior double, mrca_3_posterior double, all_mrca_posterior double")
    some = S.position_scores(sites, keep=["change_side"])
    assert not {"Pvalue", "change_top"} & set(some.columns)
    whole = S.position_scores(sites).select(some.columns)
    assert len(want := sorted(map(str, whole.collect()))) == 300 and sorted(map(str, some.collect())) == want


def test_leave_one_out_scores_are_not_written_first(spark, tmp_path, monkeypatch):
    import __spark_entry__  # noqa: F401
    from sitewise.operators import ordering as O
    from sitewise.plans import q_score as Q

    written = []
    monkeypatch.setattr(Q, "checkpoint", lambda df: written.append(df) or df)
    monkeypatch.setattr(Q, "pos", lambda t: t)
    pos = spark.createDataFrame([("g", 1, 5, *[0.5] * 7)], "Gene string, Position int, biochem_weight_sum long, " + ", ".join(f"{c} double" for c in [*Q.COMP, "pre_score", "CAAS_score"]))
    assert Q.loo(pos).count() == 1 and not written
    # No row of a score, id and value is written: what is written is the table and counts of values.
    monkeypatch.setattr(Q.S, "checkpoint", lambda df: written.append(df.columns) or df)
    monkeypatch.setattr(O, "checkpoint", lambda df: written.append(df.columns) or df.checkpoint(eager=True))
    Q.S.top_sets(Q.loo(pos), Q.SETS, {"top10pct": 0.1}, 2, ["Gene", "Position"]).collect()
    Q.S.rank_shifts(Q.loo(pos), "CAAS_current", Q.VARIANTS[1:3]).collect()
    assert not [c for c in written if "id" in c or "_id" in c] and all("cnt" in c or "score" in c for c in written)


def test_newick_texts_share_frames(spark, monkeypatch):
    from sitewise.sources import trees as N

    texts = [(f"g{k}", None if k % 9 == 0 else "" if k % 7 == 0 else f"(S{k}:1.5, (a,b c)x:2)top:x;") for k in range(60)]
    got = N.parse_newick(spark.createDataFrame(texts, "gene string, text string"))
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    want = []
    for k, t in texts:
        if t is not None:
            edges = N.newick_edges(t)
            called = {e[0]: e[2] if e[2] is not None else e[4] for e in edges}
            want += [(k, *e, called.get(e[1])) for e in edges]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert N.newick_edges("(a:1,(b,c)x:2)r;") == [(0, 4, "a", 1.0, None), (1, 3, "b", 0.0, None), (2, 3, "c", 0.0, None), (3, 4, None, 2.0, "x"), (4, None, None, 0.0, "r")]
