"""Cases of the third round's findings, each on rows of its own."""

import re
from types import SimpleNamespace

from pyspark.sql import functions as F

from sitewise.plans import q_asr, q_tree


def test_parallelism_labels_are_counted(spark):
    rows = [("g", 1, 1, "A", "A", "C", "C"), ("g", 1, 2, "A", "A", "D", "D"), ("g", 2, 1, "A", "A", "A", "A"), ("h", 1, 1, None, "C", "D", "C")]
    t = SimpleNamespace(spark=spark, pair_states=spark.createDataFrame(
        rows, "gene string, site int, pair_id int, focal_state string, mrca_state string, top_tip string, bottom_tip string"))
    got = {(r["parallel_top"], r["parallel_bottom"]): r["n"] for r in q_asr.sc23(t).collect()}
    assert got == {("True", "True"): 1, ("NA", "NA"): 2}


def test_overlap_flags_cover_all_species_pairs(spark):
    t = SimpleNamespace(spark=spark, traits=spark.createDataFrame([("a", 0, 0.0), ("b", 1, 900.0), ("c", 2, 5000.0)], "species string, sid long, value double"))
    got = {(r["species1"], r["species2"]): r["trait_overlap"] for r in q_tree.jn09(t).collect()}
    near = {("a", "b"), ("b", "a")} | {(s, s) for s in "abc"}
    assert got == {(x, y): (x, y) in near for x in "abc" for y in "abc"}


def test_equal_resamples_are_tested_once(spark, monkeypatch):
    """Cycles that drew the same sets cost one test and each count; before, every cycle was tested by itself."""
    from sitewise.operators import scan as S
    from sitewise.operators.columns import SpeciesIndex, columns_from_cells

    names = list("abcdef")
    cells = spark.createDataFrame([("g", 1, s, r) for s, r in zip(names, "AAACCC")], "gene string, position int, species string, residue string")
    index = SpeciesIndex.of(spark.createDataFrame([(s,) for s in names], "species string"))
    sets = [("x", ["a", "b"], ["d", "e"]), ("y", ["b", "a"], ["e", "d"]), ("y", ["a", "b"], ["d", "e"]), (None, ["a", "b"], ["d", "e"]), ("z", ["a", "d"], ["b", "e"])]
    draws = spark.createDataFrame(sets, "cycle string, fg array<string>, bg array<string>")
    seen = []
    monkeypatch.setattr(S, "set_blocks", lambda df, n, real=S.set_blocks: seen.append(df.count()) or real(df, n))
    columns = columns_from_cells(cells, index)
    found = {r["CAAP_Group"]: (r["Occurrences"], r["Total"]) for r in S.bootstrap(columns, None, draws, index).collect()}
    assert found["US"] == (4, 5) and seen == [2]
    hits = S.bootstrap_hits(columns, None, draws, index).where("CAAP_Group = 'US'")
    assert sorted((str(r["cycle"]), r["Substitution"]) for r in hits.collect()) == [("None", "AA/CC"), ("x", "AA/CC"), ("y", "AA/CC"), ("y", "AA/CC")]


def test_pairs_are_shuffled_and_never_broadcast(spark):
    from sitewise.operators.trees import all_pairs

    a, b = spark.range(1500).withColumnRenamed("id", "x"), spark.range(70).withColumnRenamed("id", "y")
    got = all_pairs(a, b)
    plan = got._jdf.queryExecution().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert got.distinct().count() == got.count() == 1500 * 70
    per_task = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(per_task) < 1500 * 70 / 4


def test_permutations_take_more_species_than_an_index_holds(spark, monkeypatch):
    from sitewise.operators import resampling as R

    monkeypatch.setattr(R, "MAX_SPECIES", 3)
    tips = [f"t{k}" for k in range(8)]
    edges = spark.createDataFrame([(0, None, "root", 0.0)] + [(k + 1, 0, s, 1.0) for k, s in enumerate(tips)], "node_id int, parent_id int, name string, branch_length double")
    values = spark.createDataFrame([(s, float(k)) for k, s in enumerate(tips)], "species string, value double")
    config = spark.createDataFrame([("t0", 0), ("t1", 0), ("t6", 1), ("t7", 1)], "species string, grp int")
    rows = R.permulated_labels(R.cycles(spark, 20), edges, values, config).collect()
    assert len(rows) == 20 and all(len(set(r["fg"]) | set(r["bg"])) == 4 for r in rows)


def test_cluster_windows_share_one_deal_of_counted_tasks(spark, monkeypatch):
    from sitewise.operators import clusters as K

    monkeypatch.setattr(K, "ROWS", 10)
    rows = [(f"G{g}", "US", p) for g in range(40) for p in (1, 2, 3, 50, 90)] + [(None, "US", 1), ("G0", None, 1)]
    sites = spark.createDataFrame(rows, "Gene string, CAAP_Group string, Position int")
    out = K.clustered_positions(sites, [(3, 0.5)])
    plan = out._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1 and "hashpartitioning(Gene" in plan and "Join" not in plan
    assert out.rdd.getNumPartitions() == 20
    bad = {(r["Gene"], r["Position"]) for r in out.where("ClusteringFlag = 'Discarded'").collect()}
    assert bad == {(f"G{g}", p) for g in range(40) for p in (1, 2, 3)} and out.count() == 200


def test_reconstructions_share_frames():
    """Parsed files leave a task in few frames; before, each file was a frame."""
    import pandas as pd

    from sitewise.sources import trees as N

    text = f"{N.START}\n{N.BEST}\n{N.HEADER}\n  1  1  AA: A(0.900) C(0.500)\n"
    frames = []

    class Texts:
        def select(self, *names):
            return self

        def mapInPandas(self, run, schema):
            frames.extend(run(iter([pd.DataFrame({"gene": [*map(str, range(50)), None], "text": [text] * 51})])))

    N.parse_reconstructions(Texts(), [8, 7])
    assert len(frames) == 1
    assert sorted(frames[0].itertuples(index=False, name=None), key=str) == sorted(((g, n, 1, a, p) for g in [*map(str, range(50)), None] for n, a, p in ((7, "A", 0.9), (8, "C", 0.5))), key=str)


def test_eligible_rows_are_made_once(spark):
    """The sums read written counts; before, each of them made the rows again."""
    from pyspark.sql import functions as F

    from sitewise.operators import accumulation as A

    rows = spark.createDataFrame(
        [("g", False, "US", "top", "TRUE", "yes", 10.0), ("g", False, "US", "top", "TRUE", "yes", 10.0), ("g", True, "GS1", "both", "false", "no", 90.0), ("h", False, None, None, None, None, 90.0),
         ("h", False, "GS2", "none", "false", "no", 10.0), (None, None, "US", "both", None, None, 10.0)],
        "gene string, masked boolean, CAAP_Group string, change_side string, is_conserved_meta string, asr_is_conserved string, cons_idx double")
    dear = F.udf(lambda g: g, "string")
    law = A.expected_draws(rows.withColumn("gene", dear("gene")), F.array(F.lit("all"), F.lower("CAAP_Group")))
    assert "PythonUDF" not in law._jdf.queryExecution().analyzed().toString() and "<lambda>" not in law._jdf.queryExecution().analyzed().toString()
    got = {(r["category"], r["gene"]): (r["actual"], r["ns"], r["ps"]) for r in law.collect()}
    assert got == {("all", "g"): (3, [4], [0.5]), ("all", "h"): (0, [4], [0.5]), ("all", None): (1, [], []), ("us", "g"): (2, [3], [0.5]), ("us", "h"): (0, [3], [0.5]),
                   ("us", None): (1, [], []), ("gs1", "g"): (1, [1], [0.5]), ("gs1", "h"): (0, [1], [0.5])}


def test_correlations_of_a_block_are_made_in_slices(spark, monkeypatch):
    """No matrix of genes and permutations exceeds ``CELLS``; before, a block's genes met all its permutations at once."""
    import random

    from sitewise.operators import permutation as P

    def guarded(x, y, pearson=P.pearson):
        if len(x) * len(y) > 64:
            raise ValueError(f"{len(x)} x {len(y)} correlations at once")
        return pearson(x, y)

    draw = random.Random(3)
    rates = spark.createDataFrame([(f"g{g}", b, draw.random()) for g in range(20) for b in range(3)], "gene string, branch int, rer double")
    trait = spark.createDataFrame([(b, float(b * b)) for b in range(3)], "branch int, value double")
    perms = spark.createDataFrame([(p, b, draw.random()) for p in range(40) for b in range(3)], "perm int, branch int, value double")
    whole = {r["gene"]: r for r in P.permutation_test(rates, trait, perms, min_branches=2).collect()}
    monkeypatch.setattr(P, "CELLS", 64)
    monkeypatch.setitem(P.MEASURES, "continuous", guarded)
    sliced = {r["gene"]: r for r in P.permutation_test(rates, trait, perms, min_branches=2).collect()}
    assert len(whole) == 20 and {g: (round(r["Rho"], 9), r["N"], r["exceedances"], r["n_perms"]) for g, r in whole.items()} == {g: (round(r["Rho"], 9), r["N"], r["exceedances"], r["n_perms"]) for g, r in sliced.items()}


def test_site_steps_run_in_counted_tasks(spark, monkeypatch, tmp_path):
    """Sites are grouped, counted and joined in tasks that follow their number; before, in the session's shuffle partitions."""
    from sitewise import session
    from sitewise.operators import gene_filter as G
    from sitewise.plans.views import Tables

    monkeypatch.setattr(session, "ROWS", 100)
    rows = [(p, o, n, o % 7 + 1, float(o % 50), 0.05, 0.02, "R", "F") for p in [*range(40), None] for o in range(25) for n in (1, 2, 2)]
    spark.createDataFrame(rows, "l_partkey long, l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, p % 50) for p in range(40)], "p_partkey long, p_size long").write.parquet(f"{tmp_path}/part.parquet")
    t = Tables(spark, str(tmp_path))
    plan = t.sites._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(l_partkey" in plan
    assert t.sites.rdd.getNumPartitions() == 31 and t.sites.count() == 41 * 25 * 2
    stats = G.gene_density(t.sites, t.genes)
    assert stats.rdd.getNumPartitions() == 20 and {tuple(r) for r in stats.select("CAAP_Group", "n_CAAS").collect()} == {("GS0", 25), ("GS1", 25)} and stats.count() == 80

    flags = t.sites.where("CAAP_Group = 'GS0'").select("Gene", "CAAP_Group", "Position").withColumn("ClusteringFlag", F.lit("Discarded"))
    monkeypatch.setattr(session, "ROWS", 5)
    for name, out in (("categorised", G.categorised(stats, flags)), ("full", G.full_gene_stats(stats, stats.withColumn("Category", F.lit("Both"))))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert ", 16), REPARTITION_BY_NUM" in plan, name
        assert not re.search(r"hashpartitioning\(Trait#\d+, CAAP_Group#\d+, \d+\)", plan.split("BroadcastExchange")[0]), name
        assert out.count() == 80
