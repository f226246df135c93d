
import pytest
from pyspark.sql import functions as F

from sitewise import cli
from sitewise.operators import resampling as R
from sitewise.operators import trees as T
from sitewise.operators.selection import mark_foreground
from sitewise.plans import pipeline
from sitewise.sinks import tables as K
from sitewise.sources import alignments as A
from sitewise.sources import tables as B
from sitewise.sources import trees as N

NEWICK = "((a:1,b:2) 7:0.5,(c:1,(d:1,e:x)9:1)8:1)6;"


def test_newick(spark):
    with pytest.warns(UserWarning):
        rows = N.newick_edges(NEWICK)
    assert [r[2] or r[4] for r in rows] == ["a", "b", "7", "c", "d", "e", "9", "8", "6"]
    assert rows[0][1] == rows[1][1] == 2 and rows[-1][1] is None
    assert rows[5][3] == 0.0


def test_tree_operators(spark):
    e = N.edge_frame(spark, "((a:1,b:2)x:0.5,(c:1,(d:1,e:3)y:1)z:1)r;").withColumn("name", F.coalesce("name", "label"))
    d = {(r["species1"], r["species2"]): r["distance"] for r in T.patristic(e, spark.createDataFrame([(s,) for s in "abcde"], "species string")).collect()}
    assert d["a", "b"] == 3 and d["a", "c"] == 3.5 and d["d", "e"] == 4 and len(d) == 20
    pruned = T.prune(e, spark.createDataFrame([("a",), ("d",), ("e",)], "species string"))
    got = {r["name"]: (r["parent_id"] is None, r["branch_length"]) for r in pruned.collect()}
    assert got == {"r": (True, 0.0), "a": (False, 1.5), "y": (False, 2.0), "d": (False, 1.0), "e": (False, 3.0)}


def test_mark_foreground(spark):
    df = spark.createDataFrame([("(ab:1,abc:2,'ab':3);",)], "t string")
    assert df.select(mark_foreground(F.col("t"), ["ab"])).collect()[0][0] == "(ab{Foreground}:1,abc:2,'ab'{Foreground}:3);"


def test_reconstruction_errors():
    with pytest.raises(ValueError):
        list(N.reconstruction_rows("nothing", [1]))
    text = f"{N.START}\n{N.BEST}\n{N.HEADER}\n  1  1  AC: A(0.9) C(bad)\n  2  1  AC: G(1.0) T(0.5)\n(2) Joint\n  3  1  A: A(1.0)"
    assert list(N.reconstruction_rows(text, [8, 7])) == [(7, 1, "A", 0.9), (7, 2, "G", 1.0), (8, 2, "T", 0.5)]


def test_trait_config_is_strict(spark, tmp_path):
    (tmp_path / "ok").write_text("s1 1 1\ns2\t0\t1\n")
    assert B.trait_config(B.read_lines(spark, str(tmp_path / "ok"))).count() == 2
    (tmp_path / "bad").write_text("s1 1\n")
    with pytest.raises(Exception, match="needs species"):
        B.trait_config(B.read_lines(spark, str(tmp_path / "bad"))).collect()


def test_alignment_folder(spark, tmp_path):
    (tmp_path / "G1.x.fa").write_text(">a one\nAC\nD\n>b\nAC-\n>a again\nKKK\n")
    (tmp_path / "G2.phy").write_text("2 4\na  AC\nb  DE\n\n  GH\n  IK\n")
    (tmp_path / "notes.txt").write_text("no alignment")
    got = sorted(map(tuple, A.read_alignments(spark, str(tmp_path)).collect()))
    assert got == [("G1", "a", "KKK"), ("G1", "b", "AC-"), ("G2", "a", "ACGH"), ("G2", "b", "DEIK")]
    assert A.infer_format("x.fasta") == "fasta" and A.infer_format("x.aln") == "phylip-relaxed"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("g1", [3, 1]), ("g2", None)], "gene string, positions array<int>")
    K.write_tsv(K.render_background(df), str(tmp_path / "bg"), header=False)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "bg")).collect()) == ["g1\t3,1", "g2\tNULL"]
    K.write_csv(K.json_cells(df), str(tmp_path / "z"), compress=True)
    assert list((tmp_path / "z").glob("*.csv.gz"))
    K.write_results(df, str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2
    assert K.write_gene_list(df.where("false"), str(tmp_path / "none")) is False
    assert K.write_if_any(df.where("false"), str(tmp_path / "nothing")) is False and not (tmp_path / "nothing").exists()
    res = spark.createDataFrame([(f"b_{i}", ["a"], ["b", "c"]) for i in range(7)], "cycle string, fg array<string>, bg array<string>").coalesce(1)
    K.write_resamples(res, str(tmp_path / "res"), chunk=3)
    assert len(list((tmp_path / "res").glob("part-*.csv"))) == 3
    back = B.resamples(spark.read.text(str(tmp_path / "res")).withColumnRenamed("value", "line"))
    assert sorted(map(str, back.collect())) == sorted(map(str, res.collect()))


def test_resampling_properties(spark):
    e = N.edge_frame(spark, "(((a:1,b:1):1,(c:1,d:1):1):1,((e:1,f:1):1,(g:1,h:1):1):1);")
    values = spark.createDataFrame([(s, float(i)) for i, s in enumerate("abcdefgh")], "species string, value double")
    cfg = spark.createDataFrame([("a", 1), ("b", 1), ("g", 0), ("h", 0)], "species string, grp int")
    cyc = R.cycles(spark, 200)
    for out in (R.random_labels(cyc, values, 2, 2), R.permulated_labels(cyc, e, values, cfg),
                R.family_labels(cyc, cfg, spark.createDataFrame([(s, "x" if s < "e" else "y") for s in "abcdefgh"], "species string, family string"))):
        rows = out.collect()
        assert len(rows) == 200 and all(len(set(r["fg"])) == 2 and len(set(r["bg"])) == 2 and not set(r["fg"]) & set(r["bg"]) for r in rows)
        assert len({tuple(r["fg"]) for r in rows}) > 3
        assert sorted(map(str, out.collect())) == sorted(map(str, rows))
    assert all(set(r["fg"]) <= set("abcd") and set(r["bg"]) <= set("efgh") for r in rows)
    both = spark.createDataFrame([("a", 1), ("a", 0)], "species string, grp int")
    with pytest.raises(ValueError, match="too small"):
        R.family_labels(cyc, both, spark.createDataFrame([("a", "x")], "species string, family string"))


def sequences(spark):
    rows = []
    for g in range(6):
        for i in range(10):
            fg = i < 4
            rows.append((f"g{g}", f"s{i}", "".join("R" if fg and p % (g + 2) == 0 else "A" if p % 3 else "K" for p in range(40))))
    return spark.createDataFrame(rows, "gene string, species string, seq string")


def config(spark, n=8):
    return spark.createDataFrame([("t", f"s{i}", int(i < 4), i % 4 + 1) for i in range(n)], "trait string, species string, grp int, pair int")


def test_pipeline_chains_every_stage(spark):
    seqs = sequences(spark)
    genes = spark.createDataFrame([(f"g{g}", "chr1", g * 1000, g * 1000 + 120, 40) for g in range(6)], "Gene string, chr string, start_bp long, end_bp long, Length long")
    pairs = spark.createDataFrame([(f"g{g}", p, k, "A", "A", "R", "A", 0.9) for g in range(6) for p in range(40) for k in (1, 2)],
                                  "gene string, site int, pair_id int, focal_state string, mrca_state string, top_tip string, bottom_tip string, posterior double")
    s = pipeline.Settings(cycles=30, n_randomizations=50)
    out = pipeline.run(pipeline.Inputs(seqs, config(spark), genes=genes, pair_states=pairs), s)
    assert out["discovery"].count() > 0
    boot = out["bootstrap"].collect()
    assert all(r["Total"] == 31 and 1 <= r["Occurrences"] <= 31 for r in boot)  # the observed labels always hit
    assert out["meta"].where("SignificanceLevel = 'Not Significant'").count() == 0
    assert out["filtered"].count() <= out["significance"].count()
    assert {r["gene"] for r in out["background"].collect()} == {f"g{g}" for g in range(6)}
    acc = out["accumulation"].where("category = 'all'")
    assert acc.count() == 6 and acc.where("PValueEmpirical > 1 OR PValueEmpirical <= 0").count() == 0


def test_empty_inputs_keep_their_schema(spark):
    few = pipeline.run(pipeline.Inputs(sequences(spark), config(spark).where("species IN ('s0', 's5')")))
    assert few["discovery"].count() == 0 and "Pvalue" in few["discovery"].columns
    none = pipeline.run(pipeline.Inputs(sequences(spark).where("false"), config(spark)), pipeline.Settings(cycles=3, resample_strategy="random"))
    assert none["discovery"].count() == 0 and none["bootstrap"].count() == 0 and none["meta"].count() == 0
    assert none["cluster_flags"].columns[-1] == "ClusteringFlag"


def test_command_line(spark, tmp_path):
    ali = tmp_path / "ali"
    ali.mkdir()
    by_gene = {}
    for r in sequences(spark).collect():
        by_gene.setdefault(r["gene"], []).append(f">{r['species']}\n{r['seq']}\n")
    for g, recs in by_gene.items():
        (ali / f"{g}.fa").write_text("".join(recs))
    (tmp_path / "cfg").write_text("".join(f"{r['species']} {r['grp']} {r['pair']}\n" for r in config(spark).collect()))
    (tmp_path / "values.tsv").write_text("".join(f"s{i}\t{i}.0\n" for i in range(10)))
    base = ["--traitfile", str(tmp_path / "cfg"), "--output", str(tmp_path / "out")]
    cli.main(["discovery", *base, "--alignments", str(ali), "--caap"])
    cli.main(["resample", *base, "--values", str(tmp_path / "values.tsv"), "--cycles", "20"])
    cli.main(["bootstrap", *base, "--alignments", str(ali), "--caap", "--resamples", str(tmp_path / "out/resamples"), "--discovery", str(tmp_path / "out/discovery")])
    cli.main(["signify", "--output", str(tmp_path / "out"), "--discovery", str(tmp_path / "out/discovery"), "--bootstrap", str(tmp_path / "out/bootstrap")])
    meta = spark.read.csv(str(tmp_path / "out/meta"), sep="\t", header=True)
    assert meta.count() == spark.read.csv(str(tmp_path / "out/discovery"), sep="\t", header=True).count() > 0


def test_more_commands(spark, tmp_path):
    out = ["--output", str(tmp_path / "out")]
    rows = [("g", 1, 1, "A", "A", "V", "A", 0.9), ("g", 1, 2, "A", "A", "V", "A", 0.8), ("h", 4, 1, "A", "A", "A", "A", 0.9), ("h", 4, 2, "A", "A", "A", "A", 0.7)]
    head = "gene\tsite\tpair_id\tfocal_state\tmrca_state\ttop_tip\tbottom_tip\tposterior\n"
    (tmp_path / "pairs.tsv").write_text(head + "".join("\t".join(map(str, r)) + "\n" for r in rows))
    for _ in range(2):  # again: the store is the same
        cli.main(["disambiguate", *out, "--pairs", str(tmp_path / "pairs.tsv")])
    master = {r["gene"]: r for r in spark.read.csv(str(tmp_path / "out/master"), header=True).collect()}
    assert sorted(master) == ["g", "h"] and master["g"]["change_side"] == "top" and master["h"]["change_side"] == "none" and master["g"]["mrca_2_posterior"] == "0.8"
    (tmp_path / "len.tsv").write_text("gene\tbranch\tlength\n" + "".join(f"g{g}\tb{b}\t{(g * 7 + b * b * 3) % 11 / 10}\n" for g in range(4) for b in range(12)))
    (tmp_path / "trait.tsv").write_text("branch\tvalue\n" + "".join(f"b{b}\t{b * 5 % 7}\n" for b in range(12)))
    (tmp_path / "perm.tsv").write_text("perm\tbranch\tvalue\n" + "".join(f"{p}\tb{b}\t{(b * 5 + p) % 7 + b * p % 3}\n" for p in range(20) for b in range(12)))
    cli.main(["rates", *out, "--lengths", str(tmp_path / "len.tsv"), "--trait-values", str(tmp_path / "trait.tsv"), "--permutations", str(tmp_path / "perm.tsv"), "--winsorise", "1"])
    got = spark.read.csv(str(tmp_path / "out/rates"), sep="\t", header=True).collect()
    assert len(got) == 4 and all(r["n_perms"] == "20" and 0 <= float(r["p_perm"]) <= 1 for r in got)
    (tmp_path / "a.gff").write_text("#x\nchr1\ts\tCDS\t11\t14\t.\t-\t0\tprotein_id=p\nchr1\ts\tCDS\t21\t25\t.\t-\t0\tprotein_id=p\n")
    (tmp_path / "res.tsv").write_text("protein\tresidue\np\t1\np\t2\np\t9\n")
    cli.main(["places", *out, "--gff", str(tmp_path / "a.gff"), "--residues", str(tmp_path / "res.tsv")])
    assert sorted(r["coord"] for r in spark.read.csv(str(tmp_path / "out/places"), sep="\t", header=True).collect()) == ["chr1:g.14_22", "chr1:g.23_25"]


def test_conserved_flags(spark):
    from sitewise.operators import disambiguation

    sites = spark.createDataFrame([("g", 1, "US", "1:1"), ("g", 1, "GS1", "2:1,2"), ("g", 2, "US", "1:2"), ("g", 3, "US", "0:"), ("g", 4, "US", None), ("g", 5, "US", "1:1")],
                                  "Gene string, Position int, CAAP_Group string, ConservedPairs string")
    pairs = spark.createDataFrame([("g", p, k, top, "A", "A", "A", 0.9) for p, k, top in ((1, 1, "A"), (1, 2, "A"), (2, 1, "A"), (2, 2, "V"), (3, 1, "A"), (5, 1, None))],
                                  "gene string, site int, pair_id int, top_tip string, bottom_tip string, focal_state string, mrca_state string, posterior double")
    got = {(r.Position, r.CAAP_Group): (r.is_conserved_meta, r.conserved_pair, r.asr_is_conserved, r.asr_root_conserved) for r in disambiguation.conserved_flags(sites, pairs).collect()}
    assert got == {(1, "US"): ("true", "1", "true", "true"), (1, "GS1"): ("true", "1,2", "true", "true"), (2, "US"): ("true", "2", "false", "false"),
                   (3, "US"): ("false", "", "false", "false"), (4, "US"): ("false", "", "false", "false"), (5, "US"): ("true", "1", "false", "false")}
    plain = disambiguation.conserved_flags(sites.drop("ConservedPairs"), pairs.drop("mrca_state", "posterior")).collect()
    assert len(plain) == 6 and {r.is_conserved_meta for r in plain} == {"false"}


def test_draws_of_equal_rows(spark):
    from pyspark.sql import functions as F

    from sitewise.operators import accumulation

    rows = spark.createDataFrame([("g", 5, "US", False)] * 3 + [("g", 9, "US", False)], "gene string, global_pos int, CAAP_Group string, masked boolean")
    hits = spark.createDataFrame([(1, "t")], "global_pos int, tag string")
    got = accumulation.individual_draws(rows, hits, 8, F.col("rand_id")).collect()
    assert sorted((int(r.rand_id), r.randomized_position) for r in got) == [(k, 9 if k % 4 == 3 else 5) for k in range(8)]
