"""Queries: readers and writers exercised on text that Spark derives from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitewise.operators import coordinates as G
from sitewise.operators import disambiguation as D
from sitewise.operators import scan as S
from sitewise.plans import q_scan as QS
from sitewise.plans.q_asr import SEQ, _CL_OUT, classify_sql, sequences
from sitewise.plans.registry import query
from sitewise.session import shared_folder
from sitewise.sinks import tables as K
from sitewise.sources import alignments as A
from sitewise.sources import archives as ARC
from sitewise.sources import tables as R
from sitewise.sources import trees as N


def text_of(df, key: str, line, order: str):
    """One text per key from its ordered lines."""
    m = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return df.groupBy(key).agg(F.array_join(F.transform(m, lambda x: x["l"]), "\n").alias("text"))


SEQ_OUT = "WITH " + SEQ + " SELECT gene, species, seq FROM sq"


@query("src01_fasta", SEQ_OUT)
def src01_fasta(t):
    """FASTA parser."""
    s = sequences(t)
    line = F.concat(F.lit(">"), "species", F.lit(" desc\n"), F.substring("seq", 1, 7), F.lit("\n"), F.expr("substring(seq, 8)"))
    return A.parse(text_of(s, "gene", line, "species"), "fasta")


@query("src01_phylip", SEQ_OUT)
def src01_phylip(t):
    """Relaxed PHYLIP parser, interleaved in two blocks."""
    s = sequences(t)
    head = s.groupBy("gene").agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), F.max(F.length("seq")).cast("string")).alias("h"))
    a = text_of(s, "gene", F.concat("species", F.lit("   "), F.substring("seq", 1, 6)), "species").withColumnRenamed("text", "a")
    b = text_of(s, "gene", F.concat(F.lit("  "), F.expr("substring(seq, 7)"), F.lit("~")), "species").withColumnRenamed("text", "b")
    out = A.parse(head.join(a, "gene").join(b, "gene").select("gene", F.concat_ws("\n", "h", "a", F.lit(""), "b").alias("text")), "phylip-relaxed")
    return out.withColumn("seq", F.replace("seq", F.lit("~"), F.lit("")))


@query("src01_clustal", SEQ_OUT)
def src01_clustal(t):
    """Clustal parser with repeated blocks."""
    s = sequences(t)
    a = text_of(s, "gene", F.concat("species", F.lit("  "), F.substring("seq", 1, 1)), "species").withColumnRenamed("text", "a")
    b = text_of(s.where("length(seq) > 1"), "gene", F.concat("species", F.lit("  "), F.expr("substring(seq, 2)")), "species").withColumnRenamed("text", "b")
    doc = a.join(b, "gene", "left").select("gene", F.concat_ws("\n", F.lit("CLUSTAL W\n"), "a", F.lit("      ** :\n"), "b").alias("text"))
    return A.parse(doc, "clustal")


@query("src01_nexus", SEQ_OUT)
def src01_nexus(t):
    """NEXUS matrix parser."""
    doc = text_of(sequences(t), "gene", F.concat("species", F.lit(" "), "seq"), "species")
    return A.parse(doc.withColumn("text", F.concat(F.lit("#NEXUS\nbegin data;\nmatrix\n"), "text", F.lit("\n;\nend;"))), "nexus")


@query("src01_stockholm", SEQ_OUT)
def src01_stockholm(t):
    """Stockholm parser."""
    doc = text_of(sequences(t), "gene", F.concat("species", F.lit("    "), "seq"), "species")
    return A.parse(doc.withColumn("text", F.concat(F.lit("# STOCKHOLM 1.0\n#=GF ID x\n"), "text", F.lit("\n//"))), "stockholm")


@query("src01_maf", SEQ_OUT)
def src01_maf(t):
    """MAF block parser."""
    line = F.concat(F.lit("s "), "species", F.lit(" 0 "), F.length("seq").cast("string"), F.lit(" + 100 "), "seq")
    doc = text_of(sequences(t), "gene", line, "species")
    return A.parse(doc.withColumn("text", F.concat(F.lit("##maf version=1\na score=1\n"), "text")), "maf")


@query("src02", "SELECT DISTINCT concat('/data/', Gene, '.x.fa.phy') AS path, Gene AS gene FROM {genes}")
def src02(t):
    """Gene name from an alignment path."""
    p = F.concat(F.lit("/data/"), "Gene", F.lit(".x.fa.phy"))
    return t.genes.select(p.alias("path"), A.gene_of(p).alias("gene"))


def numbered(df, key: str, line, order: list[str]):
    w = Window.partitionBy(key).orderBy(*order)
    return df.select(F.col(key).alias("path"), F.row_number().over(w).alias("line_no"), line.alias("line"))


@query("src04", "SELECT concat('t', CAST(s_nationkey AS VARCHAR)) AS trait, concat('S', CAST(s_suppkey AS VARCHAR)) AS species, CAST(s_suppkey % 2 AS INT) AS grp, CAST(s_suppkey % 5 AS VARCHAR) AS pair FROM {supplier}")
def src04(t):
    """Three-column trait configuration, one trait per file."""
    df = t.supplier.withColumn("path", F.concat(F.lit("/cfg/t"), F.col("s_nationkey").cast("string")))
    line = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"), F.lit("  "), (F.col("s_suppkey") % 2).cast("string"), F.lit(" "), (F.col("s_suppkey") % 5).cast("string"))
    return R.trait_config(df.select("path", F.lit(0).alias("line_no"), line.alias("line")))


@query("src05", """WITH r AS (SELECT CAST(s_nationkey AS VARCHAR) AS pair_id, s_suppkey, concat('S', CAST(s_suppkey AS VARCHAR)) AS sp, s_suppkey % 3 AS v FROM {supplier})
    SELECT pair_id, arg_min(sp, s_suppkey) FILTER (v = 1) AS top, arg_min(sp, s_suppkey) FILTER (v = 0) AS bottom FROM r GROUP BY 1 HAVING count(*) FILTER (v = 1) > 0 AND count(*) FILTER (v = 0) > 0""")
def src05(t):
    """Trait pairs: first species per side, non-binary rows dropped."""
    line = F.concat_ws("\t", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), (F.col("s_suppkey") % 3).cast("string"), F.col("s_nationkey").cast("string"))
    return R.trait_pairs(t.supplier.select(F.col("s_suppkey").alias("line_no"), line.alias("line")))


@query("src07", "SELECT Gene AS gene, CAST(Position AS VARCHAR) AS position, string_agg(DISTINCT s, ',' ORDER BY s) AS schemes FROM (SELECT *, CASE WHEN Position % 3 = 0 THEN 'CAAS' ELSE CAAP_Group END AS s FROM {sites}) z GROUP BY 1, 2")
def src07(t):
    """Discovery lines in three layouts to schemes per site."""
    c = F.col("Position").cast("string")
    line = F.when(F.col("Position") % 3 != 0, F.concat_ws("\t", "Gene", F.lit("CAAP"), "CAAP_Group", "Trait", c, F.lit("x"))).when(
        F.col("Position") % 2 == 0, F.concat_ws("\t", "Gene", F.lit("CAAS"), "Trait", c, F.lit("x"))).otherwise(
        F.concat_ws("\t", "Gene", F.lit("CAAS"), F.lit("US"), "Trait", c))
    out = R.discovery_schemes(t.sites.select(line.alias("line")))
    return out.select("gene", "position", F.array_join("schemes", ",").alias("schemes"))


@query("src08", "SELECT Gene, Position, CAAP_Group, 3 AS Occurrences, 100 AS Total, Pvalue AS Pvalue_boot FROM {sites}")
def src08(t):
    """Headerless bootstrap table."""
    raw = t.sites.select(F.concat_ws("@", "Gene", F.col("Position").cast("string")).alias("_c0"), F.when(F.col("CAAP_Group") == "US", "").otherwise(F.col("CAAP_Group")).alias("_c1"),
                         F.lit("3").alias("_c2"), F.lit("100").alias("_c3"), F.col("Pvalue").cast("string").alias("_c4"))
    return R.bootstrap(raw)


@query("src09", "SELECT concat(Gene, '_', CAST(Position AS VARCHAR)) AS GenePos, Pvalue <= 5e-2 AS isSignificant, 'US' AS CAAP_Group, false AS IsConserved FROM {sites} WHERE Gene = 'G1'")
def src09(t):
    """Metadata normalisation: alias, defaults, gene filter."""
    df = t.sites.select(F.concat_ws("_", "Gene", F.col("Position").cast("string")).alias("Gene_Pos"), F.lit("t").alias("Tag"), F.col("caas").alias("AminoConv"), (F.col("Pvalue") <= 0.05).alias("sig_both"))
    return R.caas_metadata(df, "G1").select("GenePos", "isSignificant", "CAAP_Group", "IsConserved")


@query("src09_all", "SELECT concat(Gene, '_', CAST(Position AS VARCHAR)) AS GenePos, Pvalue <= 5e-2 AS isSignificant, 'US' AS CAAP_Group, false AS IsConserved FROM {sites}")
def src09_all(t):
    """Metadata normalisation of all genes."""
    df = t.sites.select(F.concat_ws("_", "Gene", F.col("Position").cast("string")).alias("Gene_Pos"), F.lit("t").alias("Tag"), F.col("caas").alias("AminoConv"), (F.col("Pvalue") <= 0.05).alias("sig_both"))
    return R.caas_metadata(df).select("GenePos", "isSignificant", "CAAP_Group", "IsConserved")


@query("src11", "SELECT Gene, chr, start_bp, end_bp, Length FROM {genes}")
def src11(t):
    """Annotation reader with case-insensitive headers."""
    raw = t.genes.select(F.col("Gene").alias("GENE"), F.concat(F.lit(" "), "chr").alias("Chr"), F.col("start_bp").cast("string").alias("Start"),
                         F.col("end_bp").cast("string").alias("END"), F.col("Length").cast("string").alias("length"))
    return R.genomic_info(raw)


@query("src12", "SELECT DISTINCT Gene AS gene FROM {sites} WHERE Gene NOT IN ('G1')")
def src12(t):
    """Gene list with comments and blanks."""
    line = F.when(F.col("Gene") == "G1", "# G1").otherwise(F.concat(F.lit(" "), "Gene", F.lit(" \tnote")))
    return R.gene_list(t.sites.select(line.alias("line")))


@query("src13", "SELECT DISTINCT Gene AS gene FROM {sites} WHERE Gene <> 'G7'")
def src13(t):
    """Background list whose header line is skipped."""
    return R.background(t.sites.select(F.when(F.col("Gene") == "G7", "Gene").otherwise(F.col("Gene")).alias("line")))


@query("src14", "SELECT replace(coalesce(c.name, ''), ' ', '') AS name, c.branch_length, replace(p.name, ' ', '') AS parent FROM {tree} c LEFT JOIN {tree} p ON p.node_id = c.parent_id WHERE c.node_id IN (SELECT node_id FROM {tree} WHERE parent_id IS NOT NULL)")
def src14(t):
    """Newick texts, one for each clade, parsed back to edges in tasks."""
    tr = t.tree.withColumn("txt", F.concat("name", F.lit(":"), F.col("branch_length").cast("string")))
    above = t.tree.select(F.col("node_id").alias("parent_id"), F.col("name").alias("above"))
    kids = tr.where("node_id >= 1000").groupBy(F.col("parent_id").alias("node_id")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("txt")), ","), F.lit(") ")).alias("k"))
    clades = tr.where("node_id BETWEEN 1 AND 999").join(kids, "node_id", "left").join(above, "parent_id")
    e = N.parse_newick(clades.select("above", F.concat(F.coalesce("k", F.lit("")), "txt", F.lit(";")).alias("text")), "above")
    return e.select(F.coalesce("name", "label").alias("name"), "branch_length", F.replace(F.coalesce("parent", "above"), F.lit(" "), F.lit("")).alias("parent"))


@query("src14_genes", """WITH l AS (SELECT DISTINCT l_partkey AS pk, l_suppkey AS sk FROM {lineitem}), c AS (SELECT DISTINCT pk, sk % 3 AS m FROM l)
    SELECT concat('G', pk) AS gene, concat('S', sk) AS name, CAST(sk % 7 AS DOUBLE) / 4 AS branch_length, concat('c', sk % 3) AS parent FROM l
    UNION ALL SELECT concat('G', pk), concat('c', m), CAST(m AS DOUBLE) / 2, 'top' FROM c UNION ALL SELECT DISTINCT concat('G', pk), 'top', 0e0, NULL FROM l""")
def src14_genes(t):
    """A Newick text for each gene, parsed in tasks."""
    sk = F.col("l_suppkey")
    tip = F.concat(F.lit("S"), sk.cast("string"), F.lit(":"), (sk % 7 / 4).cast("string"))
    l = t.lineitem.select("l_partkey", "l_suppkey").distinct().groupBy("l_partkey", (sk % 3).alias("m")).agg(F.array_join(F.array_sort(F.collect_list(tip)), ", ").alias("tips"))
    clade = F.concat(F.lit("("), "tips", F.lit(")c"), F.col("m").cast("string"), F.lit(":"), (F.col("m") / 2).cast("string"))
    texts = l.groupBy(F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(clade)), ","), F.lit(")top;")).alias("text"))
    return N.parse_newick(texts).select("gene", F.coalesce("name", "label").alias("name"), "branch_length", "parent")


@query("src15", """SELECT concat('G', CAST(l_partkey AS VARCHAR)) AS gene, CAST(n AS INT) AS node_id, CAST(l_orderkey % 500 AS INT) AS site, substr('ACDEFGHIKLMNPQRSTVWY', CAST(1 + (min(l_suppkey) + n) % 20 AS INT), 1) AS aa, round(min(l_discount), 3) AS p
    FROM {lineitem} CROSS JOIN (SELECT unnest([7, 8]) AS n) z GROUP BY 1, 2, 3, l_partkey, n""")
def src15(t):
    """Reconstruction file parser, one text per gene."""
    rows = t.lineitem.groupBy(F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene"), (F.col("l_orderkey") % 500).cast("int").alias("site")).agg(
        F.min("l_suppkey").alias("s"), F.min("l_discount").alias("d"))
    aa = lambda n: F.substr(F.lit("ACDEFGHIKLMNPQRSTVWY"), (1 + (F.col("s") + n) % 20).cast("int"), F.lit(1))
    prob = F.concat(F.lit("("), F.format_string("%.3f", "d"), F.lit(")"))
    line = F.concat(F.lit("   "), F.col("site").cast("string"), F.lit("   1   AA: "), aa(7), prob, F.lit(" "), aa(8), prob)
    doc = text_of(rows, "gene", line, "site")
    head = f"{N.START} of ancestral sequences\n{N.BEST}, listed by site\n\n   {N.HEADER}\n"
    return N.parse_reconstructions(doc.withColumn("text", F.concat(F.lit(head), "text", F.lit("\n\nSummary of changes\nList of extant and reconstructed"))), [7, 8])


@query("src16", "SELECT gene, node_id, site, aa, p FROM {posteriors} WHERE node_id IN (100, 102)")
def src16(t):
    """Posterior JSON lines, focal nodes only."""
    per_site = t.posteriors.groupBy("gene", "node_id", "site").agg(F.map_from_entries(F.collect_list(F.struct("aa", "p"))).alias("m"))
    per_node = per_site.groupBy("gene", "node_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("site").cast("string"), "m"))).alias("positions"))
    return R.posterior_jsonl(per_node.select("gene", F.to_json(F.struct("node_id", "positions")).alias("line")), [100, 102])


FADE = "fx AS (SELECT gene, direction, target_aa, site, max(bayes_factor) AS bf FROM {fade} WHERE bayes_factor IS NOT NULL GROUP BY 1, 2, 3, 4)"


@query("src17", "WITH " + FADE + " SELECT concat(gene, '.', direction) AS gene, target_aa, CAST(row_number() OVER (PARTITION BY gene, direction, target_aa ORDER BY site) AS INT) AS site, bf AS bayes_factor FROM fx")
def src17(t):
    """Bayes-factor JSON documents, one for each gene and direction."""
    named = F.concat_ws(".", "gene", "direction").alias("gene")
    f = t.fade.where("bayes_factor IS NOT NULL").select(named, "target_aa", "site", "bayes_factor").groupBy("gene", "target_aa", "site").agg(F.max("bayes_factor").alias("bf"))
    reps = F.transform(F.array_sort(F.collect_list(F.struct("site", "bf"))), lambda x: F.array(F.lit(0.0), F.lit(1.0), x["bf"]))
    per = f.groupBy("gene", "target_aa").agg(reps.alias("r")).select("gene", "target_aa", F.create_map(F.lit("0"), "r").alias("parts"))
    doc = per.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("target_aa", "parts"))).alias("content"))
    headers = F.array(*[F.array(F.lit(a), F.lit("d")) for a in ("rate", "bias", "Bayes Factor")])
    text = F.to_json(F.struct(F.struct(headers.alias("headers"), "content").alias("MLE")))
    return R.fade_json(doc.select("gene", text.alias("text"))).select("gene", "target_aa", "site", "bayes_factor")


@query("src18", "SELECT chr, pos, ref_aa, alt_aa FROM {variants} WHERE pos % 10 <> 3")
def src18(t):
    """Variant table with malformed positions dropped."""
    pos = F.when(F.col("pos") % 10 == 3, "bad").otherwise(F.col("pos").cast("string"))
    return R.variant_table(t.variants.withColumn("pos", pos)).select("chr", "pos", "ref_aa", "alt_aa")


@query("src19", "SELECT query, concat('tx', CAST(min(Position) AS VARCHAR)) AS transcript, min(concat('chr', CAST(1 + CAST(substr(Gene, 2) AS BIGINT) % 3 AS VARCHAR))) AS chr, min(CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3) AS start_bp FROM {queries} GROUP BY query")
def src19(t):
    """Coordinate output: first parseable line per query."""
    tx = F.concat(F.lit("tx"), F.col("Position").cast("string"))
    bad = t.queries.select(F.lit(0).alias("line_no"), F.concat_ws("\t", "query", tx, F.lit("."), F.lit("."), F.lit("./././")).alias("line"))
    good = t.queries.select(F.lit(1).alias("line_no"), F.concat_ws("\t", "query", tx, F.lit("."), F.lit("."), "coord").alias("line"))
    return R.coordinates(bad.union(good)).select("query", "transcript", "chr", "start_bp")


@query("src20", "SELECT CASE WHEN ps % 2 = 0 THEN 'selected' ELSE 'removed' END AS kind, CAST(a AS INT) AS position, count(*) AS n FROM (SELECT p_partkey AS ps, unnest(range(p_size, p_size + 3)) AS a FROM {part} UNION ALL SELECT p_partkey, p_size + 60 FROM {part}) z GROUP BY 1, 2")
def src20(t):
    """Tracking intervals."""
    s = F.col("p_size")
    word = F.when(F.col("p_partkey") % 2 == 0, "selected:").otherwise("removed:")
    line = F.concat_ws(" ", F.lit("columns"), word, F.concat_ws("-", s.cast("string"), (s + 2).cast("string")), (s + 60).cast("string"))
    out = R.tracking_intervals(t.part.select(line.alias("line")))
    return out.groupBy("kind", "position").agg(F.count(F.lit(1)).alias("n"))


@query("src23", "WITH " + SEQ + ", ln AS (SELECT gene, concat('>', species, chr(10), seq) AS body FROM sq) SELECT concat('in/', gene, '.fa') AS member, CAST(row_number() OVER (PARTITION BY gene ORDER BY body) AS INT) AS n, body AS record FROM ln")
def src23(t):
    """Alignments packed into archives, one a partition, and read back without unpacking."""
    record = F.concat(F.lit(">"), "species", F.lit("\n"), "seq")
    texts = sequences(t).groupBy("gene").agg(F.array_join(F.array_sort(F.collect_list(record)), "\n").alias("text"))
    path = f"{shared_folder(t.spark)}/archives-{uuid.uuid4().hex}"
    ARC.write_archives(texts.repartition(8, "gene").select(F.concat(F.lit("in/"), "gene", F.lit(".fa")).alias("member"), F.col("text").cast("binary").alias("content")), path)
    lines = ARC.archive_lines(ARC.read_archives(t.spark, path, ".fa"))
    odd = lines.where("line_no % 2 = 1").select("member", (F.col("line_no") - 1).alias("line_no"), F.col("line").alias("seq"))
    return lines.where("line_no % 2 = 0").join(odd, ["member", "line_no"]).select("member", (F.col("line_no") / 2 + 1).cast("int").alias("n"), F.concat("line", F.lit("\n"), "seq").alias("record"))


@query("snk01", "SELECT Gene, Position, CAAP_Group, Pvalue FROM {sites} WHERE Pvalue <= 2e-2")
def snk01(t):
    """Discovery table, written because it has rows, and read back."""
    out = t.sites.where("Pvalue <= 0.02").select("Gene", "Position", "CAAP_Group", F.col("Pvalue").cast("double").alias("Pvalue"))
    path = f"{shared_folder(t.spark)}/discovery-{uuid.uuid4().hex}"
    if not K.write_if_any(out, path):
        return out
    return t.spark.read.schema(out.schema).option("sep", "\t").option("header", True).csv(path)


@query("snk11", "SELECT query, caas, coord FROM {queries}")
def snk11(t):
    """Compressed CSV with quoted fields, written and read back."""
    out = t.queries.select("query", "caas", "coord")
    path = f"{shared_folder(t.spark)}/csv-{uuid.uuid4().hex}"
    K.write_csv(out, path, compress=True)
    return t.spark.read.schema(out.schema).option("header", True).csv(path)


@query("src03", "SELECT concat(c_name, '.x.', CASE c_custkey % 5 WHEN 0 THEN 'fa' WHEN 1 THEN 'FASTA' WHEN 2 THEN 'phy' WHEN 3 THEN 'aln' ELSE 'fas' END) AS path, CASE WHEN c_custkey % 5 < 2 THEN 'fasta' ELSE 'phylip-relaxed' END AS format FROM {customer}")
def src03(t):
    """Alignment format by the end of the name."""
    end = F.element_at(F.array(*[F.lit(x) for x in ("fa", "FASTA", "phy", "aln", "fas")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return t.customer.select(F.concat("c_name", F.lit(".x."), end).alias("path")).withColumn("format", A.format_of(F.col("path")))


# A part's lines are the exons of a protein: sorted by order, on the minus strand for odd parts.
EXON = """ex AS (SELECT l_partkey AS pk, l_orderkey AS ok, min(l_linenumber) AS ln, CAST(max(l_quantity) AS BIGINT) AS q FROM {lineitem} GROUP BY 1, 2),
    xo AS (SELECT concat('P', pk) AS protein, concat('chr', 1 + pk % 22) AS chrom, CASE WHEN pk % 2 = 1 THEN '-' ELSE '+' END AS strand, ok * 100 AS st, ok * 100 + q - 1 AS en, q,
      sum(q) OVER (PARTITION BY pk ORDER BY CASE WHEN pk % 2 = 1 THEN -ok ELSE ok END) AS upto FROM ex)"""


def exon_lines(t):
    ex = t.lineitem.groupBy("l_partkey", "l_orderkey").agg(F.max("l_quantity").cast("long").alias("q"))
    pk, start = F.col("l_partkey").cast("string"), F.col("l_orderkey").cast("long") * 100
    strand = F.when(F.col("l_partkey") % 2 == 1, "-").otherwise("+")
    fields = lambda kind: F.concat_ws("\t", F.concat(F.lit("chr"), (1 + F.col("l_partkey") % 22).cast("string")), F.lit("src"), F.lit(kind), start.cast("string"), (start + F.col("q") - 1).cast("string"),
                                      F.lit("."), strand, F.lit("0"), F.concat(F.lit("ID=CDS:P"), pk, F.lit(";protein_id=P"), pk, F.lit(";x=1")))
    return ex.select(F.col("l_orderkey").alias("line_no"), F.explode(F.array(fields("CDS"), fields("exon"), F.lit("# note"))).alias("line"))


@query("src20_cds", "WITH " + EXON + " SELECT protein, chrom, strand, CAST(upto - q AS BIGINT) AS first, CAST(upto - 1 AS BIGINT) AS last, st AS start, en AS end FROM xo")
def src20_cds(t):
    """Coding offsets of the exons of all proteins."""
    return G.exon_offsets(G.coding_exons(exon_lines(t)))


@query("src20_map", "WITH " + EXON + """, bs AS (SELECT protein, chrom, strand, upto - q + unnest(range(q)) AS o, st, en, upto - q AS f FROM xo),
    pl AS (SELECT protein, chrom, strand, o, CASE WHEN strand = '-' THEN en - (o - f) ELSE st + (o - f) END AS place, f FROM bs),
    rs AS (SELECT DISTINCT concat('P', substr(Gene, 2)) AS protein, Position AS residue FROM {sites} WHERE Position > 0)
    SELECT r.protein, r.residue, chrom, strand, CAST(min(place) AS BIGINT) AS start, CAST(max(place) AS BIGINT) AS end, count(DISTINCT f) AS parts, count(*) AS bases,
      concat(any_value(chrom), ':g.', min(place), CASE WHEN min(place) = max(place) THEN '' ELSE concat('_', max(place)) END) AS coord
    FROM rs r JOIN pl ON pl.protein = r.protein AND o >= 3 * (residue - 1) AND o < 3 * residue GROUP BY 1, 2, 3, 4""")
def src20_map(t):
    """Genomic place of residues of all proteins, codons over several exons included."""
    want = t.sites.select(F.concat(F.lit("P"), F.substring("Gene", 2, 20)).alias("protein"), F.col("Position").alias("residue"))
    return G.codon_places(want, G.exon_offsets(G.coding_exons(exon_lines(t)))).withColumn("coord", G.place_text("chrom", "start", "end"))


CODON = """cd AS (SELECT l_partkey AS pk, l_orderkey AS ok, l_linenumber AS ln, CAST(l_quantity AS BIGINT) % 9 AS q FROM {lineitem}),
    ck AS (SELECT concat('G', pk) AS gene, pk, row_number() OVER (PARTITION BY pk ORDER BY ok, ln, least(q, 2)) AS codon, count(*) OVER (PARTITION BY pk) AS n, q > 1 AS good FROM cd),
    cn AS (SELECT *, CAST(sum(CASE WHEN good THEN 1 ELSE 0 END) OVER (PARTITION BY pk ORDER BY codon) AS BIGINT) AS residue, count(*) FILTER (good) OVER (PARTITION BY pk) - 1 + pk % 3 AS full_n FROM ck),
    cr AS (SELECT gene, codon, residue FROM cn WHERE good AND residue <= full_n OR (codon = n AND residue < full_n AND residue > 0))"""


def aligned_codons(t):
    q = F.col("l_quantity").cast("long") % 9
    codon = F.when(q == 0, "---").when(q == 1, "ANG").otherwise("ATG")
    parts = F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", codon.alias("c"))))
    seq = t.lineitem.groupBy("l_partkey").agg(F.array_join(F.transform(parts, lambda x: x["c"]), "").alias("seq"), F.count_if(q > 1).alias("k"))
    gene = F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene")
    full = G.fasta_lengths(seq.select(gene, F.repeat(F.lit("ATG"), (F.col("k") - 1 + F.col("l_partkey") % 3).cast("int")).alias("seq")))
    return seq.select(gene, "seq").join(full, "gene")


@query("src20_residues", "WITH " + CODON + " SELECT gene, codon, residue FROM cr")
def src20_residues(t):
    """Residues of aligned codons, gaps and masked codons skipped."""
    return G.codon_residues(aligned_codons(t))


@query("src20_positions", "WITH " + CODON + """, tk AS (SELECT p_partkey AS pk, unnest(list_concat(range(1, 4 + p_size % 9), [30], range(12, 15))) AS codon, unnest(range(3 + p_size % 9 + 1 + 3)) AS position FROM {part})
    SELECT c.gene, CAST(tk.position AS BIGINT) AS position, c.codon, residue, concat(c.gene, ':p.', residue) AS query FROM tk JOIN cr c ON c.gene = concat('G', tk.pk) AND c.codon = tk.codon
    JOIN (SELECT DISTINCT Gene, Position FROM {sites}) s ON s.Gene = c.gene AND s.Position = tk.position""")
def src20_positions(t):
    """Filtered positions of all genes led back to residues."""
    line = F.concat(F.lit("columns kept selected: 1-"), (3 + F.col("p_size") % 9).cast("string"), F.lit(" 30 x 12-14 9-8"))
    lines = t.part.select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("gene"), line.alias("line"))
    sites = t.sites.select(F.col("Gene").alias("gene"), F.col("Position").alias("position"))
    return G.protein_positions(sites, G.tracked(lines), G.codon_residues(aligned_codons(t)))


@query("src22", "SELECT DISTINCT set_name, gene FROM {gene_sets}")
def src22(t):
    """GMT lines."""
    doc = t.gene_sets.groupBy("set_name").agg(F.array_sort(F.collect_list("gene")).alias("g"))
    return R.gmt(doc.select(F.concat_ws("\t", "set_name", F.lit("descr"), "g").alias("line")))


@query("src24", "SELECT species, taxon, value, n_population, n_cases FROM {traits}")
def src24(t):
    """Wide trait table, trimmed and typed."""
    raw = t.traits.select(F.concat(F.lit(" "), "species", F.lit(" ")).alias("species"), F.col("taxon").alias("family"), F.col("value").cast("string").alias("bmi"),
                          F.col("n_population").cast("string").alias("n"), F.col("n_cases").cast("string").alias("c"))
    return R.wide_traits(raw, "family", "bmi", "n", "c")


@query("st06", "SELECT c_name, c_custkey AS k FROM {customer} ORDER BY c_custkey")
def st06(t):
    """Version order of chunk files."""
    return t.customer.select("c_name", R.version_key(F.concat("c_name", F.lit(".tab"))).alias("k")).orderBy("k")


# ------------------------------------------------------------------ sinks
@query("snk03", "SELECT Gene, Position, CAAP_Group, tag FROM {acc_sites} UNION ALL SELECT Gene, Position, CAAP_Group, NULL FROM {acc_sites} WHERE CAAP_Group = 'US'")
def snk03(t):
    """Concatenation with a missing column."""
    a = t.acc_sites.select("Gene", "Position", "CAAP_Group", "tag")
    return K.concat([a, a.where("CAAP_Group = 'US'").drop("tag")])


@query("snk04", QS.SIDES + " SELECT DISTINCT gene FROM tested")
def snk04(t):
    """Background genes with a tested position."""
    return K.background_genes(K.render_background(S.background(QS._tested(t), t.cells)))


@query("snk05", "SELECT concat(Gene, '@', CAST(Position AS VARCHAR)) AS GenePos, CAAP_Group, 5 AS Occurrences, 100 AS Total, Pvalue AS Pvalue_boot FROM {sites}")
def snk05(t):
    """Bootstrap lines."""
    b = t.sites.select("Gene", "Position", "CAAP_Group", F.lit(5).alias("Occurrences"), F.lit(100).alias("Total"), F.col("Pvalue").alias("Pvalue_boot"))
    return K.bootstrap_lines(b)


@query("snk06", "SELECT cycle, string_agg(species, ',' ORDER BY species) FILTER (rk <= 4) AS fg, string_agg(species, ',' ORDER BY species) FILTER (rk > 4) AS bg FROM {resamples} GROUP BY cycle")
def snk06(t):
    """Resample lines written and read back through the text form."""
    r = QS.resample_sets(t)
    line = F.concat_ws("\t", "cycle", F.array_join("fg", ","), F.array_join("bg", ","))
    back = R.resamples(r.select(line.alias("line")))
    return back.select("cycle", F.array_join("fg", ",").alias("fg"), F.array_join("bg", ",").alias("bg"))


@query("snk09", "WITH " + classify_sql() + """, pj AS (SELECT gene, site, count(*) AS n_pairs, count(*) FILTER (top_tip = bottom_tip) AS n_conserved, count(*) FILTER (focal_state <> top_tip) AS n_top_changed FROM {pair_states} GROUP BY 1, 2)
    SELECT c.gene, c.site, c.change_top, p.n_pairs, p.n_conserved, p.n_top_changed FROM cl c JOIN pj p ON p.gene = c.gene AND p.site = c.site""")
def snk09(t):
    """Site JSON documents, read back."""
    doc = K.pair_json(t.pair_states, D.classify(t.pair_states))
    schema = "change_top string, pairs array<struct<pair_id: int, conserved: boolean, top_change: struct<changed: boolean>>>"
    j = doc.select("gene", "site", F.from_json("json", schema).alias("j"))
    n = lambda f: F.size(F.filter("j.pairs", f)).cast("long")
    return j.select("gene", "site", "j.change_top", F.size("j.pairs").cast("long").alias("n_pairs"), n(lambda x: x["conserved"]).alias("n_conserved"),
                    n(lambda x: F.coalesce(x["top_change"]["changed"], F.lit(False))).alias("n_top_changed"))


@query("snk09_gene", "WITH " + classify_sql() + ", o AS (" + _CL_OUT.strip() + """) SELECT gene, concat(chr(123), '"n_sites":', count(*), ',"n_top":', count(*) FILTER (change_side = 'top'), ',"n_bottom":', count(*) FILTER (change_side = 'bottom'),
    ',"n_both":', count(*) FILTER (change_side = 'both'), ',"n_none":', count(*) FILTER (change_side = 'none'), chr(125)) AS json FROM o GROUP BY gene""")
def snk09_gene(t):
    """Gene summary JSON."""
    return K.gene_json(D.classify(t.pair_states))


@query("snk12", "SELECT DISTINCT Gene AS gene FROM {sites} WHERE Pvalue <= 0 ORDER BY gene")
def snk12(t):
    """Gene list lines."""
    return K.gene_lines(t.sites.where("Pvalue <= 0"), "Gene")


# ------------------------------------------------------------------ leftovers of the scan
@query("jn25", QS._hits() + ", g AS (SELECT DISTINCT gene FROM hits) SELECT c.gene, count(*) AS n_columns FROM colstat c JOIN g ON g.gene = c.gene GROUP BY 1")
def jn25(t):
    """Alignments gated by genes with a discovery."""
    genes = QS._discovery(t).select(F.col("Gene").alias("gene")).distinct()
    return QS.columns(t).join(genes, "gene", "left_semi").groupBy("gene").agg(F.count(F.lit(1)).alias("n_columns"))


@query("ps08", QS.BOOT + """, e AS (SELECT gene, position, scheme, sum(h) * 1e0 / count(*) AS p FROM hit GROUP BY 1, 2, 3)
    SELECT scheme AS CAAP_Group, count(*) AS n_sites, round(avg(p), 6) AS mean_p, count(*) FILTER (p <= 5e-2) AS n_sig FROM e GROUP BY 1""")
def ps08(t):
    """Empirical p-values summarised per scheme."""
    b = S.bootstrap(QS.columns(t), QS._discovery(t), QS.resample_sets(t), QS.index(t), QS.BOOT_LIMITS)
    return b.groupBy("CAAP_Group").agg(F.count(F.lit(1)).alias("n_sites"), F.round(F.avg("Pvalue_boot"), 6).alias("mean_p"), F.count_if(F.col("Pvalue_boot") <= 0.05).alias("n_sig"))


PS03 = QS._hits(1) + """
    , mt AS (SELECT h.gene, h.position, h.scheme, substr(efg, i, 1) AS sym, count(*) AS k FROM hits h CROSS JOIN (SELECT unnest(range(1, 6)) AS i) r
             WHERE i <= least(length(efg), length(ebg)) AND substr(efg, i, 1) = substr(ebg, i, 1) GROUP BY 1, 2, 3, 4),
    ms AS (SELECT gene, position, scheme, sum(k) AS k FROM mt GROUP BY 1, 2, 3),
    raw AS (SELECT h.gene, h.position, h.scheme, length(h.fg) - coalesce(ms.k, 0) AS f, length(h.bg) - coalesce(ms.k, 0) AS b,
              translate(s.residue, '""" + QS.RESIDUES + """', h.codes) AS sym, sum(s.n) AS n
            FROM hits h JOIN sym s ON s.gene = h.gene AND s.position = h.position LEFT JOIN ms ON ms.gene = h.gene AND ms.position = h.position AND ms.scheme = h.scheme
            GROUP BY 1, 2, 3, 4, 5, 6),
    freq AS (SELECT r.gene, r.position, r.scheme, r.f, r.b, r.sym, r.n - 2 * coalesce(mt.k, 0) AS n FROM raw r
             LEFT JOIN mt ON mt.gene = r.gene AND mt.position = r.position AND mt.scheme = r.scheme AND mt.sym = r.sym WHERE r.n - 2 * coalesce(mt.k, 0) > 0)"""


@query("ps03", PS03 + QS.PVALUE[QS.PVALUE.index("    tot AS"):].replace("    tot AS", ", tot AS", 1).replace("CASE WHEN max(k) < 2", "CASE WHEN max(f) <= 0 OR max(b) <= 0 THEN 1e0 WHEN max(k) < 2", 1)
       + " SELECT gene, position, scheme, round(pvalue, 9) AS pvalue FROM pv")
def ps03(t):
    """p-value over the population without conserved pairs."""
    return QS._discovery(t, max_conserved=1).select(
        F.col("Gene").alias("gene"), F.col("Position").alias("position"), F.col("CAAP_Group").alias("scheme"), F.round("Pvalue", 9).alias("pvalue"))
