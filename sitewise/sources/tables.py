"""Readers of the text tables, split into a raw read and a DataFrame-level parser."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.labels import codon_range, protein_ref
from sitewise.functions.schemes import RESIDUES, SCHEMES


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, line_no, line`` of every file; line numbers restart per file.

    Meant for configuration and list files; big tables go through the CSV readers.
    """
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n"))).select(
        "path", F.col("pos").alias("line_no"), F.col("col").alias("line")).where(F.trim("line") != "")


def trait_config(lines: DataFrame, trait: Column | None = None) -> DataFrame:
    """``trait, species, grp, pair`` from three-column lines; any other width raises.

    With several files the trait is the file name, otherwise the given literal.
    """
    parts = F.split(F.trim("line"), r"\s+")
    checked = F.when(F.size(parts) == 3, parts).otherwise(
        F.raise_error(F.concat(F.lit("trait line needs species, group and pair: "), "line")).cast("array<string>"))
    name = trait if trait is not None else F.regexp_extract("path", r"([^/]+)$", 1)
    return lines.select(name.alias("trait"), checked.alias("p")).select(
        "trait", F.get("p", F.lit(0)).alias("species"), F.get("p", F.lit(1)).try_cast("int").alias("grp"), F.get("p", F.lit(2)).alias("pair"))


def trait_pairs(lines: DataFrame) -> DataFrame:
    """``pair_id, top, bottom``: first species per side in file order; incomplete pairs drop out."""
    p = F.split("line", "\t", -1)
    rows = lines.where(F.size(p) == 3).select(
        "line_no", F.trim(F.get(p, F.lit(0))).alias("species"), F.trim(F.get(p, F.lit(1))).try_cast("int").alias("v"), F.trim(F.get(p, F.lit(2))).alias("pair_id"))
    rows = rows.where("species <> '' AND pair_id <> '' AND v IN (0, 1)")
    out = rows.groupBy("pair_id").agg(
        F.min_by("species", F.when(F.col("v") == 1, F.col("line_no"))).alias("top"),
        F.min_by("species", F.when(F.col("v") == 0, F.col("line_no"))).alias("bottom"))
    return out.where("top IS NOT NULL AND bottom IS NOT NULL")


def resamples(lines: DataFrame) -> DataFrame:
    """``cycle, fg, bg`` from ``cycle<TAB>a,b<TAB>c,d`` lines."""
    p = F.split("line", "\t")
    return lines.select(F.get(p, F.lit(0)).alias("cycle"), F.split(F.get(p, F.lit(1)), ",").alias("fg"), F.split(F.get(p, F.lit(2)), ",").alias("bg"))


def version_key(path: Column) -> Column:
    """Number embedded in a chunk file name, for version order."""
    return F.regexp_extract(path, r"(\d+)\D*$", 1).try_cast("long")


def discovery_schemes(lines: DataFrame) -> DataFrame:
    """``gene, position, schemes`` from discovery lines of any layout.

    A classical row, with or without a scheme column, is marked ``CAAS`` and re-tests
    every scheme later; a property row names its own scheme.
    """
    p = F.split("line", "\t")
    get = lambda i: F.get(p, F.lit(i))
    wide = (F.size(p) >= 5) & get(2).isin(*SCHEMES)
    pos = F.when((get(1) == "CAAP") & (F.size(p) >= 5), get(4)).when((get(1) == "CAAS") & wide, get(4)).when((get(1) == "CAAS") & (F.size(p) >= 4), get(3))
    tag = F.when(get(1) == "CAAP", get(2)).when(get(1) == "CAAS", F.lit("CAAS"))
    rows = lines.where(~F.col("line").startswith("Gene") & (F.size(p) >= 3)).select(get(0).alias("gene"), pos.alias("position"), tag.alias("s"))
    return rows.where("position IS NOT NULL AND s IS NOT NULL").groupBy("gene", "position").agg(F.array_sort(F.collect_set("s")).alias("schemes"))


def bootstrap(raw: DataFrame) -> DataFrame:
    """Headerless bootstrap table (``_c0`` ...) of five or the older four columns."""
    cols = raw.columns
    five = len(cols) >= 5
    names = ["GenePos", "CAAP_Group", "Occurrences", "Total", "Pvalue_boot"] if five else ["GenePos", "Occurrences", "Total", "Pvalue_boot"]
    df = raw.select(*[F.col(c).alias(n) for c, n in zip(cols, names)])
    if not five:
        df = df.withColumn("CAAP_Group", F.lit("US"))
    df = df.where("GenePos IS NOT NULL AND GenePos <> 'Gene@Position'")
    group = F.when(F.col("CAAP_Group").isNull() | (F.col("CAAP_Group") == ""), "US").otherwise(F.col("CAAP_Group"))
    return df.select(
        F.split_part("GenePos", F.lit("@"), F.lit(1)).alias("Gene"), F.split_part("GenePos", F.lit("@"), F.lit(2)).try_cast("int").alias("Position"),
        group.alias("CAAP_Group"), F.col("Occurrences").try_cast("int").alias("Occurrences"), F.col("Total").try_cast("int").alias("Total"),
        F.col("Pvalue_boot").try_cast("double").alias("Pvalue_boot"))


def read_bootstrap(spark: SparkSession, path: str) -> DataFrame:
    return bootstrap(spark.read.csv(path, sep="\t", header=False))


def caas_metadata(df: DataFrame, gene: str | None = None) -> DataFrame:
    """Normalise the significance export: position column alias, significance flag, defaults."""
    if "Gene_Pos" in df.columns and "GenePos" not in df.columns:
        df = df.withColumnRenamed("Gene_Pos", "GenePos")
    missing = [c for c in ("Tag", "AminoConv", "GenePos") if c not in df.columns]
    if missing:
        raise ValueError(f"metadata lacks columns: {', '.join(missing)}")
    if "isSignificant" not in df.columns:
        source = next((c for c in ("sig_both", "sig_hyp") if c in df.columns), None)
        df = df.withColumn("isSignificant", F.col(source) if source else F.lit(False))
    for name, value in {"CAAP_Group": "US", "AminoEncoded": "", "ConservedPair": "", "IsConserved": False, "sig_hyp": None, "sig_perm": None, "sig_both": None}.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value) if value is not None else F.lit(None).cast("boolean"))
    if gene:
        df = df.where(F.col("Gene") == gene) if "Gene" in df.columns else df.where(F.col("GenePos").startswith(gene + "_"))
    return df


def read_caas_metadata(spark: SparkSession, path: str, gene: str | None = None) -> DataFrame:
    """Comma separated, tab separated when that yields a single column."""
    df = spark.read.csv(path, header=True, sep=",")
    if len(df.columns) == 1:
        df = spark.read.csv(path, header=True, sep="\t")
    return caas_metadata(df, gene)


def genomic_info(df: DataFrame) -> DataFrame:
    """Gene annotation with case-insensitive headers and typed columns."""
    lower = df.toDF(*[c.strip().lower() for c in df.columns])
    return lower.select(
        F.trim("gene").alias("Gene"), F.trim("chr").alias("chr"), F.col("start").try_cast("long").alias("start_bp"),
        F.col("end").try_cast("long").alias("end_bp"), F.col("length").try_cast("long").alias("Length"))


def gene_list(lines: DataFrame) -> DataFrame:
    """Distinct first fields; blank and ``#`` lines are ignored."""
    first = F.trim(F.split_part("line", F.lit("\t"), F.lit(1)))
    return lines.where(~F.trim("line").startswith("#")).select(first.alias("gene")).where("gene <> ''").distinct()


def background(lines: DataFrame) -> DataFrame:
    """Background genes with or without a header line."""
    return gene_list(lines).where(~F.lower("gene").isin("gene", "genes"))


def gmt(lines: DataFrame) -> DataFrame:
    """``set_name, gene`` from tab separated set lines."""
    p = F.split("line", "\t")
    return lines.where(F.size(p) >= 3).select(F.get(p, F.lit(0)).alias("set_name"), F.explode(F.slice(p, F.lit(3), F.size(p))).alias("gene")).where(
        "gene <> ''").distinct()


def fade_json(texts: DataFrame) -> DataFrame:
    """``gene, site, target_aa, bayes_factor`` from result documents ``gene, text``.

    The factor column is found by its header, else it is the fourth.
    """
    schema = "MLE struct<headers: array<array<string>>, content: map<string, map<string, array<array<double>>>>>"
    doc = texts.select("gene", F.from_json("text", schema).alias("j")).where("j.MLE.content IS NOT NULL")
    names = F.transform("j.MLE.headers", lambda h: F.lower(F.regexp_replace(F.get(h, F.lit(0)), r"\s", "")))
    at = F.array_position(F.transform(names, lambda n: F.contains(n, F.lit("bayesfactor"))), True).cast("int")
    doc = doc.withColumn("at", F.when(F.coalesce(at, F.lit(0)) > 0, at).otherwise(4))
    rows = doc.select("gene", "at", F.explode("j.MLE.content").alias("target_aa", "parts")).where(F.contains(F.lit(RESIDUES), F.col("target_aa")))
    rows = rows.select("gene", "at", "target_aa", F.explode("parts").alias("part", "reps"))
    return rows.select("gene", "at", "target_aa", F.posexplode("reps")).select(
        "gene", (F.col("pos") + 1).alias("site"), "target_aa", F.try_element_at("col", F.col("at")).alias("bayes_factor"))


def posterior_jsonl(lines: DataFrame, nodes: list[int] | None = None) -> DataFrame:
    """Long posteriors from one JSON object per node; other nodes are skipped before parsing."""
    if nodes is not None:
        lines = lines.where(F.regexp_extract("line", r'"node_id"\s*:\s*(\d+)', 1).try_cast("int").isin(nodes))
    obj = lines.select("gene", F.from_json("line", "node_id int, positions map<string, map<string, double>>").alias("o")).where(
        "o.node_id IS NOT NULL AND o.positions IS NOT NULL")
    sites = obj.select("gene", "o.node_id", F.explode("o.positions").alias("site", "m"))
    return sites.select("gene", "node_id", F.col("site").try_cast("int").alias("site"), F.explode("m").alias("aa", "p"))


def variant_table(df: DataFrame) -> DataFrame:
    """Variant rows with an integer position; malformed rows drop out."""
    need = [c for c in ("chr", "pos", "ref_aa", "alt_aa") if c not in df.columns]
    if need:
        raise ValueError(f"variant table lacks columns: {', '.join(need)}")
    return df.withColumn("pos", F.col("pos").try_cast("long")).where("pos IS NOT NULL")


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """Tab separated, optionally gzipped (a gzip file is one split; ship several files)."""
    return variant_table(spark.read.csv(path, sep="\t", header=True))


def coordinates(lines: DataFrame) -> DataFrame:
    """First parseable coordinate per query."""
    p = F.split("line", "\t")
    rows = lines.where(~F.col("line").startswith("input\t") & (F.size(p) >= 5)).select(
        "line_no", F.get(p, F.lit(0)).alias("query"), F.get(p, F.lit(1)).alias("transcript"), F.get(p, F.lit(4)).alias("coord"))
    chrom, start, end = codon_range(F.col("coord"))
    rows = rows.withColumns({"chr": chrom, "start_bp": start, "end_bp": end, "ref": protein_ref(F.col("coord"))}).where("chr IS NOT NULL")
    best = F.min_by(F.struct("transcript", "chr", "start_bp", "end_bp", "ref"), "line_no")
    return rows.groupBy("query").agg(best.alias("b")).select("query", "b.*")


def tracking_intervals(lines: DataFrame) -> DataFrame:
    """Positions listed as numbers and ``a-b`` ranges on ``selected:`` and ``removed:`` lines."""
    kind = F.when(F.contains(F.col("line"), F.lit("selected:")), "selected").when(F.contains(F.col("line"), F.lit("removed:")), "removed")
    tok = F.explode(F.split(F.trim(F.regexp_replace("line", r"^.*?(selected:|removed:)", "")), r"\s+"))
    rows = lines.select(kind.alias("kind"), tok.alias("tok")).where("kind IS NOT NULL").where(F.col("tok").rlike(r"^\d+(-\d+)?$"))
    lo = F.split_part("tok", F.lit("-"), F.lit(1)).cast("int")
    hi = F.coalesce(F.nullif(F.split_part("tok", F.lit("-"), F.lit(2)), F.lit("")).cast("int"), lo)
    return rows.select("kind", F.explode(F.sequence(lo, hi)).alias("position"))


def gff_cds(lines: DataFrame, protein: str) -> DataFrame:
    """Coding coordinates of a protein in reading order: ``cds_index, chrom, position``."""
    p = F.split("line", "\t")
    rows = lines.where(F.contains(F.col("line"), F.lit(protein)) & (F.get(p, F.lit(2)) == "CDS")).select(
        "line_no", F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(3)).cast("int").alias("a"), F.get(p, F.lit(4)).cast("int").alias("b"), F.get(p, F.lit(6)).alias("strand"))
    segs = rows.groupBy("chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("line_no", "a", "b"))).alias("s"))
    forward = F.flatten(F.transform("s", lambda x: F.sequence(x["a"], x["b"])))
    back = F.flatten(F.transform(F.reverse("s"), lambda x: F.sequence(x["b"], x["a"], F.lit(-1))))
    order = F.when(F.col("strand") == "-", back).otherwise(forward)
    return segs.select("chrom", F.posexplode(order)).select(F.col("pos").alias("cds_index"), "chrom", F.col("col").alias("position"))


def tax_ids(df: DataFrame) -> DataFrame:
    return df.select(F.trim("tax_id").alias("tax_id"), F.trim("species").alias("species")).where("tax_id <> '' AND species <> ''").distinct()


def wide_traits(df: DataFrame, taxon: str, trait: str, n_col: str | None = None, c_col: str | None = None) -> DataFrame:
    """Trimmed trait table; ``species`` and the named columns are mandatory."""
    missing = [c for c in ("species", taxon, trait, n_col, c_col) if c and c not in df.columns]
    if missing:
        raise ValueError(f"trait table lacks columns: {', '.join(missing)}")
    out = [F.trim("species").alias("species"), F.trim(F.col(taxon).cast("string")).alias("taxon"), F.col(trait).try_cast("double").alias("value")]
    if n_col:
        out.append(F.col(n_col).try_cast("long").alias("n_population"))
    if c_col:
        out.append(F.col(c_col).try_cast("long").alias("n_cases"))
    return df.select(*out)


def read_wide_traits(spark: SparkSession, path: str, **cols) -> DataFrame:
    return wide_traits(spark.read.csv(path, header=True, sep="\t" if path.endswith((".tsv", ".tab", ".txt")) else ","), **cols)
