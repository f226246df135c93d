"""Command line: one sub-command per tool, files in, table folders out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sitewise.operators import clusters, coordinates, disambiguation, gene_filter, permutation, resampling, scan, selection, significance
from sitewise.operators.columns import SpeciesIndex, column_filter, columns_from_sequences
from sitewise.sinks import tables as K
from sitewise.sinks.store import ResultStore, master_table, write_master
from sitewise.sources import alignments as A
from sitewise.sources import tables as R
from sitewise.sources.trees import edge_frame


def _caps(a: argparse.Namespace) -> scan.Limits:
    def cap(v):
        return None if v in (None, "NO") else int(v)

    return scan.Limits(cap(a.max_fg_gaps), cap(a.max_bg_gaps), cap(a.max_gaps_all), cap(a.max_fg_miss), cap(a.max_bg_miss), cap(a.max_miss_all),
                       a.miss_pair, overall_counts_as_equal=not a.caap)


def _columns(spark: SparkSession, a: argparse.Namespace):
    config = R.trait_config(R.read_lines(spark, a.traitfile), F.lit(a.trait))
    seqs = A.read_alignments(spark, a.alignments, a.format)
    index = SpeciesIndex.of(seqs.select("species").union(config.select("species")))
    return column_filter(columns_from_sequences(seqs, index), a.min_changes, a.max_gap_ratio), config, index, seqs


def discovery(spark: SparkSession, a: argparse.Namespace) -> None:
    cols, config, index, seqs = _columns(spark, a)
    tested = scan.tested_columns(cols, scan.load_contrasts(config), index, _caps(a))
    hits = scan.discover(tested, "CAAP" if a.caap else "CAAS", a.max_conserved, tuple(a.patterns.split(",")))
    K.write_if_any(hits, f"{a.output}/discovery")
    K.write_tsv(K.render_background(scan.background(tested, seqs)), f"{a.output}/background", header=False)


def resample(spark: SparkSession, a: argparse.Namespace) -> None:
    config = R.trait_config(R.read_lines(spark, a.traitfile), F.lit(a.trait))
    cycles = resampling.cycles(spark, a.cycles)
    if a.strategy == "tree":
        values = spark.read.csv(a.values, sep="\t", schema="species string, value double")
        text = "".join(r["line"] for r in R.read_lines(spark, a.tree).orderBy("line_no").collect())
        out = resampling.permulated_labels(cycles, edge_frame(spark, text), values, config, a.seed)
    elif a.strategy == "family":
        fam = spark.read.csv(a.families, sep="\t", schema="species string, family string")
        out = resampling.family_labels(cycles, config, fam, a.seed)
    else:
        species = spark.read.csv(a.values, sep="\t", schema="species string, value double")
        n_fg, n_bg = (config.where(F.col("grp") == g).count() for g in (1, 0))
        out = resampling.random_labels(cycles, species, n_fg, n_bg, a.seed)
    K.write_resamples(resampling.with_observed(out, config) if a.include_b0 else out, f"{a.output}/resamples", a.chunk)


def bootstrap(spark: SparkSession, a: argparse.Namespace) -> None:
    cols, _, index, _ = _columns(spark, a)
    sets = R.resamples(spark.read.text(a.resamples).withColumnRenamed("value", "line"))
    found = spark.read.csv(a.discovery, sep="\t", header=True).withColumn("Position", F.col("Position").cast("int")) if a.discovery else None
    K.write_tsv(K.bootstrap_lines(scan.bootstrap(cols, found, sets, index, _caps(a), a.max_conserved)), f"{a.output}/bootstrap", header=False)


def signify(spark: SparkSession, a: argparse.Namespace) -> None:
    found = spark.read.csv(a.discovery, sep="\t", header=True).withColumn("Position", F.col("Position").cast("int")).withColumn("Pvalue", F.col("Pvalue").cast("double"))
    flagged = significance.flag(significance.attach_bootstrap(found, R.read_bootstrap(spark, a.bootstrap)), a.alpha)
    K.write_tsv(significance.meta_table(flagged), f"{a.output}/meta")
    K.write_tsv(significance.summarise(flagged, "CAAP_Group"), f"{a.output}/summary")


def postproc(spark: SparkSession, a: argparse.Namespace) -> None:
    sites = spark.read.csv(a.sites, sep="\t", header=True).withColumn("Position", F.col("Position").cast("int"))
    sites = sites if "Trait" in sites.columns else sites.withColumn("Trait", F.lit("post_disambiguation"))
    flags = clusters.clustered_positions(sites, [(a.minlen, a.maxcaas)]).drop("minlen", "maxcaas")
    stats = gene_filter.gene_density(sites, R.genomic_info(spark.read.csv(a.genes, sep="\t", header=True)))
    removed = gene_filter.merge_categories(gene_filter.extreme_genes(stats, a.percentile), gene_filter.dubious_genes(stats, flags, a.iqr))
    K.write_tsv(flags, f"{a.output}/cluster_flags")
    K.write_tsv(removed, f"{a.output}/removed_genes")
    bad = flags.where("ClusteringFlag = 'Discarded'").drop("ClusteringFlag")
    K.write_tsv(gene_filter.drop_removed(sites.join(bad, ["Gene", "CAAP_Group", "Position"], "left_anti"), removed), f"{a.output}/filtered")


def disambiguate(spark: SparkSession, a: argparse.Namespace) -> None:
    """Labels of every site and its master table, the sites of rewritten genes replaced in the store."""
    pairs = spark.read.csv(a.pairs, sep="\t", header=True, schema=a.pair_schema)
    labels = disambiguation.classify(pairs, a.mode)
    store = ResultStore(spark, f"{a.output}/store")
    store.put(labels)
    sites = store.read().withColumnRenamed("site", "msa_pos")
    rows = pairs.select("gene", F.col("site").alias("msa_pos"), "pair_id", F.lit(None).cast("int").alias("node"), F.col("focal_state").alias("state"), "posterior")
    write_master(master_table(sites, rows), f"{a.output}/master")


def rates(spark: SparkSession, a: argparse.Namespace) -> None:
    """Relative rates, their correlation with a trait and its permutation p-value."""
    lengths = spark.read.csv(a.lengths, sep="\t", header=True, schema="gene string, branch string, length double")
    trait = spark.read.csv(a.trait_values, sep="\t", header=True, schema="branch string, value double")
    perms = spark.read.csv(a.permutations, sep="\t", header=True, schema="perm string, branch string, value double")
    residuals = permutation.winsorised(selection.relative_rates(lengths), a.winsorise)
    K.write_tsv(permutation.permutation_test(residuals, trait, perms, a.kind, a.min_branches, a.min_positive), f"{a.output}/rates")


def places(spark: SparkSession, a: argparse.Namespace) -> None:
    """Genomic places of protein residues."""
    residues = spark.read.csv(a.residues, sep="\t", header=True, schema="protein string, residue long")
    exons = coordinates.exon_offsets(coordinates.coding_exons(R.read_lines(spark, a.gff)))
    out = coordinates.codon_places(residues, exons)
    K.write_tsv(out.withColumn("coord", coordinates.place_text("chrom", "start", "end")), f"{a.output}/places")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sitewise")
    sub = p.add_subparsers(dest="tool", required=True)

    def tool(name, fn, *args):
        q = sub.add_parser(name)
        q.set_defaults(fn=fn)
        q.add_argument("--output", required=True)
        for flag, kw in args:
            q.add_argument(flag, **kw)

    req = {"required": True}
    caps = [(f"--{n}", {"default": "NO"}) for n in ("max-fg-gaps", "max-bg-gaps", "max-gaps-all", "max-fg-miss", "max-bg-miss", "max-miss-all")]
    yes = {"action": "store_true"}
    scan_args = [
        ("--alignments", req), ("--traitfile", req), ("--trait", {"default": "trait"}), ("--format", {"default": "auto"}),
        ("--min-changes", {"type": int, "default": 1}), ("--max-gap-ratio", {"type": float, "default": 0.5}), *caps, ("--miss-pair", yes),
        ("--max-conserved", {"type": int, "default": 0}), ("--caap", yes), ("--patterns", {"default": "1,2,3"})]
    tool("discovery", discovery, *scan_args)
    tool("bootstrap", bootstrap, *scan_args, ("--resamples", req), ("--discovery", {"default": None}))
    tool("resample", resample, ("--traitfile", req), ("--trait", {"default": "trait"}), ("--strategy", {"choices": ["random", "family", "tree"], "default": "random"}),
         ("--values", {}), ("--tree", {}), ("--families", {}), ("--cycles", {"type": int, "default": 1000}), ("--chunk", {"type": int, "default": 500}),
         ("--seed", {"type": int, "default": 1}), ("--include-b0", yes))
    tool("signify", signify, ("--discovery", req), ("--bootstrap", req), ("--alpha", {"type": float, "default": 0.05}))
    tool("postproc", postproc, ("--sites", req), ("--genes", req), ("--minlen", {"type": int, "default": 3}), ("--maxcaas", {"type": float, "default": 0.7}),
         ("--percentile", {"type": float, "default": 0.99}), ("--iqr", {"type": float, "default": 3.0}))
    tool("disambiguate", disambiguate, ("--pairs", req), ("--mode", {"choices": ["focal_clade", "mrca"], "default": "focal_clade"}),
         ("--pair-schema", {"default": "gene string, site int, pair_id int, focal_state string, mrca_state string, top_tip string, bottom_tip string, posterior double"}))
    tool("rates", rates, ("--lengths", req), ("--trait-values", req), ("--permutations", req), ("--kind", {"choices": ["continuous", "binary"], "default": "continuous"}),
         ("--min-branches", {"type": int, "default": 10}), ("--min-positive", {"type": int, "default": 2}), ("--winsorise", {"type": int, "default": 0}))
    tool("places", places, ("--gff", req), ("--residues", req))
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.fn(SparkSession.builder.appName(f"sitewise-{args.tool}").getOrCreate(), args)
