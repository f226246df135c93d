"""Selection-test inputs and summaries: directional Bayes factors, relative rates, alignment filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fade_genes(fade: DataFrame, threshold: float = 100.0) -> DataFrame:
    """Sites tested, significant rows, best factor and the best significant residue and site."""
    ok = fade.where("bayes_factor IS NOT NULL")
    sig = F.col("bayes_factor") >= threshold
    # The first of equal maxima in (site, residue) order wins.
    key = F.when(sig, F.struct(F.col("bayes_factor"), (-F.col("site")).alias("s"), (-F.ascii("target_aa")).alias("a")))
    return ok.groupBy("gene").agg(
        F.countDistinct("site").alias("n_sites_tested"), F.count_if(sig).alias("n_sig_site_aa"), F.max("bayes_factor").alias("max_bf"),
        F.max_by("target_aa", key).alias("top_target_aa"), F.max_by("site", key).alias("top_site"))


def fade_sites(fade: DataFrame, threshold: float = 100.0) -> DataFrame:
    ok = fade.where("bayes_factor IS NOT NULL")
    key = F.struct(F.col("bayes_factor"), (-F.ascii("target_aa")).alias("a"))
    return ok.groupBy("gene", "site").agg(F.max("bayes_factor").alias("max_site_bf"), F.max_by("target_aa", key).alias("top_target_aa")).withColumn(
        "fade_biased", F.col("max_site_bf") >= threshold)


def rate_flags(rer: DataFrame, p_cut: float = 0.05, rho_cut: float = 0.0, permuted: bool = True) -> DataFrame:
    """Significance and direction flags; permutation p-values lead when present."""
    adj = F.coalesce(F.col("p_adj") < p_cut, F.lit(False))
    perm = F.coalesce(F.col("p_perm") < p_cut, F.lit(False)) if permuted else F.lit(False)
    lead = perm if permuted else adj
    return rer.withColumns({
        "signif": adj, "signif_perm": perm, "signif_any": lead,
        "pos_corr": lead & (F.col("Rho") > rho_cut), "neg_corr": lead & (F.col("Rho") < -rho_cut)})


def relative_rates(lengths: DataFrame) -> DataFrame:
    """Residual of each gene's branch length after a linear fit on the branch average.

    ``lengths`` is ``gene, branch, length``.  Averages and fit coefficients are
    aggregates; the rows are touched twice and never collected per gene.
    """
    avg = lengths.groupBy("branch").agg(F.avg("length").alias("x"))
    j = lengths.join(avg, "branch")
    fit = j.groupBy("gene").agg(F.regr_slope("length", "x").alias("b"), F.regr_intercept("length", "x").alias("a"))
    return j.join(fit, "gene").select("gene", "branch", (F.col("length") - F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0)) * F.col("x")).alias("rer"))


def rate_correlation(rates: DataFrame, trait: DataFrame, min_species: int = 10) -> DataFrame:
    """Correlation of rates with a branch trait per gene, for genes with enough branches.

    A 0/1 trait gives the binary test, any other trait the continuous one.
    """
    j = rates.join(trait, "branch")
    return j.groupBy("gene").agg(F.corr("rer", "value").alias("Rho"), F.count(F.lit(1)).alias("N")).where(F.col("N") >= min_species)


def permutation_p(observed: DataFrame, null: DataFrame) -> DataFrame:
    """(count of |null| >= |observed| + 1) / (n + 1) per gene; ``null`` is ``gene, rho`` per permutation."""
    j = null.join(observed.select("gene", "Rho"), "gene")
    return j.groupBy("gene").agg(((F.count_if(F.abs("rho_null") >= F.abs("Rho")) + 1) / (F.count(F.lit(1)) + 1)).alias("p_perm"))


def drop_gap_only(sequences: DataFrame) -> DataFrame:
    """Cleaned sequences without those made of gaps and unknowns only."""
    clean = F.regexp_replace("seq", "[ \\t]", "")
    return sequences.withColumn("seq", clean).where(F.length(F.regexp_replace("seq", "[-?Xx]", "")) > 0)


def keep_taxa(sequences: DataFrame, taxa: DataFrame) -> DataFrame:
    return sequences.join(taxa.select("species").distinct(), "species", "left_semi")


def keep_genes(trees: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the listed genes, and listed genes without a row."""
    wanted = genes.select("gene").distinct()
    return trees.join(wanted, "gene", "left_semi"), wanted.join(trees.select("gene").distinct(), "gene", "left_anti")


def fasta_lines(sequences: DataFrame) -> DataFrame:
    """One FASTA record per row."""
    return sequences.select("gene", F.concat(F.lit(">"), "species", F.lit("\n"), "seq").alias("record"))


def mark_foreground(newick: Column, species: list[str], label: str = "Foreground") -> Column:
    """Append ``{label}`` to foreground names in Newick text, longest names first, quoted names too."""
    out = newick
    for name in sorted(set(species), key=len, reverse=True):
        lit = re.escape(name)
        out = F.regexp_replace(out, f"(?<![a-zA-Z0-9_])('?){lit}\\1(?!\\{{)(?=[,):;\\[\\s]|$)", f"$1{name}$1{{{label}}}")
    return out
