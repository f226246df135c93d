"""Permutation p-values joined to discovery, significance flags and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewise.functions.labels import significance_class, significance_level


def attach_bootstrap(discovery: DataFrame, boot: DataFrame, by_group: bool = True) -> DataFrame:
    """Left join the empirical p; without schemes on the right one row per site is used.

    A site without a permutation p keeps its closed-form p, with zero counts.
    """
    keys = ["Gene", "Position", "CAAP_Group"] if by_group else ["Gene", "Position"]
    right = boot.select(*keys, F.col("Pvalue_boot").alias("_pb"), "Occurrences", "Total")
    if not by_group:
        right = right.groupBy(*keys).agg(F.min(F.struct("_pb", "Occurrences", "Total")).alias("r")).select(*keys, "r.*")
    joined = discovery.join(right, keys, "left")
    return joined.select(
        *discovery.columns,
        F.coalesce("_pb", "Pvalue").alias("Pvalue_boot"),
        F.coalesce("Occurrences", F.lit(0)).alias("Occurrences"),
        F.coalesce("Total", F.lit(0)).alias("Total"),
    )


def flag(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``sig_hyp``, ``sig_perm``, ``sig_both`` and ``isSignificant`` at one level; NULL is not significant."""
    hyp = F.coalesce(F.col("Pvalue") <= alpha, F.lit(False))
    perm = F.coalesce(F.col("Pvalue_boot") <= alpha, F.lit(False))
    return (
        df.withColumn("sig_hyp", hyp).withColumn("sig_perm", perm)
        .withColumn("sig_both", F.col("sig_hyp") & F.col("sig_perm"))
        .withColumn("isSignificant", F.col("sig_hyp") | F.col("sig_perm"))
    )


def flag_levels(df: DataFrame, alpha: float = 0.10) -> DataFrame:
    """Flags and class at the configured level and at the two comparison levels."""
    for suffix, level in (("", alpha), ("_010", 0.10), ("_005", 0.05)):
        hyp = F.coalesce(F.col("Pvalue") <= level, F.lit(False))
        perm = F.coalesce(F.col("pvalue_boot") <= level, F.lit(False))
        df = (
            df.withColumn("sig_hyp" + suffix, hyp).withColumn("sig_perm" + suffix, perm)
            .withColumn("sig_both" + suffix, hyp & perm)
            .withColumn("significance_class" + suffix, significance_class(hyp, perm))
        )
    return df


def summarise(df: DataFrame, *keys: str) -> DataFrame:
    """Row count and significant rows per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).cast("long")).alias(c.replace("sig_", "n_")) for c in ("sig_hyp", "sig_perm", "sig_both")],
    )


def summarise_patterns(df: DataFrame) -> DataFrame:
    """Per (scheme, pattern) and per pattern in one pass; the overall rows carry scheme ``ALL``.

    ``groupingSets`` expands before a partial aggregation, so the shuffle only
    carries one row per key and task.
    """
    out = df.groupingSets([["CAAP_Group", "Pattern"], ["Pattern"]], "CAAP_Group", "Pattern").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("sig_hyp").cast("long")).alias("n_hyp"),
        F.sum(F.col("sig_perm").cast("long")).alias("n_perm"),
        F.sum(F.col("sig_both").cast("long")).alias("n_both"),
    )
    return out.withColumn("CAAP_Group", F.coalesce("CAAP_Group", F.lit("ALL")))


def meta_table(df: DataFrame) -> DataFrame:
    """The significance export: tag, site token, levels and conserved pair fields."""
    for name in ("ConservedPair", "ConservedPairs"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    pairs = F.col("ConservedPairs")
    return df.select(
        F.concat(F.lit("CAAS_"), F.hex(F.xxhash64("CAAP_Group", "Gene", "Position"))).alias("Tag"),
        F.concat_ws("_", "Gene", F.col("Position").cast("string")).alias("GenePos"),
        "Gene", "Position", "Pattern", "CAAP_Group", "Pvalue", "Pvalue_boot", "Occurrences", "Total",
        "sig_hyp", "sig_perm", "sig_both",
        significance_level(F.col("sig_hyp"), F.col("sig_perm")).alias("SignificanceLevel"),
        F.coalesce(F.upper(F.trim(F.col("ConservedPair").cast("string"))) == "TRUE", F.lit(False)).alias("IsConserved"),
        F.when(pairs.isNotNull() & (pairs != ""), F.regexp_replace(pairs, r"^\d+:", "")).alias("ConservedPair"),
        F.col("Substitution").alias("AminoConv") if "Substitution" in df.columns else F.lit(None).cast("string").alias("AminoConv"),
        F.col("Encoded").alias("AminoEncoded") if "Encoded" in df.columns else F.lit(None).cast("string").alias("AminoEncoded"),
    )


def gene_statistics(df: DataFrame) -> DataFrame:
    """Share of doubly significant rows, median and minimum p per gene and scheme.

    A gene and scheme holds at most one row per alignment column.
    """
    return df.groupBy("Gene", "CAAP_Group").agg(
        F.avg(F.col("sig_both").cast("double")).alias("frac_sig_both"),
        F.percentile("Pvalue", F.lit(0.5)).alias("median_pval_hyp"),
        F.min("Pvalue").alias("min_pval_hyp"),
        F.percentile("pvalue_boot", F.lit(0.5)).alias("median_pval_boot"),
        F.min("pvalue_boot").alias("min_pval_boot"),
    )


def within_percentage(df: DataFrame, keys: list[str], n: str = "n", out: str = "pct", digits: int = 1) -> DataFrame:
    """Percentage of ``n`` inside each key (input is an aggregate, one row per label)."""
    total = F.sum(n).over(Window.partitionBy(*keys))
    return df.withColumn(out, F.round(F.col(n) / total * 100, digits))
