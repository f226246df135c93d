"""Post-processing of classified sites: schema, hard filters, removal events, focal tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.arrays import entries
from sitewise.functions.labels import as_bool, combo, normal_parallel, pattern_parallel

# Accepted alternative column names.
ALIASES = {
    "Pattern": "pattern_type", "Pvalue": "pvalue", "Pvalue.boot": "pvalue_boot", "ChangeSide": "change_side",
    "ChangeTop": "change_top", "ChangeBottom": "change_bottom", "ParallelTop": "parallel_top",
    "ParallelBottom": "parallel_bottom", "ParallelType": "parallel_type", "Gene": "gene",
    "Position": "position", "CAAP_Group": "caap_group", "ASR_ConsAntiCAAS": "asr_is_conserved",
}
# Defaults of absent columns.
DEFAULTS = {
    "caap_group": "US", "pattern_type": "unknown", "change_side": "none", "change_top": "no_change",
    "change_bottom": "no_change", "parallel_top": "none", "parallel_bottom": "none", "parallel_type": "none",
    "is_conserved_meta": "FALSE", "asr_is_conserved": "FALSE", "asr_root_conserved": "FALSE",
}
SCHEME_NAMES = ["US", "GS0", "GS1", "GS2", "GS3", "GS4"]


def normalise(df: DataFrame) -> DataFrame:
    """Alias renames, default columns and type coercion of the disambiguation table."""
    have = set(df.columns)
    df = df.withColumnsRenamed({a: b for a, b in ALIASES.items() if a in have and b not in have})
    for name, value in DEFAULTS.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    out = {
        "gene": F.col("gene").cast("string"),
        "position": F.col("position").try_cast("int"),
        "pvalue": F.col("pvalue").try_cast("double"),
        "pvalue_boot": F.col("pvalue_boot").try_cast("double"),
        **{c: F.lower(F.col(c)) for c in ("change_side", "change_top", "change_bottom")},
        **{c: normal_parallel(F.col(c)) for c in ("parallel_top", "parallel_bottom", "parallel_type")},
        **{c: as_bool(F.col(c)) for c in ("is_conserved_meta", "asr_is_conserved", "asr_root_conserved")},
    }
    df = df.withColumns(out)
    return df.withColumn("site_id", F.concat_ws("@", "gene", F.col("position").cast("string")))


def posterior_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if re.fullmatch(r"mrca_\d+_posterior", c)]


def low_posterior(df: DataFrame, threshold: float) -> Column:
    """True when any pair posterior is below the threshold; missing ones are skipped."""
    cols = [F.col(c) for c in posterior_columns(df)]
    if not cols:
        return F.lit(False)
    low = cols[0] if len(cols) == 1 else F.least(*cols)  # least skips NULLs
    return F.coalesce(low < threshold, F.lit(False))


def split_low_posterior(df: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Kept rows and removed rows (with their reason)."""
    low = low_posterior(df, threshold)
    reason = F.lit(f"mrca_posterior_below_{threshold:g}")
    return df.where(~low), df.where(low).withColumn("RemovalReason", reason)


def direction(df: DataFrame, side: str) -> DataFrame:
    """Rows of one direction; ``both`` counts for each side, ``all`` is anything but ``none``."""
    if side in ("top", "bottom"):
        return df.where(F.col("change_side").isin(side, "both"))
    return df.where(F.coalesce("change_side", F.lit("")) != "none")


def dubious_conserved(meta: Column, asr: Column) -> Column:
    return as_bool(meta) & ~as_bool(asr)


def orientation_rows(df: DataFrame) -> DataFrame:
    """Each row once per orientation it belongs to: global, top, bottom, both."""
    side = F.col("change_side")
    tags = F.filter(
        F.array(
            F.lit("global"),
            F.when(side.isin("top", "both"), F.lit("top")),
            F.when(side.isin("bottom", "both"), F.lit("bottom")),
            F.when(side == "both", F.lit("both")),
        ),
        lambda x: x.isNotNull(),
    )
    return df.withColumn("orientation", F.explode(tags))


def group_flags(df: DataFrame) -> DataFrame:
    """Which schemes report a site, per orientation."""
    return df.groupBy("orientation", "site_id", "gene", "position").agg(
        *[F.bool_or(F.upper("caap_group") == s).alias(s.lower()) for s in SCHEME_NAMES]
    )


def intersections(flags: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per combination of flags, labelled; rows without any flag are dropped."""
    some = F.lit(False)
    for c in cols:
        some = some | F.col(c)
    return flags.where(some).groupBy(combo({c: F.col(c) for c in cols}).alias("combo_label")).agg(F.count(F.lit(1)).alias("n"))


def scheme_scenarios(df: DataFrame, id_col: str) -> DataFrame:
    """Distinct ids and schemes in the three overlap scenarios: no GS0, no US, only both."""
    g = F.upper("caap_group")
    tags = F.filter(
        F.array(F.when(g != "GS0", F.lit("scenario1")), F.when(g != "US", F.lit("scenario2")),
                F.when(g.isin("GS0", "US"), F.lit("scenario3"))),
        lambda x: x.isNotNull(),
    )
    return (
        df.select(F.explode(tags).alias("scenario"), g.alias("caap_group"), id_col).distinct()
        .groupBy("scenario", "caap_group").agg(F.count(F.lit(1)).alias("n_ids"))
    )


def focal_table(df: DataFrame) -> DataFrame:
    """Distinct sites and genes per pattern label, overall and per scheme, in one grouping-sets pass."""
    lab = pattern_parallel(F.col("pattern_type"), F.col("parallel_type"))
    src = df.withColumn("pattern_parallel", lab)
    keys = ["pattern_type", "parallel_type", "pattern_parallel"]
    out = src.groupingSets([keys, ["caap_group"] + keys], "caap_group", *keys).agg(
        F.countDistinct("site_id").alias("Positions_total"),
        F.countDistinct("gene").alias("Genes_total"),
        F.grouping("caap_group").alias("_overall"),
    )
    return out.select(
        F.when(F.col("_overall") == 1, "overall").otherwise("per_group").alias("Scope"),
        F.when(F.col("_overall") == 1, "ALL").otherwise(F.col("caap_group")).alias("CAAP_Group"),
        F.col("pattern_type").alias("Pattern"), F.col("parallel_type").alias("Parallel"),
        F.col("pattern_parallel").alias("PatternParallel"), "Positions_total", "Genes_total",
    )


def cluster_events(sites: DataFrame, flags: DataFrame) -> DataFrame:
    """Removed by the cluster filter."""
    hits = flags.where("ClusteringFlag = 'Discarded'").select(
        F.col("Gene").alias("gene"), F.col("Position").alias("position"), F.col("CAAP_Group").alias("caap_group")
    ).distinct()
    return sites.join(hits, ["gene", "position", "caap_group"], "left_semi").distinct().withColumn("RemovalStage", F.lit("cluster"))


def gene_events(sites: DataFrame, removed: DataFrame) -> DataFrame:
    """Removed by the gene filter, with the stage named after the category."""
    rg = removed.select(
        F.col("Gene").alias("gene"), F.col("CAAP_Group").alias("caap_group"), F.lower("Category").alias("_cat")
    ).distinct()
    stage = (
        F.when(F.col("_cat") == "extreme", "extreme_gene").when(F.col("_cat") == "dubious", "dubious_with_clusters")
        .when(F.col("_cat") == "both", "extreme_and_dubious").otherwise("gene_filter")
    )
    return sites.join(rg, ["gene", "caap_group"]).withColumn("RemovalStage", stage).drop("_cat").distinct()


def removal_events(*events: DataFrame) -> DataFrame:
    out = events[0]
    for e in events[1:]:
        out = out.unionByName(e, allowMissingColumns=True)
    return out


def conserved_burden(kept: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows per conserved-status scenario and their share of all tracked rows."""
    k = kept.agg(
        F.count(F.lit(1)).alias("retained"),
        F.coalesce(F.sum(F.col("is_conserved_meta").cast("long")), F.lit(0)).alias("cons"),
    )
    r = removed.agg(F.count(F.lit(1)).alias("removed"))
    one = k.crossJoin(r)  # one row each
    total = F.col("retained") + F.col("removed")
    return one.select(F.inline(entries(
        ["scenario", "rows", "total"],
        ("all_positions", total, total),
        ("retained_positions", F.col("retained"), total),
        ("retained_conserved_meta", F.col("cons"), total),
        ("retained_meta_not_conserved", F.col("retained") - F.col("cons"), total),
        ("removed_low_mrca", F.col("removed"), total),
    ))).select("scenario", "rows", F.when(F.col("total") > 0, F.col("rows") / F.col("total")).alias("fraction_of_total"))


def pvalue_burden(sites: DataFrame, removed_ids: DataFrame) -> DataFrame:
    """Counts of p-values at three scopes, removed against retained sites."""
    gone = removed_ids.select("site_id").distinct().withColumn("_gone", F.lit(True))
    marked = sites.join(gone, "site_id", "left")
    status = F.when(F.col("_gone"), "removed").otherwise("retained")
    long = marked.select(status.alias("filter_status"), F.inline(entries(
        ["pval_type", "p"],
        ("Hypothesis p-value", F.col("pvalue")),
        ("Permutation p-value (boot)", F.col("pvalue_boot")),
    ))).where(F.col("p").isNotNull())
    sums = long.groupBy("pval_type", "filter_status").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("p") <= 0.10).alias("c10"), F.count_if(F.col("p") <= 0.05).alias("c05"),
    )
    return sums.select("pval_type", "filter_status", F.inline(entries(
        ["threshold_scope", "count", "proportion"],
        ("all", F.col("total"), F.col("total") / F.col("total")),
        ("<= 0.10", F.col("c10"), F.col("c10") / F.col("total")),
        ("<= 0.05", F.col("c05"), F.col("c05") / F.col("total")),
    )))


def label_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def exclusion_lists(flags: DataFrame, sites: DataFrame, preproc: DataFrame) -> DataFrame:
    """Six gene exclusion lists as ``list, Gene``.

    ``flags`` carries ``Gene, filter_combo, Cluster_removed, Extreme, Dubious``;
    one aggregation by gene replaces the chain of set operations.
    """
    per_gene = flags.groupBy("Gene").agg(
        F.bool_or("Cluster_removed").alias("cl"), F.bool_or(F.col("Extreme") | F.col("Dubious")).alias("gf"),
        F.bool_or(F.col("filter_combo") != "None").alias("any"), F.lit(True).alias("known"),
    )
    sig = sites.where("sig_both").select(F.col("gene").alias("Gene")).distinct().withColumn("sig", F.lit(True))
    pre = preproc.select("Gene").distinct().withColumn("pre", F.lit(True))
    g = per_gene.join(sig, "Gene", "left").join(pre, "Gene", "full").na.fill(False)
    post = F.col("cl") | F.col("gf")
    nonsig = F.col("known") & ~F.col("any") & ~F.col("sig") & ~F.col("pre")
    lists = F.filter(F.array(
        F.when(F.col("pre"), F.lit("excluded_preproc")),
        F.when(F.col("cl"), F.lit("excluded_postproc_clusters")),
        F.when(F.col("gf"), F.lit("excluded_postproc_genefilter")),
        F.when(post, F.lit("excluded_postproc")),
        F.when(nonsig, F.lit("excluded_nonsig")),
        F.when(F.col("pre") | post | nonsig, F.lit("excluded_overall")),
    ), lambda x: x.isNotNull())
    return g.select(F.explode(lists).alias("list"), "Gene")


def gene_site_density(sites: DataFrame, genes: DataFrame) -> DataFrame:
    """Distinct sites per gene over its genomic length (Manhattan table)."""
    per_gene = sites.groupBy("gene").agg(
        F.countDistinct("site_id").alias("n_caas_positions"), F.avg(F.col("sig_both").cast("double")).alias("frac_sig_both")
    )
    loc = genes.select(F.col("Gene").alias("gene"), "chr", (F.col("end_bp") - F.col("start_bp") + 1).alias("gene_length"))
    out = per_gene.join(loc, "gene").where("chr IS NOT NULL AND gene_length > 0")
    dens = F.col("n_caas_positions") / F.col("gene_length")
    return out.withColumn("caas_density", dens).withColumn("log_caas_density", F.log10(F.greatest(dens, F.lit(1e-10))))
