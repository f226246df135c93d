"""Gene outlier filter: site density and count per gene against per-scheme thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.operators.ordering import quantiles
from sitewise.session import checkpoint, dealt

KEYS = ["Trait", "CAAP_Group"]


#: Parts into which a background is cut where it meets the schemes.
SALTS = 64


def gene_density(sites: DataFrame, genes: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Distinct sites per gene and their density per 100 positions.

    Sites are dealt by gene into counted tasks and collapse there to one row per key and
    gene before they meet the gene lengths.  Rows with a NULL key or length drop out.
    Thresholds and every later step read the result again, so it is written once.
    """
    every = keys + ["Gene", "Position"]
    clean = sites.select(*every).na.drop(subset=every)
    counts = dealt(clean, "Gene").distinct().groupBy(*keys, "Gene").agg(F.count(F.lit(1)).alias("n_CAAS"))
    lengths = genes.select("Gene", "Length").where(F.col("Length").isNotNull())
    return checkpoint(counts.join(lengths, "Gene").select(
        *keys, "Gene", "Length", "n_CAAS", (F.col("n_CAAS") / F.col("Length") * 100).alias("n_CAAS_per_length")
    ))


def density_thresholds(stats: DataFrame, percentile: float = 0.99, keys: list[str] = KEYS) -> DataFrame:
    return quantiles(stats, keys, "n_CAAS_per_length", {"threshold": percentile})


def iqr_thresholds(stats: DataFrame, multiplier: float = 3.0, keys: list[str] = KEYS) -> DataFrame:
    q = quantiles(stats, keys, "n_CAAS", {"q1": 0.25, "q3": 0.75})
    return q.select(*keys, (F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))).alias("iqr_threshold"))


def _with_thresholds(stats: DataFrame, thresholds: DataFrame, keys: list[str]) -> DataFrame:
    # One row per trait and scheme; dealt by them, a scheme's genes would meet in one task.
    return stats.join(F.broadcast(thresholds), keys)


def extreme_genes(stats: DataFrame, percentile: float = 0.99, keys: list[str] = KEYS) -> DataFrame:
    """Genes strictly above the density quantile of their key."""
    out = _with_thresholds(stats, density_thresholds(stats, percentile, keys), keys)
    return out.where("n_CAAS_per_length > threshold").drop("threshold").withColumn("Category", F.lit("Extreme"))


def iqr_outliers(stats: DataFrame, multiplier: float = 3.0, keys: list[str] = KEYS) -> DataFrame:
    out = _with_thresholds(stats, iqr_thresholds(stats, multiplier, keys), keys)
    return out.where("n_CAAS > iqr_threshold").drop("iqr_threshold")


def _hit(stats: DataFrame, cluster_flags: DataFrame, on: list[str]) -> DataFrame:
    """Genes (of a scheme) with a clustered site, in as many tasks as ``stats`` (written) needs, which follow in a join."""
    return dealt(cluster_flags.where("ClusteringFlag = 'Discarded'").select(*on), *on, rows=stats.count()).distinct()


def dubious_genes(stats: DataFrame, cluster_flags: DataFrame, multiplier: float = 3.0, keys: list[str] = KEYS) -> DataFrame:
    """Count outliers that also hold a clustered site (same scheme when flags carry one)."""
    on = ["Gene", "CAAP_Group"] if "CAAP_Group" in cluster_flags.columns and "CAAP_Group" in keys else ["Gene"]
    hit = _hit(stats, cluster_flags, on)
    return iqr_outliers(stats, multiplier, keys).join(hit, on, "left_semi").select(
        *stats.columns, F.lit("Dubious").alias("Category")
    )


def merge_categories(extreme: DataFrame, dubious: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per gene and key; flagged by both criteria becomes ``Both``."""
    both = extreme.unionByName(dubious)
    value_cols = [c for c in extreme.columns if c not in keys + ["Gene", "Category"]]
    return checkpoint(both.groupBy(*keys, "Gene").agg(
        *[F.min(c).alias(c) for c in value_cols],
        F.when(F.count(F.lit(1)) > 1, F.lit("Both")).otherwise(F.min("Category")).alias("Category"),
    ).select(*extreme.columns))


def full_gene_stats(stats: DataFrame, removed: DataFrame, percentile: float = 0.99, multiplier: float = 3.0,
                    keys: list[str] = KEYS) -> DataFrame:
    """Every gene with both thresholds and its category, ``Normal`` unless removed."""
    cat = dealt(removed.select(*keys, "Gene", F.col("Category").alias("_removed")), *keys, "Gene", rows=stats.count()).distinct()
    th_e = density_thresholds(stats, percentile, keys).withColumnRenamed("threshold", "threshold_extreme")
    th_d = iqr_thresholds(stats, multiplier, keys).withColumnRenamed("iqr_threshold", "threshold_dubious")
    out = _with_thresholds(_with_thresholds(stats, th_e, keys), th_d, keys)
    return out.join(cat, keys + ["Gene"], "left").withColumn(
        "Category", F.coalesce("_removed", F.lit("Normal"))
    ).drop("_removed")


def categorised(stats: DataFrame, cluster_flags: DataFrame, percentile: float = 0.99, multiplier: float = 3.0, keys: list[str] = KEYS) -> DataFrame:
    """``full_gene_stats`` and the removed genes in one: every gene with both thresholds and ``Extreme``, ``Dubious``, ``Both`` or ``Normal``.

    Each threshold is found once for each key and both meet the genes in one join.
    """
    th = density_thresholds(stats, percentile, keys).withColumnRenamed("threshold", "threshold_extreme").join(
        iqr_thresholds(stats, multiplier, keys).withColumnRenamed("iqr_threshold", "threshold_dubious"), keys)
    on = ["Gene", "CAAP_Group"] if "CAAP_Group" in cluster_flags.columns and "CAAP_Group" in keys else ["Gene"]
    hit = _hit(stats, cluster_flags, on).withColumn("_hit", F.lit(True))
    out = _with_thresholds(stats, th, keys).join(hit, on, "left")
    extreme, dubious = F.col("n_CAAS_per_length") > F.col("threshold_extreme"), (F.col("n_CAAS") > F.col("threshold_dubious")) & F.coalesce("_hit", F.lit(False))
    category = F.when(extreme & dubious, "Both").when(extreme, "Extreme").when(dubious, "Dubious").otherwise("Normal")
    return out.select(*stats.columns, "threshold_extreme", "threshold_dubious", category.alias("Category"))


def drop_removed(sites: DataFrame, removed: DataFrame) -> DataFrame:
    """Sites whose (gene, scheme) was not removed; by gene alone without a scheme."""
    on = ["Gene", "CAAP_Group"] if "CAAP_Group" in removed.columns else ["Gene"]
    return sites.join(removed.select(*on).distinct(), on, "left_anti")


def filter_combo(stats: DataFrame, clustered: DataFrame) -> DataFrame:
    """Extreme / Dubious / Cluster flags per gene and their composite label."""
    stats = checkpoint(stats)  # counted
    hit = dealt(clustered.select("Gene", "CAAP_Group"), "Gene", "CAAP_Group", rows=stats.count()).distinct().withColumn("Cluster_removed", F.lit(True))
    out = stats.join(hit, ["Gene", "CAAP_Group"], "left").withColumn(
        "Cluster_removed", F.coalesce("Cluster_removed", F.lit(False))
    )
    out = out.withColumn("Extreme", F.col("Category").isin("Extreme", "Both")).withColumn(
        "Dubious", F.col("Category").isin("Dubious", "Both")
    )
    label = F.concat_ws("+", F.when(F.col("Extreme"), "Extreme"), F.when(F.col("Dubious"), "Dubious"),
                        F.when(F.col("Cluster_removed"), "Cluster"))
    return out.withColumn("filter_combo", F.when(label == "", "None").otherwise(label))


def overlap_summary(flags: DataFrame) -> DataFrame:
    """Mean and sample deviation of five descriptors per scheme and label."""
    aggs = [F.count(F.lit(1)).alias("n_genes")]
    for col, name, digits in (
        ("Length", "Length", 1), ("n_CAAS", "n_CAAS", 2), ("n_CAAS_per_length", "density", 4),
        ("frac_sig_both", "frac_sig_both", 4), ("median_pval_hyp", "median_pval", 4),
    ):
        aggs += [F.round(F.avg(col), digits).alias(f"mean_{name}"), F.round(F.stddev_samp(col), digits).alias(f"sd_{name}")]
    return flags.groupBy("CAAP_Group", "filter_combo").agg(*aggs)


def cleaned_background(background: DataFrame, removed: DataFrame) -> DataFrame:
    """Background genes per scheme without that scheme's removed genes."""
    groups = removed.select("CAAP_Group").distinct()
    gone = removed.select("CAAP_Group", "Gene").where(F.col("Gene").isNotNull()).distinct()
    # Every gene meets every scheme: genes keep a salt, schemes are repeated for each salt.
    salted = background.select("Gene", F.pmod(F.xxhash64("Gene"), F.lit(SALTS)).cast("int").alias("_salt"))
    schemes = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    expanded = salted.join(schemes, "_salt").select("Gene", "CAAP_Group")
    gone = dealt(gone, "CAAP_Group", "Gene", rows=background.count() * groups.count())
    return expanded.join(gone, ["CAAP_Group", "Gene"], "left_anti")


def cleaned_background_main(background: DataFrame, removed: DataFrame) -> DataFrame:
    """Background minus the genes removed under every scheme."""
    n = removed.select("CAAP_Group").distinct().count()
    gone = removed.groupBy("Gene").agg(F.countDistinct("CAAP_Group").alias("k")).where(F.col("k") == n)
    return background.join(gone, "Gene", "left_anti").select("Gene")
