"""Queries: significance, gene and cluster filters, post-processing, scalar labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.functions import labels as L
from sitewise.operators import clusters as C
from sitewise.operators import gene_filter as G
from sitewise.operators import postproc as P
from sitewise.operators import significance as S
from sitewise.plans.registry import query
from sitewise.session import checkpoint, dealt

GROUPS = ["US", "GS0", "GS1", "GS2", "GS3", "GS4"]


def r(*cols, digits=6):
    return [F.round(c, digits).alias(c) for c in cols]


# ------------------------------------------------------------------ significance
BOOT = """boot AS (
      SELECT Gene, Position, CAAP_Group, CAST(round(pvalue_boot * 100, 0) AS BIGINT) AS Occurrences, CAST(100 AS BIGINT) AS Total,
             pvalue_boot AS Pvalue_boot FROM {sites} WHERE pvalue_boot IS NOT NULL)"""
SIG = f"""
    WITH {BOOT}, joined AS (
      SELECT s.Gene, s.Position, s.CAAP_Group, s.Pattern, s.Pvalue, coalesce(b.Pvalue_boot, s.Pvalue) AS Pvalue_boot,
             coalesce(b.Occurrences, 0) AS Occurrences, coalesce(b.Total, 0) AS Total
      FROM {{sites}} s LEFT JOIN boot b ON b.Gene = s.Gene AND b.Position = s.Position AND b.CAAP_Group = s.CAAP_Group),
    sig AS (
      SELECT *, Pvalue <= 5e-2 AS sig_hyp, Pvalue_boot <= 5e-2 AS sig_perm,
             Pvalue <= 5e-2 AND Pvalue_boot <= 5e-2 AS sig_both,
             Pvalue <= 5e-2 OR Pvalue_boot <= 5e-2 AS isSignificant FROM joined)"""


def boot_table(t):
    return t.sites.where("pvalue_boot IS NOT NULL").select(
        "Gene", "Position", "CAAP_Group", F.round(F.col("pvalue_boot") * 100, 0).cast("long").alias("Occurrences"),
        F.lit(100).cast("long").alias("Total"), F.col("pvalue_boot").alias("Pvalue_boot"),
    )


def joined(t):
    base = t.sites.select("Gene", "Position", "CAAP_Group", "Pattern", "Pvalue")
    return S.attach_bootstrap(base, boot_table(t))


def sig(t):
    return S.flag(joined(t))


@query("jn01", SIG + "SELECT * FROM joined")
def jn01(t):
    """Discovery with empirical p by gene, position and scheme."""
    return joined(t)


@query("jn01b", f"""
    WITH {BOOT}, one AS (SELECT Gene, Position, min(Pvalue_boot) AS pb FROM boot GROUP BY Gene, Position)
    SELECT s.Gene, s.Position, s.CAAP_Group, coalesce(o.pb, s.Pvalue) AS Pvalue_boot
    FROM {{sites}} s LEFT JOIN one o ON o.Gene = s.Gene AND o.Position = s.Position""")
def jn01b(t):
    """Fallback join without schemes on the bootstrap side."""
    base = t.sites.select("Gene", "Position", "CAAP_Group", "Pvalue")
    return S.attach_bootstrap(base, boot_table(t), by_group=False).select("Gene", "Position", "CAAP_Group", "Pvalue_boot")


@query("flt08", """
    WITH f AS (SELECT *, coalesce(Pvalue <= 1e-1, false) AS h, coalesce(pvalue_boot <= 1e-1, false) AS p,
                      coalesce(Pvalue <= 5e-2, false) AS h5, coalesce(pvalue_boot <= 5e-2, false) AS p5 FROM {sites})
    SELECT CAAP_Group, Gene, Position, h AS sig_hyp, p AS sig_perm, h AND p AS sig_both,
           CASE WHEN h AND p THEN 'both' WHEN h THEN 'hyper_only' WHEN p THEN 'perm_only' ELSE 'none' END AS significance_class,
           CASE WHEN h5 AND p5 THEN 'both' WHEN h5 THEN 'hyper_only' WHEN p5 THEN 'perm_only' ELSE 'none' END AS significance_class_005
    FROM f""")
def flt08(t):
    """Significance flags and classes at the configured and comparison levels."""
    return S.flag_levels(t.sites).select(
        "CAAP_Group", "Gene", "Position", "sig_hyp", "sig_perm", "sig_both", "significance_class", "significance_class_005"
    )


SUMS = "count(*) AS n, CAST(sum(CASE WHEN sig_hyp THEN 1 ELSE 0 END) AS BIGINT) AS n_hyp, CAST(sum(CASE WHEN sig_perm THEN 1 ELSE 0 END) AS BIGINT) AS n_perm, CAST(sum(CASE WHEN sig_both THEN 1 ELSE 0 END) AS BIGINT) AS n_both"


@query("ag10", SIG + f"SELECT CAAP_Group, {SUMS} FROM sig GROUP BY CAAP_Group")
def ag10(t):
    """Significant rows per scheme."""
    return S.summarise(sig(t), "CAAP_Group")


@query("ag11", SIG + f"SELECT coalesce(CAAP_Group, 'ALL') AS CAAP_Group, Pattern, {SUMS} FROM sig GROUP BY GROUPING SETS ((CAAP_Group, Pattern), (Pattern))")
def ag11(t):
    """Significant rows per scheme and pattern and per pattern."""
    return S.summarise_patterns(sig(t))


@query("wn15", SIG + """
    , c AS (SELECT CAAP_Group, Pattern, count(*) AS n FROM sig GROUP BY CAAP_Group, Pattern)
    SELECT CAAP_Group, Pattern, n, round(n * 1e2 / sum(n) OVER (PARTITION BY CAAP_Group), 1) AS pct FROM c""")
def wn15(t):
    """Percentage of patterns within each scheme."""
    return S.within_percentage(P.label_counts(sig(t), "CAAP_Group", "Pattern"), ["CAAP_Group"])


META = """ SELECT Gene, Position, CAAP_Group, concat(Gene, '_', CAST(Position AS VARCHAR)) AS GenePos, sig_both,
      CASE WHEN sig_both THEN 'Both' WHEN sig_hyp THEN 'Hypergeometric' WHEN sig_perm THEN 'Permutation' ELSE 'Not Significant' END AS SignificanceLevel,
      false AS IsConserved FROM sig WHERE isSignificant"""


@query("src09_meta", SIG + META)
def src09_meta(t):
    """Significant meta table."""
    return S.meta_table(sig(t).where("isSignificant")).select(
        "Gene", "Position", "CAAP_Group", "GenePos", "sig_both", "SignificanceLevel", "IsConserved")


def gene_stats(t):
    """Statistics of the sites, dealt by what they are grouped by; they are no more than the rows of ``lineitem``."""
    return S.gene_statistics(dealt(S.flag_levels(t.sites), "Gene", "CAAP_Group", rows=t.lineitem.count()))


@query("ag14", """
    SELECT Gene, CAAP_Group, round(avg(CASE WHEN Pvalue <= 1e-1 AND coalesce(pvalue_boot <= 1e-1, false) THEN 1e0 ELSE 0e0 END), 6) AS frac_sig_both,
           quantile_cont(Pvalue, 0.5) AS median_pval_hyp, min(Pvalue) AS min_pval_hyp,
           quantile_cont(pvalue_boot, 0.5) AS median_pval_boot, min(pvalue_boot) AS min_pval_boot
    FROM {sites} GROUP BY Gene, CAAP_Group""")
def ag14(t):
    """Per-gene significance statistics."""
    return gene_stats(t).withColumn("frac_sig_both", F.round("frac_sig_both", 6))


# ------------------------------------------------------------------ gene filter
DENS = """
    WITH dedup AS (SELECT DISTINCT Trait, CAAP_Group, Gene, Position FROM {sites}),
    dens AS (
      SELECT d.Trait, d.CAAP_Group, d.Gene, g.Length, count(*) AS n_CAAS, count(*) * 1e2 / g.Length AS n_CAAS_per_length
      FROM dedup d JOIN {genes} g ON g.Gene = d.Gene GROUP BY d.Trait, d.CAAP_Group, d.Gene, g.Length),
    th AS (
      SELECT Trait, CAAP_Group, quantile_cont(n_CAAS_per_length, 0.99) AS threshold,
             quantile_cont(n_CAAS, 0.75) + 1e0 * (quantile_cont(n_CAAS, 0.75) - quantile_cont(n_CAAS, 0.25)) AS iqr_threshold
      FROM dens GROUP BY Trait, CAAP_Group),
    ext AS (SELECT d.*, 'Extreme' AS Category FROM dens d JOIN th ON th.Trait = d.Trait AND th.CAAP_Group = d.CAAP_Group
            WHERE n_CAAS_per_length > threshold),
    iqr AS (SELECT d.* FROM dens d JOIN th ON th.Trait = d.Trait AND th.CAAP_Group = d.CAAP_Group WHERE n_CAAS > iqr_threshold)"""


def site_keys(t):
    """Keys of all sites, written once for the density, the clusters and the joins of a query."""
    return t.once("site_keys", lambda t: checkpoint(t.sites.select("Trait", "CAAP_Group", "Gene", "Position")))


def dens(t):
    return t.once("dens", lambda t: G.gene_density(site_keys(t), t.genes))


@query("ag03", DENS + "SELECT Trait, CAAP_Group, Gene, Length, n_CAAS, round(n_CAAS_per_length, 6) AS n_CAAS_per_length FROM dens")
def ag03(t):
    """Site density per gene."""
    return dens(t).withColumn("n_CAAS_per_length", F.round("n_CAAS_per_length", 6))


@query("jn02", "SELECT s.Gene, s.Position, s.CAAP_Group, g.Length FROM {sites} s JOIN {genes} g ON g.Gene = s.Gene")
def jn02(t):
    """Sites with gene length, rows without one dropped."""
    return t.sites.join(t.genes.select("Gene", "Length"), "Gene").select("Gene", "Position", "CAAP_Group", "Length")


@query("ag04", DENS + "SELECT Trait, CAAP_Group, Gene, n_CAAS, round(n_CAAS_per_length, 6) AS n_CAAS_per_length, Category FROM ext")
def ag04(t):
    """Extreme genes by density quantile."""
    return G.extreme_genes(dens(t)).select("Trait", "CAAP_Group", "Gene", "n_CAAS", *r("n_CAAS_per_length"), "Category")


@query("ag05", DENS + "SELECT Trait, CAAP_Group, Gene, n_CAAS FROM iqr")
def ag05(t):
    """Count outliers beyond Q3 + k IQR."""
    return G.iqr_outliers(dens(t), 1.0).select("Trait", "CAAP_Group", "Gene", "n_CAAS")


@query("jn03", DENS + "SELECT d.Gene, d.CAAP_Group, round(th.threshold, 6) AS threshold, round(th.iqr_threshold, 6) AS iqr_threshold FROM dens d JOIN th ON th.Trait = d.Trait AND th.CAAP_Group = d.CAAP_Group")
def jn03(t):
    """Both thresholds joined back onto genes."""
    d = dens(t)
    out = d.join(G.density_thresholds(d), G.KEYS).join(G.iqr_thresholds(d, 1.0), G.KEYS)
    return out.select("Gene", "CAAP_Group", *r("threshold", "iqr_threshold"))


# Cluster flags by brute force over every interval, independent of the Spark formulation.
CLUSTER = """
    u AS (SELECT DISTINCT Gene, CAAP_Group, Position FROM {sites}),
    rk AS (SELECT *, row_number() OVER (PARTITION BY Gene, CAAP_Group ORDER BY Position) AS i,
                  count(*) OVER (PARTITION BY Gene, CAAP_Group) AS n FROM u),
    prm AS (SELECT 2 AS minlen, 2e-1 AS maxcaas UNION ALL SELECT 3, 5e-2 UNION ALL SELECT 2, 1e-2),
    iv AS (
      SELECT a.Gene, a.CAAP_Group, p.minlen, p.maxcaas, a.i AS l, b.i AS rr
      FROM rk a JOIN rk b ON b.Gene = a.Gene AND b.CAAP_Group = a.CAAP_Group AND b.i >= a.i CROSS JOIN prm p
      WHERE a.n >= p.minlen AND b.Position - a.Position + 1 >= p.minlen
        AND (b.i - a.i + 1) * 1e0 / (b.Position - a.Position + 1) >= p.maxcaas),
    flg AS (
      SELECT k.Gene, k.CAAP_Group, p.minlen, p.maxcaas, k.Position,
             CASE WHEN EXISTS (SELECT 1 FROM iv WHERE iv.Gene = k.Gene AND iv.CAAP_Group = k.CAAP_Group
                    AND iv.minlen = p.minlen AND iv.maxcaas = p.maxcaas AND k.i BETWEEN iv.l AND iv.rr)
                  THEN 'Discarded' ELSE 'Good' END AS ClusteringFlag
      FROM rk k CROSS JOIN prm p)"""
PARAMS = [(2, 0.2), (3, 0.05), (2, 0.01)]


def flags(t, params=PARAMS):
    return C.clustered_positions(site_keys(t), params)


def flag_rows(t):
    return flags(t, [(3, 0.05)]).select("Gene", "CAAP_Group", "Position", "ClusteringFlag")


def one_flag(t):
    return checkpoint(flag_rows(t))


def bad_genes(t):
    """Genes and schemes with a discarded position, written once."""
    return t.once("bad_genes", lambda t: checkpoint(flag_rows(t).where("ClusteringFlag = 'Discarded'").select("Gene", "CAAP_Group", "ClusteringFlag").distinct()))


@query("ca09", "WITH " + CLUSTER + "SELECT Gene, CAAP_Group, Position, ClusteringFlag FROM flg WHERE minlen = 3")
def ca09(t):
    """Positional cluster filter."""
    return flag_rows(t)


@query("ca10", "WITH " + CLUSTER + "SELECT Gene, CAAP_Group, Position, minlen, maxcaas, ClusteringFlag FROM flg")
def ca10(t):
    """Cluster filter over a parameter grid."""
    return flags(t).select("Gene", "CAAP_Group", "Position", "minlen", "maxcaas", "ClusteringFlag")


@query("wn13", "WITH " + CLUSTER + "SELECT Gene, CAAP_Group, count(*) AS n_bad FROM flg WHERE ClusteringFlag = 'Discarded' AND minlen = 3 GROUP BY Gene, CAAP_Group")
def wn13(t):
    """Cumulative cover flag: discarded positions per gene and scheme."""
    return flag_rows(t).where("ClusteringFlag = 'Discarded'").groupBy("Gene", "CAAP_Group").agg(F.count(F.lit(1)).alias("n_bad"))


@query("ag09", "WITH " + CLUSTER + "SELECT minlen, maxcaas, " + ", ".join(
    f"count(*) FILTER (CAAP_Group = '{g}') AS {g}" for g in GROUPS) + " FROM flg WHERE ClusteringFlag = 'Discarded' GROUP BY minlen, maxcaas")
def ag09(t):
    """Sweep summary pivoted by scheme."""
    return C.cluster_sweep_summary(flags(t), GROUPS)


RUNS = "WITH " + CLUSTER + """,
    d AS (SELECT Gene, CAAP_Group, Position, Position - row_number() OVER (PARTITION BY Gene, CAAP_Group ORDER BY Position) AS isl
          FROM flg WHERE ClusteringFlag = 'Discarded' AND minlen = 3),
    runs AS (SELECT Gene, CAAP_Group, isl, count(*) AS size FROM d GROUP BY Gene, CAAP_Group, isl),
    lab AS (SELECT CASE WHEN size = 1 THEN 'Singlet' WHEN size >= 6 THEN '6+' ELSE CAST(size AS VARCHAR) END AS label, count(*) AS n FROM runs GROUP BY 1)
    SELECT label, n, round(n * 1e2 / sum(n) OVER (), 6) AS pct FROM lab"""


@query("ag17", RUNS)
def ag17(t):
    """Run-length classes of discarded positions."""
    bad = checkpoint(flag_rows(t).where("ClusteringFlag = 'Discarded'"))
    return C.run_length_shares(bad, ("Gene", "CAAP_Group")).withColumn("pct", F.round("pct", 6))


CATS = DENS.replace("WITH dedup", "WITH " + CLUSTER + ", dedup") + """,
    dub AS (SELECT i.*, 'Dubious' AS Category FROM iqr i
            WHERE EXISTS (SELECT 1 FROM flg f WHERE f.Gene = i.Gene AND f.CAAP_Group = i.CAAP_Group AND minlen = 3 AND ClusteringFlag = 'Discarded')),
    rem AS (SELECT Trait, CAAP_Group, Gene, CASE WHEN count(*) > 1 THEN 'Both' ELSE min(Category) END AS Category
            FROM (SELECT * FROM ext UNION ALL SELECT * FROM dub) x GROUP BY Trait, CAAP_Group, Gene)"""


def removed(t):
    d = dens(t)
    return G.merge_categories(G.extreme_genes(d), G.dubious_genes(d, bad_genes(t), 1.0))


@query("ag06", CATS + "SELECT CAAP_Group, Gene, n_CAAS, Category FROM dub")
def ag06(t):
    """Dubious genes: count outliers with a clustered site."""
    return G.dubious_genes(dens(t), bad_genes(t), 1.0).select("CAAP_Group", "Gene", "n_CAAS", "Category")


@query("jn05", CATS + "SELECT s.Gene, s.CAAP_Group, s.Position FROM {sites} s WHERE EXISTS (SELECT 1 FROM dub d WHERE d.Gene = s.Gene AND d.CAAP_Group = s.CAAP_Group)")
def jn05(t):
    """Sites of dubious genes by tuple membership."""
    dub = G.dubious_genes(dens(t), bad_genes(t), 1.0)
    return dealt(site_keys(t), "Gene", "CAAP_Group").join(dub, ["Gene", "CAAP_Group"], "left_semi").select("Gene", "CAAP_Group", "Position")


@query("ag07", CATS + "SELECT CAAP_Group, Gene, Category FROM rem")
def ag07(t):
    """Merged removal categories."""
    return removed(t).select("CAAP_Group", "Gene", "Category")


@query("ag08", CATS + """ SELECT d.CAAP_Group, d.Gene, d.n_CAAS, round(th.threshold, 6) AS threshold_extreme, round(th.iqr_threshold, 6) AS threshold_dubious,
      coalesce(r.Category, 'Normal') AS Category
    FROM dens d JOIN th ON th.Trait = d.Trait AND th.CAAP_Group = d.CAAP_Group
    LEFT JOIN rem r ON r.Trait = d.Trait AND r.CAAP_Group = d.CAAP_Group AND r.Gene = d.Gene""")
def ag08(t):
    """Full gene statistics with thresholds and category."""
    return G.categorised(dens(t), bad_genes(t), multiplier=1.0).select(
        "CAAP_Group", "Gene", "n_CAAS", *r("threshold_extreme", "threshold_dubious"), "Category")


@query("jn04", CATS + "SELECT d.CAAP_Group, coalesce(r.Category, 'Normal') AS Category, count(*) AS n FROM dens d LEFT JOIN rem r ON r.CAAP_Group = d.CAAP_Group AND r.Gene = d.Gene GROUP BY 1, 2")
def jn04(t):
    """Category mapping by left join and coalesce."""
    cat = dealt(removed(t).select("CAAP_Group", "Gene", F.col("Category").alias("c")), "CAAP_Group", "Gene", rows=dens(t).count())
    out = dens(t).join(cat, ["CAAP_Group", "Gene"], "left").withColumn("Category", F.coalesce("c", F.lit("Normal")))
    return P.label_counts(out, "CAAP_Group", "Category")


@query("jn06", CATS + "SELECT Gene, CAAP_Group, Position FROM {sites} s WHERE NOT EXISTS (SELECT 1 FROM rem r WHERE r.Gene = s.Gene AND r.CAAP_Group = s.CAAP_Group)")
def jn06(t):
    """Sites outside removed (gene, scheme) tuples."""
    return G.drop_removed(dealt(site_keys(t), "Gene", "CAAP_Group"), removed(t)).select("Gene", "CAAP_Group", "Position")


@query("jn07", CATS + """, grp AS (SELECT DISTINCT CAAP_Group FROM rem)
    SELECT 'group' AS scope, g.CAAP_Group, b.Gene FROM {genes} b CROSS JOIN grp g
    WHERE NOT EXISTS (SELECT 1 FROM rem r WHERE r.Gene = b.Gene AND r.CAAP_Group = g.CAAP_Group)
    UNION ALL
    SELECT 'main', 'main', b.Gene FROM {genes} b WHERE b.Gene NOT IN (
      SELECT Gene FROM rem GROUP BY Gene HAVING count(DISTINCT CAAP_Group) = (SELECT count(*) FROM grp))""")
def jn07(t):
    """Cleaned backgrounds per scheme and the main one."""
    rem = removed(t)
    bg = t.genes.select("Gene")
    per = G.cleaned_background(bg, rem).select(F.lit("group").alias("scope"), "CAAP_Group", "Gene")
    main = G.cleaned_background_main(bg, rem).select(F.lit("main").alias("scope"), F.lit("main").alias("CAAP_Group"), "Gene")
    return per.unionByName(main)


COMBO = CATS + """,
    stat AS (SELECT d.CAAP_Group, d.Gene, d.Length, d.n_CAAS, d.n_CAAS_per_length, coalesce(r.Category, 'Normal') AS Category
             FROM dens d LEFT JOIN rem r ON r.CAAP_Group = d.CAAP_Group AND r.Gene = d.Gene),
    clg AS (SELECT DISTINCT Gene, CAAP_Group FROM flg WHERE minlen = 3 AND ClusteringFlag = 'Discarded'),
    cmb AS (SELECT s.*, c.Gene IS NOT NULL AS Cluster_removed, Category IN ('Extreme','Both') AS Extreme, Category IN ('Dubious','Both') AS Dubious,
        CASE WHEN Category = 'Normal' AND c.Gene IS NULL THEN 'None' ELSE concat_ws('+', CASE WHEN Category IN ('Extreme','Both') THEN 'Extreme' END,
          CASE WHEN Category IN ('Dubious','Both') THEN 'Dubious' END, CASE WHEN c.Gene IS NOT NULL THEN 'Cluster' END) END AS filter_combo
        FROM stat s LEFT JOIN clg c ON c.Gene = s.Gene AND c.CAAP_Group = s.CAAP_Group),
    gst AS (SELECT Gene, CAAP_Group, avg(CASE WHEN Pvalue <= 1e-1 AND coalesce(pvalue_boot <= 1e-1, false) THEN 1e0 ELSE 0e0 END) AS frac_sig_both,
                   quantile_cont(Pvalue, 0.5) AS median_pval_hyp FROM {sites} GROUP BY Gene, CAAP_Group)"""


def combo_flags(t):
    d = dens(t)
    stats = G.full_gene_stats(d, removed(t), multiplier=1.0)
    return G.filter_combo(stats, bad_genes(t))


@query("jn13", COMBO + """ SELECT c.Gene, c.CAAP_Group, c.filter_combo, round(g.frac_sig_both, 6) AS frac_sig_both, g.median_pval_hyp
    FROM cmb c LEFT JOIN gst g ON g.Gene = c.Gene AND g.CAAP_Group = c.CAAP_Group""")
def jn13(t):
    """Gene flags with cluster flags and significance statistics."""
    return combo_flags(t).join(gene_stats(t), ["Gene", "CAAP_Group"], "left").select(
        "Gene", "CAAP_Group", "filter_combo", *r("frac_sig_both"), "median_pval_hyp")


@query("ag15", COMBO + """ SELECT c.CAAP_Group, c.filter_combo, count(*) AS n_genes, round(avg(Length), 1) AS mean_Length, round(stddev_samp(Length), 1) AS sd_Length,
      round(avg(n_CAAS), 2) AS mean_n_CAAS, round(stddev_samp(n_CAAS), 2) AS sd_n_CAAS, round(avg(n_CAAS_per_length), 4) AS mean_density,
      round(stddev_samp(n_CAAS_per_length), 4) AS sd_density, round(avg(frac_sig_both), 4) AS mean_frac_sig_both, round(stddev_samp(frac_sig_both), 4) AS sd_frac_sig_both,
      round(avg(median_pval_hyp), 4) AS mean_median_pval, round(stddev_samp(median_pval_hyp), 4) AS sd_median_pval
    FROM cmb c LEFT JOIN gst g ON g.Gene = c.Gene AND g.CAAP_Group = c.CAAP_Group GROUP BY 1, 2""")
def ag15(t):
    """Overlap summary: mean and deviation of five descriptors."""
    return G.overlap_summary(combo_flags(t).join(gene_stats(t), ["Gene", "CAAP_Group"], "left"))


# ------------------------------------------------------------------ post-processing
NORM = """
    std AS (
      SELECT Gene AS gene, Position AS position, concat(Gene, '@', CAST(Position AS VARCHAR)) AS site_id, CAAP_Group AS caap_group,
             Pattern AS pattern_type, Pvalue AS pvalue, pvalue_boot, change_side, change_top, change_bottom,
             CASE WHEN parallel_top IS NULL THEN 'none' ELSE lower(parallel_top) END AS parallel_top,
             CASE WHEN parallel_bottom = '' THEN 'none' ELSE parallel_bottom END AS parallel_bottom, parallel_type,
             is_conserved_meta = 'TRUE' AS is_conserved_meta, asr_is_conserved = 'yes' AS asr_is_conserved,
             asr_root_conserved = 'true' AS asr_root_conserved, mrca_1_posterior, mrca_2_posterior, mrca_3_posterior,
             Pvalue <= 1e-1 AS sig_hyp, coalesce(pvalue_boot <= 1e-1, false) AS sig_perm,
             Pvalue <= 1e-1 AND coalesce(pvalue_boot <= 1e-1, false) AS sig_both
      FROM {sites}),
    low AS (SELECT *, coalesce(mrca_1_posterior < 2e-1, false) OR coalesce(mrca_2_posterior < 2e-1, false) OR coalesce(mrca_3_posterior < 2e-1, false) AS low FROM std)"""


def std(t):
    df = P.normalise(t.sites)
    hyp, perm = F.col("pvalue") <= 0.1, F.coalesce(F.col("pvalue_boot") <= 0.1, F.lit(False))
    return df.withColumn("sig_hyp", hyp).withColumn("sig_perm", perm).withColumn("sig_both", hyp & perm)


@query("flt07", "WITH" + NORM + "SELECT site_id, caap_group, pattern_type, parallel_top, parallel_bottom, is_conserved_meta, asr_is_conserved, asr_root_conserved FROM std")
def flt07(t):
    """Schema normalisation."""
    return std(t).select("site_id", "caap_group", "pattern_type", "parallel_top", "parallel_bottom",
                         "is_conserved_meta", "asr_is_conserved", "asr_root_conserved")


@query("flt06", "WITH" + NORM + "SELECT site_id, caap_group, CASE WHEN low THEN 'mrca_posterior_below_0.2' ELSE 'kept' END AS RemovalReason FROM low")
def flt06(t):
    """Hard filter on pair posteriors; both outputs."""
    kept, gone = P.split_low_posterior(std(t), 0.2)
    out = kept.withColumn("RemovalReason", F.lit("kept")).unionByName(gone)
    return out.select("site_id", "caap_group", "RemovalReason")


@query("flt09", "WITH" + NORM + "SELECT site_id, caap_group FROM std WHERE NOT (is_conserved_meta AND NOT asr_is_conserved)")
def flt09(t):
    """Dubious-conserved exclusion."""
    return std(t).where(~P.dubious_conserved(F.col("is_conserved_meta"), F.col("asr_is_conserved"))).select("site_id", "caap_group")


@query("flt10", "WITH" + NORM + "SELECT 'top' AS d, count(*) AS n FROM std WHERE change_side IN ('top','both') UNION ALL SELECT 'bottom', count(*) FROM std WHERE change_side IN ('bottom','both') UNION ALL SELECT 'all', count(*) FROM std WHERE change_side <> 'none'")
def flt10(t):
    """Direction filters."""
    s = std(t)
    parts = [P.direction(s, d).agg(F.lit(d).alias("d"), F.count(F.lit(1)).alias("n")) for d in ("top", "bottom", "all")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("flt11", "SELECT Gene, Position, CAAP_Group FROM {sites} WHERE upper(trim(CAAP_Group)) IN ('US','GS0','GS1','GS2','GS3','GS4') AND Pvalue <= 5e-2")
def flt11(t):
    """Scheme pool membership."""
    pool = F.upper(F.trim("CAAP_Group")).isin(*GROUPS)
    return t.sites.where(pool & (F.col("Pvalue") <= 0.05)).select("Gene", "Position", "CAAP_Group")


ORI = "WITH" + NORM + """,
    ori AS (SELECT 'global' AS orientation, * FROM std UNION ALL SELECT 'top', * FROM std WHERE change_side IN ('top','both')
            UNION ALL SELECT 'bottom', * FROM std WHERE change_side IN ('bottom','both') UNION ALL SELECT 'both', * FROM std WHERE change_side = 'both')"""


@query("se07", ORI + "SELECT orientation, caap_group, count(*) AS n, count(DISTINCT site_id) AS n_sites FROM ori GROUP BY 1, 2")
def se07(t):
    """Orientation union."""
    return P.orientation_rows(std(t)).groupBy("orientation", "caap_group").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("site_id").alias("n_sites"))


FLAGS = ORI + ", gf AS (SELECT orientation, site_id, gene, position, " + ", ".join(
    f"bool_or(upper(caap_group) = '{g}') AS {g.lower()}" for g in GROUPS) + " FROM ori GROUP BY 1, 2, 3, 4)"


@query("ag13", FLAGS + "SELECT orientation, site_id, us, gs0, gs1, gs2, gs3, gs4 FROM gf")
def ag13(t):
    """Per-site scheme flags per orientation."""
    return P.group_flags(P.orientation_rows(std(t))).select("orientation", "site_id", *[g.lower() for g in GROUPS])


@query("se08", FLAGS + "SELECT concat_ws('+', " + ", ".join(f"CASE WHEN {g.lower()} THEN '{g.lower()}' END" for g in GROUPS) + ") AS combo_label, count(*) AS n FROM gf WHERE orientation = 'global' GROUP BY 1")
def se08(t):
    """Intersections by flag combination."""
    return P.intersections(P.group_flags(P.orientation_rows(std(t))).where("orientation = 'global'"), [g.lower() for g in GROUPS])


@query("se09", "WITH" + NORM + """ SELECT 'scenario1' AS scenario, caap_group, count(DISTINCT site_id) AS n_ids FROM std WHERE caap_group <> 'GS0' GROUP BY 2
    UNION ALL SELECT 'scenario2', caap_group, count(DISTINCT site_id) FROM std WHERE caap_group <> 'US' GROUP BY 2
    UNION ALL SELECT 'scenario3', caap_group, count(DISTINCT site_id) FROM std WHERE caap_group IN ('US','GS0') GROUP BY 2""")
def se09(t):
    """Overlap scenarios by scheme subset."""
    return P.scheme_scenarios(std(t), "site_id")


PPL = "CASE WHEN parallel_type = 'none' THEN pattern_type ELSE concat(pattern_type, ' / ', parallel_type) END"


@query("ag12", "WITH" + NORM + f""", src AS (SELECT *, {PPL} AS pp FROM std)
    SELECT CASE WHEN grouping(caap_group) = 1 THEN 'overall' ELSE 'per_group' END AS Scope, coalesce(caap_group, 'ALL') AS CAAP_Group,
           pattern_type AS Pattern, parallel_type AS Parallel, pp AS PatternParallel,
           count(DISTINCT site_id) AS Positions_total, count(DISTINCT gene) AS Genes_total
    FROM src GROUP BY GROUPING SETS ((pattern_type, parallel_type, pp), (caap_group, pattern_type, parallel_type, pp))""")
def ag12(t):
    """Focal table, overall and per scheme."""
    return P.focal_table(std(t))


@query("sc08", "WITH" + NORM + f"SELECT DISTINCT pattern_type, parallel_type, {PPL} AS label FROM std")
def sc08(t):
    """Pattern / parallel label."""
    return std(t).select("pattern_type", "parallel_type", L.pattern_parallel(F.col("pattern_type"), F.col("parallel_type")).alias("label")).distinct()


@query("ag33", "WITH" + NORM + """, a AS (SELECT count(*) AS tot, count(*) FILTER (NOT low) AS kept, count(*) FILTER (NOT low AND is_conserved_meta) AS cons FROM low)
    SELECT 'all_positions' AS scenario, tot AS rows, round(tot * 1e0 / tot, 6) AS fraction_of_total FROM a
    UNION ALL SELECT 'retained_positions', kept, round(kept * 1e0 / tot, 6) FROM a
    UNION ALL SELECT 'retained_conserved_meta', cons, round(cons * 1e0 / tot, 6) FROM a
    UNION ALL SELECT 'retained_meta_not_conserved', kept - cons, round((kept - cons) * 1e0 / tot, 6) FROM a
    UNION ALL SELECT 'removed_low_mrca', tot - kept, round((tot - kept) * 1e0 / tot, 6) FROM a""")
def ag33(t):
    """Conserved-status burden."""
    return P.conserved_burden(*P.split_low_posterior(std(t), 0.2)).withColumn("fraction_of_total", F.round("fraction_of_total", 6))


@query("ag16", "WITH" + NORM + """, bad AS (SELECT DISTINCT site_id FROM low WHERE low),
    lg AS (SELECT CASE WHEN b.site_id IS NULL THEN 'retained' ELSE 'removed' END AS filter_status, 'Hypothesis p-value' AS pval_type, pvalue AS p FROM std LEFT JOIN bad b ON b.site_id = std.site_id
           UNION ALL SELECT CASE WHEN b.site_id IS NULL THEN 'retained' ELSE 'removed' END, 'Permutation p-value (boot)', pvalue_boot FROM std LEFT JOIN bad b ON b.site_id = std.site_id),
    ag AS (SELECT pval_type, filter_status, count(*) AS total, count(*) FILTER (p <= 1e-1) AS c10, count(*) FILTER (p <= 5e-2) AS c05 FROM lg WHERE p IS NOT NULL GROUP BY 1, 2)
    SELECT pval_type, filter_status, 'all' AS threshold_scope, total AS count, 1e0 AS proportion FROM ag
    UNION ALL SELECT pval_type, filter_status, '<= 0.10', c10, round(c10 * 1e0 / total, 6) FROM ag
    UNION ALL SELECT pval_type, filter_status, '<= 0.05', c05, round(c05 * 1e0 / total, 6) FROM ag""")
def ag16(t):
    """p-value burden of removed and retained sites."""
    s = std(t)
    gone = s.where(P.low_posterior(s, 0.2)).select("site_id")
    return P.pvalue_burden(s, gone).withColumn("proportion", F.round("proportion", 6))


@query("ag36", "WITH" + NORM + f"SELECT change_side, caap_group, {PPL} AS label, count(*) AS n FROM std GROUP BY 1, 2, 3")
def ag36(t):
    """Label counts per direction and scheme."""
    lab = std(t).withColumn("label", L.pattern_parallel(F.col("pattern_type"), F.col("parallel_type")))
    return P.label_counts(lab, "change_side", "caap_group", "label")


EVENT_COLS = ["site_id", "gene", "position", "caap_group", "pattern_type", "pvalue", "sig_both"]


@query("jn12", COMBO.replace("WITH ", "WITH " + NORM + ", ", 1) + """
    SELECT s.site_id, s.caap_group, 'cluster' AS RemovalStage FROM std s
    WHERE EXISTS (SELECT 1 FROM flg f WHERE f.Gene = s.gene AND f.Position = s.position AND f.CAAP_Group = s.caap_group AND minlen = 3 AND ClusteringFlag = 'Discarded')
    UNION ALL
    SELECT s.site_id, s.caap_group, CASE r.Category WHEN 'Extreme' THEN 'extreme_gene' WHEN 'Dubious' THEN 'dubious_with_clusters' ELSE 'extreme_and_dubious' END
    FROM std s JOIN rem r ON r.Gene = s.gene AND r.CAAP_Group = s.caap_group""")
def jn12(t):
    """Removal events of the cluster and gene filters."""
    s = std(t).select(*EVENT_COLS)
    ev = P.removal_events(P.cluster_events(s, one_flag(t)), P.gene_events(s, removed(t)))
    return ev.select("site_id", "caap_group", "RemovalStage")


@query("se12", COMBO.replace("WITH ", "WITH " + NORM + ", ", 1) + """, ev AS (
    SELECT 'precluster' AS RemovalStage FROM low WHERE low
    UNION ALL SELECT 'cluster' FROM std s
    WHERE EXISTS (SELECT 1 FROM flg f WHERE f.Gene = s.gene AND f.Position = s.position AND f.CAAP_Group = s.caap_group AND minlen = 3 AND ClusteringFlag = 'Discarded')
    UNION ALL
    SELECT CASE r.Category WHEN 'Extreme' THEN 'extreme_gene' WHEN 'Dubious' THEN 'dubious_with_clusters' ELSE 'extreme_and_dubious' END
    FROM std s JOIN rem r ON r.Gene = s.gene AND r.CAAP_Group = s.caap_group)
    SELECT RemovalStage, count(*) AS n FROM ev GROUP BY 1""")
def se12(t):
    """Union of all removal events by stage."""
    full = std(t)
    s = full.select(*EVENT_COLS)
    pre = P.split_low_posterior(full, 0.2)[1].select("site_id", "RemovalReason").withColumn("RemovalStage", F.lit("precluster"))
    ev = P.removal_events(pre, P.cluster_events(s, one_flag(t)), P.gene_events(s, removed(t)))
    return P.label_counts(ev, "RemovalStage")


@query("se05", COMBO.replace("WITH ", "WITH " + NORM + ", ", 1) + """,
    pre AS (SELECT DISTINCT gene AS Gene FROM low WHERE low), cl AS (SELECT DISTINCT Gene FROM cmb WHERE Cluster_removed),
    gf AS (SELECT DISTINCT Gene FROM cmb WHERE Extreme OR Dubious), anyf AS (SELECT DISTINCT Gene FROM cmb WHERE filter_combo <> 'None'),
    sg AS (SELECT DISTINCT gene AS Gene FROM std WHERE sig_both),
    post AS (SELECT Gene FROM cl UNION SELECT Gene FROM gf),
    ns AS (SELECT Gene FROM cmb EXCEPT SELECT Gene FROM anyf EXCEPT SELECT Gene FROM sg EXCEPT SELECT Gene FROM pre)
    SELECT 'excluded_preproc' AS list, Gene FROM pre UNION ALL SELECT 'excluded_postproc_clusters', Gene FROM cl
    UNION ALL SELECT 'excluded_postproc_genefilter', Gene FROM gf UNION ALL SELECT 'excluded_postproc', Gene FROM post
    UNION ALL SELECT 'excluded_nonsig', Gene FROM ns
    UNION ALL SELECT 'excluded_overall', Gene FROM (SELECT Gene FROM pre UNION SELECT Gene FROM post UNION SELECT Gene FROM ns) z""")
def se05(t):
    """Six exclusion lists."""
    s = std(t)
    pre = s.where(P.low_posterior(s, 0.2)).select(F.col("gene").alias("Gene"))
    return P.exclusion_lists(combo_flags(t), s, pre)


@query("ag35", "WITH" + NORM + """ SELECT s.gene, count(DISTINCT site_id) AS n_caas_positions, round(avg(CASE WHEN sig_both THEN 1e0 ELSE 0e0 END), 6) AS frac_sig_both,
      g.chr, round(log10(count(DISTINCT site_id) * 1e0 / (max(g.end_bp) - max(g.start_bp) + 1)), 6) AS log_caas_density
    FROM std s JOIN {genes} g ON g.Gene = s.gene GROUP BY s.gene, g.chr""")
def ag35(t):
    """Site density per gene on the genome."""
    return P.gene_site_density(std(t), t.genes).select("gene", "n_caas_positions", *r("frac_sig_both"), "chr", *r("log_caas_density"))


# ------------------------------------------------------------------ scalar functions
@query("sc07", "SELECT concat(Gene, '_', CAST(Position AS VARCHAR)) AS tok, Gene AS gene, Position AS pos, Gene AS gene_at, Position AS pos_at FROM {sites}")
def sc07(t):
    """Gene/position tokens parsed in both spellings."""
    df = t.sites.select(
        F.concat_ws("_", "Gene", F.col("Position").cast("string")).alias("tok"),
        F.concat_ws("@", "Gene", F.col("Position").cast("string")).alias("at"))
    g, p = L.gene_pos_underscore(F.col("tok"))
    ga, pa = L.gene_pos_at(F.col("at"))
    return df.select("tok", g.alias("gene"), p.alias("pos"), ga.alias("gene_at"), pa.alias("pos_at"))


@query("sc11", "SELECT p_name, replace(p_name, ' ', '_') AS label, count(*) AS n FROM {part} GROUP BY p_name")
def sc11(t):
    """Label normalisation."""
    quoted = t.part.select("p_name", L.normal_label(F.concat(F.lit(' "'), "p_name", F.lit("' "))).alias("label"))
    return P.label_counts(quoted, "p_name", "label")


@query("sc12", "SELECT p_brand, regexp_replace(trim(concat(p_brand, ' x/', p_type)), '[^A-Za-z0-9_.-]+', '_', 'g') AS safe, count(*) AS n FROM {part} GROUP BY 1, 2")
def sc12(t):
    """Group name made safe for a file name."""
    df = t.part.select("p_brand", L.safe_name(F.concat("p_brand", F.lit(" x/"), "p_type")).alias("safe"))
    return P.label_counts(df, "p_brand", "safe")


@query("sc13", "SELECT is_conserved_meta AS a, asr_is_conserved AS b, asr_root_conserved AS c, is_conserved_meta = 'TRUE' AS ba, asr_is_conserved = 'yes' AS bb, asr_root_conserved = 'true' AS bc, count(*) AS n FROM {sites} GROUP BY 1, 2, 3")
def sc13(t):
    """Boolean coercion of spellings."""
    df = t.sites.groupBy("is_conserved_meta", "asr_is_conserved", "asr_root_conserved").agg(F.count(F.lit(1)).alias("n"))
    return df.select(F.col("is_conserved_meta").alias("a"), F.col("asr_is_conserved").alias("b"), F.col("asr_root_conserved").alias("c"),
                     L.as_bool(F.col("is_conserved_meta")).alias("ba"), L.as_bool(F.col("asr_is_conserved")).alias("bb"),
                     L.as_bool(F.col("asr_root_conserved")).alias("bc"), "n")


@query("sc24", """SELECT DISTINCT change_top, change_bottom, change_side,
    CASE WHEN change_side = 'both' AND change_top = change_bottom THEN concat(change_top, '_both') WHEN change_side = 'both' THEN concat(change_top, '_', change_bottom)
         WHEN change_side = 'top' THEN concat(change_top, '_top') WHEN change_side = 'bottom' THEN concat(change_bottom, '_bottom') ELSE 'no_change' END AS pattern_type
    FROM {sites}""")
def sc24(t):
    """Derived side and pattern labels."""
    a, b = F.col("change_top"), F.col("change_bottom")
    return t.sites.select(a, b, L.change_side(a, b).alias("change_side"), L.pattern_type(a, b).alias("pattern_type")).distinct()


@query("sc28", "SELECT p_brand, printf('%.2f', avg(p_retailprice)) AS shown, concat(printf('%.1f', 1e2 * avg(CASE WHEN p_size > 25 THEN 1e0 ELSE 0e0 END)), '%') AS pct FROM {part} GROUP BY p_brand")
def sc28(t):
    """Number formatting."""
    df = t.part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("a"), F.avg((F.col("p_size") > 25).cast("double")).alias("b"))
    return df.select("p_brand", L.bounds_text(F.col("a")).alias("shown"), L.percent_text(F.col("b")).alias("pct"))


@query("sc32", "SELECT DISTINCT gene_list, CASE WHEN gene_list LIKE '%\\_top\\_%' ESCAPE '\\' OR gene_list LIKE '%\\_top' ESCAPE '\\' THEN 'top' WHEN gene_list LIKE '%\\_bottom\\_%' ESCAPE '\\' OR gene_list LIKE '%\\_bottom' ESCAPE '\\' THEN 'bottom' ELSE 'global' END AS scenario FROM {terms}")
def sc32(t):
    """Scenario from a list name."""
    return t.terms.select("gene_list", L.side_from_name(F.col("gene_list")).alias("scenario")).distinct()


@query("sc09", """SELECT DISTINCT coord, concat('chr', CAST(1 + CAST(substr(Gene, 2) AS BIGINT) % 3 AS VARCHAR)) AS chrom, CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3 AS start_bp,
    CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3 + CASE WHEN Position % 4 = 0 THEN 0 ELSE 2 END AS end_bp, substr(coord, length(coord), 1) AS ref FROM {queries}""")
def sc09(t):
    """Codon range and reference residue parsing."""
    c, a, b = L.codon_range(F.col("coord"))
    return t.queries.select("coord").distinct().select("coord", c.alias("chrom"), a.alias("start_bp"), b.alias("end_bp"), L.protein_ref(F.col("coord")).alias("ref"))
