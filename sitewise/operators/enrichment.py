"""Gene-set enrichment, term overlap and 2x2 tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewise.functions.arrays import entries
from sitewise.functions.labels import side_from_name
from sitewise.functions.numeric import fisher_udf, hypergeom_tail_udf, normal_tail_udf
from sitewise.operators.ordering import average_rank, bh_adjust
from sitewise.operators.trees import all_pairs


def over_representation(lists: DataFrame, sets: DataFrame, background: DataFrame, min_size: int = 5, max_size: int = 500) -> DataFrame:
    """Upper-tail hypergeometric enrichment of every list against every set, BH within list.

    Lists and sets are first cut to the background.  ``lists`` is ``gene_list, gene``,
    ``sets`` is ``set_name, gene`` and ``background`` is ``gene``.
    """
    bg = background.select("gene").distinct()
    n_bg = bg.count()
    li = lists.select("gene_list", "gene").distinct().join(bg, "gene", "left_semi")
    se = sets.select("set_name", "gene").distinct().join(bg, "gene", "left_semi")
    set_size = se.groupBy("set_name").agg(F.count(F.lit(1)).alias("size")).where(F.col("size").between(min_size, max_size))
    list_size = li.groupBy("gene_list").agg(F.count(F.lit(1)).alias("n_list")).where(F.col("n_list") >= min_size)
    hit = li.join(se.join(set_size.select("set_name"), "set_name", "left_semi"), "gene").groupBy("gene_list", "set_name").agg(
        F.count(F.lit(1)).alias("overlap"))
    out = hit.join(set_size, "set_name").join(list_size, "gene_list")
    out = out.withColumn("expected", F.col("size") * F.col("n_list") / F.lit(n_bg)).withColumn(
        "enrichment_ratio", F.col("overlap") / F.col("expected"))
    p = hypergeom_tail_udf("overlap", F.lit(n_bg), "size", "n_list")
    return bh_adjust(out.withColumn("p_value", p), "p_value", ["gene_list"])


def map_symbols(genes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Symbols to ids through a user-supplied map; unmapped symbols drop out."""
    return genes.join(mapping.select(F.col("symbol").alias("gene"), "id").distinct(), "gene").select("gene", "id")


def standard_terms(df: DataFrame) -> DataFrame:
    """First available column per role, FDR floored, minus log10 and scenario."""
    def first(cands: list[str]):
        cols = [F.col(c) for c in cands if c in df.columns]
        return F.coalesce(*cols) if cols else F.lit(None)

    fdr = F.greatest(first(["FDR", "fdr", "adjP", "fdrBH", "fdr_bh"]).try_cast("double"), F.lit(2.2250738585072014e-308))
    out = df.select(
        "gene_list", fdr.alias("FDR_std"), first(["database", "enrichmentCategory", "category", "db"]).alias("database_std"),
        first(["description", "geneSet", "term", "name"]).alias("term_std"), (-F.log10(fdr)).alias("neglog10FDR"))
    return out.where("FDR_std IS NOT NULL AND term_std IS NOT NULL AND term_std <> ''").withColumn(
        "scenario", side_from_name(F.col("gene_list")))


def term_recurrence(terms: DataFrame) -> DataFrame:
    return terms.select("scenario", "gene_list", "term_std", "database_std", "FDR_std").distinct().groupBy(
        "scenario", "term_std", "database_std").agg(
        F.countDistinct("gene_list").alias("n_lists"), F.min("FDR_std").alias("best_fdr"), F.avg("FDR_std").alias("mean_fdr"))


def top_terms(terms: DataFrame, n: int) -> DataFrame:
    """First ``n`` terms per list by FDR; the row limit is applied inside each task first."""
    order = Window.partitionBy("gene_list").orderBy("FDR_std", "term_std", "database_std")
    return terms.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")


def term_overlap_matrix(terms: DataFrame, metric: str = "overlap") -> DataFrame:
    """Full list-by-list overlap (diagonal included) of top-term sets.

    Terms collapse to signatures of the lists that contain them before any pair is
    formed; sizes come from the same table.
    """
    member = terms.select("gene_list", "term_std").distinct()
    sig = member.groupBy("term_std").agg(F.array_sort(F.collect_set("gene_list")).alias("sig")).groupBy("sig").agg(
        F.count(F.lit(1)).alias("n"))
    pairs = sig.select("n", F.explode("sig").alias("gene_list_x"), "sig").select("n", "gene_list_x", F.explode("sig").alias("gene_list_y"))
    inter = pairs.groupBy("gene_list_x", "gene_list_y").agg(F.sum("n").alias("inter"))
    size = member.groupBy("gene_list").agg(F.count(F.lit(1)).alias("n"))
    x = size.select(F.col("gene_list").alias("gene_list_x"), F.col("n").alias("nx"))
    y = size.select(F.col("gene_list").alias("gene_list_y"), F.col("n").alias("ny"))
    # One row per list on either side: the matrix itself is the result.
    full = all_pairs(x, y).join(inter, ["gene_list_x", "gene_list_y"], "left").withColumn("inter", F.coalesce("inter", F.lit(0)))
    denom = F.least("nx", "ny") if metric == "overlap" else F.col("nx") + F.col("ny") - F.col("inter")
    return full.select("gene_list_x", "gene_list_y", F.when(denom > 0, F.col("inter") / denom).otherwise(0.0).alias("overlap"))


def shared_term_edges(terms: DataFrame) -> DataFrame:
    """Edges between lists weighted by the number of shared terms (signatures first)."""
    sig = terms.select("gene_list", "term_std").distinct().groupBy("term_std").agg(
        F.array_sort(F.collect_set("gene_list")).alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    a = sig.select("n", "sig", F.explode("sig").alias("from_list"))
    edges = a.select("n", "from_list", F.explode(F.filter("sig", lambda s: s > F.col("from_list"))).alias("to_list"))
    return edges.groupBy("from_list", "to_list").agg(F.sum("n").alias("n_shared"))


def rank_sum_enrichment(stats: DataFrame, sets: DataFrame, min_genes: int = 10) -> DataFrame:
    """Wilcoxon rank-sum of set members against the rest, tie-corrected normal approximation, BH over sets."""
    ranked = average_rank(stats.where("stat IS NOT NULL"), "stat", "rk")
    tie = stats.where("stat IS NOT NULL").groupBy("stat").agg(F.count(F.lit(1)).alias("t"))
    tot = tie.agg(F.sum("t").alias("n"), F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).cast("double").alias("ties")).collect()[0]
    n, ties = int(tot["n"] or 0), float(tot["ties"] or 0)
    per = sets.select("set_name", "gene").distinct().join(ranked, "gene").groupBy("set_name").agg(
        F.count(F.lit(1)).alias("n1"), F.sum("rk").alias("r1")).where((F.col("n1") >= min_genes) & (F.col("n1") < n))
    n2 = F.lit(n) - F.col("n1")
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    sd = F.sqrt(F.col("n1") * n2 / 12 * (F.lit(n + 1) - F.lit(ties / max(n * (n - 1), 1))))
    z = (u - F.col("n1") * n2 / 2) / sd
    out = per.select("set_name", F.col("n1").alias("n_genes"), (u / (F.col("n1") * n2) - 0.5).alias("stat"), z.alias("z"))
    return bh_adjust(out.withColumn("pval", normal_tail_udf("z")), "pval", [], "p_adj")


def fisher_by_threshold(df: DataFrame, label: str, flags: dict, marked: str = "high") -> DataFrame:
    """2x2 counts of ``marked`` inside and outside each threshold flag, exact p and odds ratio.

    All counts of all thresholds come from one aggregation pass.
    """
    aggs = []
    for i, cond in enumerate(flags.values()):
        inside = F.coalesce(cond, F.lit(False))
        aggs += [F.count_if(inside).alias(f"n{i}"), F.count_if(inside & F.col(marked)).alias(f"h{i}"),
                 F.count_if(~inside).alias(f"m{i}"), F.count_if(~inside & F.col(marked)).alias(f"g{i}")]
    one = df.agg(*aggs).select(F.inline(entries(
        ["threshold", "n_top", "n_top_high", "n_rest", "n_rest_high"],
        *[(name, F.col(f"n{i}"), F.col(f"h{i}"), F.col(f"m{i}"), F.col(f"g{i}")) for i, name in enumerate(flags)])))
    test = fisher_udf(F.col("n_top") - F.col("n_top_high"), F.col("n_top_high"), F.col("n_rest") - F.col("n_rest_high"), F.col("n_rest_high"))
    return one.withColumn("t", test).select(
        F.lit(label).alias("direction"), "threshold", "n_top", "n_top_high",
        (F.col("n_top_high") / F.greatest("n_top", F.lit(1))).alias("share_high"), "t.odds_ratio", "t.p")
