"""Position and gene scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.arrays import entries
from sitewise.functions.labels import SUBSTANTIVE, TRUE_WORDS_SCORE, as_bool, row_mean
from sitewise.functions.schemes import WEIGHTS_INT, weight
from sitewise.operators.ordering import (
    attach_scalars,
    average_ranks,
    decile_score,
    quantiles,
)
from sitewise.session import checkpoint, kept

COMPONENTS = ["variability_score", "pattern_score", "asr_score", "convergence_score", "parallel_score"]
# Score of one side by its change label; other labels are excluded.
SIDE_VALUE = {"convergent": 1.0, "codivergent": 0.5, "divergent": 0.25}


def component_deciles(sites: DataFrame) -> DataFrame:
    """Decile scores of both p-values over all rows except the control scheme.

    Ties are ordered by gene, position and scheme so that tiles are reproducible.  Both
    tile passes and the result read the input, so it is written once first.
    """
    df = kept(sites.where("CAAP_Group <> 'GS0'"))
    df = decile_score(df, ["Pvalue", "Gene", "Position", "CAAP_Group"], "variability_score")
    return decile_score(df, ["pvalue_boot", "Gene", "Position", "CAAP_Group"], "pattern_score")


def positions(scored: DataFrame) -> DataFrame:
    """One row per (gene, position): weights add up, the rest is taken from the first row.

    "First" is the row with the smallest scheme name, a fixed order.  The aggregation
    keeps a struct minimum, so it combines on the map side.
    """
    rest = [c for c in scored.columns if c not in ("Gene", "Position")]
    first = F.min(F.struct("CAAP_Group", *[c for c in rest if c != "CAAP_Group"])).alias("f")
    return (
        scored.withColumn("_w", weight(F.col("CAAP_Group"), WEIGHTS_INT))
        .groupBy("Gene", "Position")
        .agg(F.sum("_w").cast("long").alias("biochem_weight_sum"), first)
        .select("Gene", "Position", "biochem_weight_sum", "f.*")
    )


def _mean_with_penalty(top: Column, bottom: Column) -> Column:
    mean = F.coalesce(row_mean(top, bottom), F.lit(0.0))
    return mean * F.when(top.isNotNull() & bottom.isNotNull(), 1.0).otherwise(0.75)


def convergence_score(change_top: Column, change_bottom: Column) -> Column:
    def value(side: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("double"))
        for label, v in SIDE_VALUE.items():
            out = out.when(side == label, v)
        return out

    return _mean_with_penalty(value(change_top), value(change_bottom))


def parallel_score(p_top: Column, p_bottom: Column, change_top: Column, change_bottom: Column) -> Column:
    """Every spelling of the parallelism labels is accepted; only substantive sides count."""
    def coeff(p: Column) -> Column:
        low = F.lower(p)
        return (
            F.when(p.isNull() | low.isin("", "na"), F.lit(None).cast("double"))
            .when((low == "non-parallel") | p.isin("False", "FALSE"), 1.0)
            .when(low == "mixed", 0.75)
            .when(p.isin("True", "TRUE") | low.startswith("parallel"), 0.5)
        )

    def side(p: Column, change: Column) -> Column:
        return F.when(change.isin(*SUBSTANTIVE), coeff(p))

    return _mean_with_penalty(side(p_top, change_top), side(p_bottom, change_bottom))


def asr_score(meta: Column, asr: Column, root: Column, pair_ids: Column, posteriors: list[Column], all_posterior: Column) -> Column:
    """Posterior-weighted score of a conserved position; 1 when it is not conserved."""
    n = len(posteriors)
    w = 1.0 / n
    ids = F.filter(
        F.transform(F.split(F.coalesce(pair_ids, F.lit("")), ","), lambda x: F.trim(x).try_cast("int")),
        lambda x: x.isNotNull() & (x >= 1),
    )
    probs = F.array(*[F.coalesce(p.cast("double"), F.lit(0.0)) for p in posteriors])
    root_p = F.when(as_bool(root, TRUE_WORDS_SCORE), F.coalesce(all_posterior.cast("double"), F.lit(0.0))).otherwise(0.0)

    def one(acc: Column, i: Column) -> Column:
        p = F.coalesce(F.try_element_at(probs, i), F.lit(0.0))
        return acc + F.least((w * p + w * root_p) / 2, F.lit(0.9 * w))

    total = F.aggregate(ids, (F.lit(n) - F.size(ids)) * w, one)
    return (
        F.when(~as_bool(meta, TRUE_WORDS_SCORE), 1.0)
        .when(~as_bool(asr, TRUE_WORDS_SCORE), 0.0)
        .when(F.size(ids) == 0, 1.0)
        .otherwise(F.least(total, F.lit(1.0)))
    )


def _label_scores(df: DataFrame, n_pairs: int) -> DataFrame:
    c = F.col
    return df.withColumns({
        "asr_score": asr_score(c("is_conserved_meta"), c("asr_is_conserved"), c("asr_root_conserved"), c("conserved_pair"),
                               [c(f"mrca_{i}_posterior") for i in range(1, n_pairs + 1)], c("all_mrca_posterior")),
        "convergence_score": convergence_score(c("change_top"), c("change_bottom")),
        "parallel_score": parallel_score(c("parallel_top"), c("parallel_bottom"), c("change_top"), c("change_bottom")),
    })


def position_scores(sites: DataFrame, n_pairs: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Position table with five components, their mean and the weighted composite.

    With ``keep`` the table holds these columns of the first row and the scores, which are then taken
    from each row before rows meet, so that nothing else is written or shuffled; sites are told
    apart by gene, position and scheme.  Without it the first row is returned whole.
    """
    if keep is None:
        pos = _label_scores(positions(component_deciles(sites)), n_pairs)
    else:
        p_values = [c for c in ("Pvalue", "pvalue_boot") if c not in keep]
        thin = _label_scores(sites, n_pairs).select("Gene", "Position", "CAAP_Group", *p_values, *keep, "asr_score", "convergence_score", "parallel_score")
        pos = positions(component_deciles(thin).drop(*p_values))
    pos = pos.withColumn("pre_score", row_mean(*[F.col(x) for x in COMPONENTS]))
    return pos.withColumn("CAAS_score", F.col("pre_score") * F.col("biochem_weight_sum") / 10)


def leave_one_out(pos: DataFrame) -> DataFrame:
    """Composite variants, each without one component, plus the unweighted one."""
    out = {"CAAS_current": F.col("CAAS_score"), "CAAS_unweighted": F.col("pre_score")}
    for drop in COMPONENTS:
        keep = [F.col(x) for x in COMPONENTS if x != drop]
        out["CAAS_no_" + drop.removesuffix("_score")] = row_mean(*keep) * F.col("biochem_weight_sum") / 10
    return pos.withColumns(out)


def gene_scores(pos: DataFrame) -> DataFrame:
    """90th percentile of the composite per gene, overall and per direction, with counts.

    A gene holds at most one row per alignment column, which bounds the percentile state.
    """
    top, bot = F.col("change_side").isin("top", "both"), F.col("change_side").isin("bottom", "both")
    q = F.lit(0.9)
    return pos.groupBy("Gene").agg(
        F.percentile("CAAS_score", q).alias("gene_caas_score"),
        F.percentile(F.when(top, F.col("CAAS_score")), q).alias("gene_caas_score_top"),
        F.percentile(F.when(bot, F.col("CAAS_score")), q).alias("gene_caas_score_bottom"),
        F.count(F.lit(1)).alias("n_positions"),
        F.count_if(top).alias("n_positions_top"), F.count_if(bot).alias("n_positions_bottom"),
    )


def top_flags(pos: DataFrame) -> DataFrame:
    """Top 10/5/1 percent flags per direction, from that direction's own thresholds."""
    pos = kept(pos)
    for name, sides in (("top", ("top", "both")), ("bot", ("bottom", "both"))):
        inside = F.col("change_side").isin(*sides)
        thr = quantiles(pos.where(inside), [], "CAAS_score", {"_t10": 0.90, "_t5": 0.95, "_t1": 0.99})
        pos = attach_scalars(pos, thr)
        pos = pos.withColumns({
            f"is_{name}_{k}pct": inside & F.coalesce(F.col("CAAS_score") >= F.col(f"_t{k}"), F.lit(False)) for k in (10, 5, 1)
        }).drop("_t10", "_t5", "_t1")
    return pos


def accumulation_scores(pvals: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted scheme p-values (long ``Gene, scheme, pval``) to ``1 - score`` and its top-5% flag.

    The weighted sum is divided by the number of schemes present, not by their weight.
    """
    wide = pvals.groupBy("Gene").agg(
        *[F.min(F.when(F.col("scheme") == s, F.col("pval"))).alias(f"accum_pval_{s}") for s in weights]
    )
    n = sum((F.col(f"accum_pval_{s}").isNotNull().cast("int") for s in weights), F.lit(0))
    s = sum((F.coalesce(F.col(f"accum_pval_{k}") * w, F.lit(0.0)) for k, w in weights.items()), F.lit(0.0))
    wide = wide.withColumn("gene_rand_score", F.when(n > 0, 1 - s / n))
    wide = checkpoint(wide)
    thr = quantiles(wide, [], "gene_rand_score", {"_thr": 0.95})
    return attach_scalars(wide, thr).withColumn("accum_significant", F.col("gene_rand_score") >= F.col("_thr")).drop("_thr")


def rer_summary(rer: DataFrame, column: str) -> DataFrame:
    rho = F.col("Rho")
    return rer.where(F.col(column).isNotNull()).select(
        F.col("gene").alias("Gene"), F.col(column).alias("rer_min_pval"), (F.col(column) <= 0.05).alias("rer_significant"),
        rho.alias("rer_rho"),
        F.when(rho > 0, "accelerated").when(rho < 0, "decelerated").when(rho.isNotNull(), "neutral").alias("rer_acceleration"),
    )


def fade_directions(top: DataFrame, bottom: DataFrame, threshold: float = 100.0) -> DataFrame:
    """Full outer join of the two directional maxima."""
    a = top.select(F.col("gene").alias("Gene"), F.col("max_bf").alias("fade_max_bf_top"), (F.col("max_bf") >= threshold).alias("fade_significant_top"))
    b = bottom.select(F.col("gene").alias("Gene"), F.col("max_bf").alias("fade_max_bf_bottom"), (F.col("max_bf") >= threshold).alias("fade_significant_bottom"))
    return a.join(b, "Gene", "full")


def combine_genes(caas: DataFrame, *others: DataFrame) -> DataFrame:
    """Left chain on Gene; every input is unique per gene, so no fan-out."""
    return reduce(lambda left, right: left.join(right, "Gene", "left"), others, caas)


def correlations(df: DataFrame, cols: list[str], ranks: bool = True) -> DataFrame:
    """Pearson and Spearman for every ordered pair of score columns, complete cases, at least three.

    All Pearson values come from one aggregation pass; Spearman ranks are computed on
    the complete cases of each pair.
    """
    df = checkpoint(df.select(*cols)) if ranks else df
    pairs = [(a, b) for a in cols for b in cols if a < b]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs += [F.count_if(both).alias(f"n{i}"), F.corr(F.when(both, F.col(a)), F.when(both, F.col(b))).alias(f"r{i}")]
    one = df.agg(*aggs)
    out = one.select(F.inline(entries(
        ["score_a", "score_b", "n", "pearson_r"],
        *[(a, b, F.col(f"n{i}"), F.when(F.col(f"n{i}") >= 3, F.col(f"r{i}"))) for i, (a, b) in enumerate(pairs)],
    )))
    if not ranks:
        return out
    parts = []
    for a, b in pairs:
        both = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
        ranked = average_ranks(both, [a, b], "r_")
        parts.append(ranked.agg(F.lit(a).alias("score_a"), F.lit(b).alias("score_b"), F.corr("r_" + a, "r_" + b).alias("spearman_r")))
    return out.join(reduce(DataFrame.unionByName, parts), ["score_a", "score_b"])


def top_sets(df: DataFrame, cols: list[str], thresholds: dict[str, float], n: int, ids: list[str]) -> DataFrame:
    """Long ``score, threshold, id`` membership of the top sets.

    All score columns share one sort for their quantiles, of values counted before the shuffle;
    only members go long with their id.  The fixed-size sets are the first ``n`` rows of each score.
    """
    rows = kept(df.select(*ids, *cols))
    scores = F.inline(entries(["score", "v"], *[(c, F.col(c).cast("double")) for c in cols]))
    ident = F.concat_ws("::", *[F.col(i).cast("string") for i in ids]).alias("id")
    cuts = quantiles(rows.select(scores).where("v IS NOT NULL"), ["score"], "v", {name: 1 - share for name, share in thresholds.items()})
    names = F.filter(
        F.array(*[F.when(F.col("v") >= F.col(name), F.lit(name)) for name in thresholds]), lambda x: x.isNotNull()
    )
    cuts = F.broadcast(checkpoint(cuts))  # a row a score
    pct = rows.select(*ids, scores).where("v IS NOT NULL").join(cuts, "score").select("score", F.explode(names).alias("threshold"), ident).distinct()
    best = [rows.where(F.col(c).isNotNull()).orderBy(F.desc(F.col(c).cast("double")), *ids).limit(n).select(F.lit(c).alias("score"), F.lit("topN").alias("threshold"), ident) for c in cols]
    return reduce(DataFrame.unionByName, best, pct)


def set_overlaps(members: DataFrame, set_col: str, item_col: str, within: list[str], names: list[str]) -> DataFrame:
    """Sizes, intersection, Jaccard and overlap coefficient of every pair of sets.

    Items first collapse to their membership signature and a count per signature, so
    the pair expansion works on distinct signatures instead of on items.
    """
    sig = members.groupBy(*within, item_col).agg(F.array_sort(F.collect_set(set_col)).alias("sig"))
    sig = sig.groupBy(*within, "sig").agg(F.count(F.lit(1)).alias("n"))
    pairs = [(a, b) for a in names for b in names if a < b]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        has_a, has_b = F.array_contains("sig", a), F.array_contains("sig", b)
        for tag, cond in (("a", has_a), ("b", has_b), ("i", has_a & has_b)):
            aggs.append(F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(f"{tag}{i}"))
    agged = sig.groupBy(*within).agg(*aggs)
    out = agged.select(*within, F.inline(entries(
        ["score_a", "score_b", "n_a", "n_b", "n_intersection"],
        *[(a, b, F.col(f"a{i}"), F.col(f"b{i}"), F.col(f"i{i}")) for i, (a, b) in enumerate(pairs)],
    )))
    union = F.col("n_a") + F.col("n_b") - F.col("n_intersection")
    small = F.least("n_a", "n_b")
    return out.withColumn("n_union", union).withColumn(
        "jaccard", F.when(union > 0, F.col("n_intersection") / union)
    ).withColumn("overlap_smaller", F.when(small > 0, F.col("n_intersection") / small))


def rank_shifts(df: DataFrame, base: str, variants: list[str]) -> DataFrame:
    """Mean, median and maximum absolute shift of the descending average rank against ``base``."""
    ranked = average_ranks(df.select(base, *variants), [base, *variants], "_r_", descending=True)
    shifts = ranked.select(F.inline(entries(
        ["variant", "shift"], *[(v, F.abs(F.col("_r_" + base) - F.col("_r_" + v))) for v in variants]
    )))
    med = quantiles(shifts, ["variant"], "shift", {"median_abs_rank_shift": 0.5})
    agg = shifts.groupBy("variant").agg(
        F.avg("shift").alias("mean_abs_rank_shift"), F.max("shift").alias("max_abs_rank_shift"))
    return agg.join(med, "variant")


def rank_spread(df: DataFrame, cols: list[str], out: str = "rank_spread") -> DataFrame:
    """Largest minus smallest descending average rank over the given scores."""
    ranked = average_ranks(df, cols, "_r_", descending=True)
    names = ["_r_" + c for c in cols]
    return ranked.withColumn(out, F.greatest(*names) - F.least(*names)).drop(*names)


def principal_component(df: DataFrame, cols: list[str], align: str) -> tuple[DataFrame, DataFrame]:
    """First principal component of the standardised columns (scores, loadings).

    The correlation matrix is one distributed aggregation; only that k x k matrix is
    decomposed on the driver.  Constant columns are left out and the sign follows
    the correlation with ``align``.
    """
    import numpy as np

    df = kept(df)
    full = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*cols, align]]))
    stats = full.agg(*[f(c).alias(f"{t}_{c}") for c in cols for t, f in (("m", F.avg), ("s", F.stddev_samp))]).collect()[0]
    used = [c for c in cols if stats[f"s_{c}"]]
    if len(used) < 2:
        raise ValueError("fewer than two variable columns")
    pairs = [(a, b) for a in used for b in used]
    row = full.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
                   *[F.corr(c, align).alias(f"y_{c}") for c in used]).collect()[0]
    matrix = np.array([row[f"c{i}"] for i in range(len(pairs))], dtype=float).reshape(len(used), len(used))
    values, vectors = np.linalg.eigh(matrix)
    loading = vectors[:, -1]
    if float(np.dot(loading, [row[f"y_{c}"] or 0.0 for c in used])) < 0:
        loading = -loading
    z = sum(((F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"] * float(w) for c, w in zip(used, loading)), F.lit(0.0))
    loadings = df.sparkSession.createDataFrame(
        [(c, float(w), float(values[-1] / len(used))) for c, w in zip(used, loading)],
        "variable string, loading double, variance_explained double",
    )
    return df.withColumn("pc1", z), loadings


#: Least uniqueness of a variable, steps of the fit, and the change at which it ends.
UNIQUE, STEPS, SETTLED = 0.005, 20_000, 1e-13


def one_factor(correlation, steps: int = STEPS):
    """(loadings, uniquenesses) of the maximum-likelihood factor model with one factor, by expectation-maximisation on a small matrix.

    The first loadings are the square roots of the largest correlations.
    """
    import numpy as np

    s = np.asarray(correlation, float)
    loading = np.sqrt(np.abs(s - np.eye(len(s))).max(1))
    unique = np.maximum(UNIQUE, 1 - loading**2)
    for _ in range(steps):
        beta = loading / unique
        beta = beta / (1 + loading @ beta)
        toward = s @ beta
        new = toward / (1 - beta @ loading + beta @ toward)
        left = np.maximum(UNIQUE, np.diag(s) - new * toward)
        moved = max(np.abs(new - loading).max(), np.abs(left - unique).max())
        loading, unique = new, left
        if moved < SETTLED:
            break
    return loading, unique


def single_factor(df: DataFrame, cols: list[str], align: str) -> tuple[DataFrame, DataFrame]:
    """Regression scores and loadings of one factor over the complete rows (``factor1``; ``variable, loading, uniqueness``).

    Two aggregations over the written columns give the moments; only the correlation matrix reaches the driver, and
    ``df`` is read again for the scores.  Rows
    with a null in a column or in ``align`` have a null score.  Constant columns are left out,
    the sign follows the correlation with ``align``; fewer than three columns or too few rows
    for them are an error.
    """
    import numpy as np

    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*cols, align]])
    full = kept(df.where(complete).select(*dict.fromkeys([*cols, align])))
    stats = full.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{t}_{c}") for c in cols for t, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    used = [c for c in cols if stats[f"s_{c}"]]
    if len(used) < 3 or stats["n"] <= len(used) + 2:
        raise ValueError("one factor needs three variable columns and more rows than those and two")
    pairs = [(a, b) for a in used for b in used]
    row = full.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)], *[F.corr(c, align).alias(f"y_{c}") for c in used]).first()
    matrix = np.array([row[f"c{i}"] for i in range(len(pairs))], float).reshape(len(used), len(used))
    np.fill_diagonal(matrix, 1.0)
    loading, unique = one_factor(matrix)
    weight = np.linalg.solve(matrix, loading)
    if float(weight @ [row[f"y_{c}"] or 0.0 for c in used]) < 0:
        loading, weight = -loading, -weight
    z = sum(((F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"] * float(w) for c, w in zip(used, weight)), F.lit(0.0))
    loadings = df.sparkSession.createDataFrame([(c, float(w), float(u)) for c, w, u in zip(used, loading, unique)], "variable string, loading double, uniqueness double")
    return df.withColumn("factor1", F.when(complete, z)), loadings
