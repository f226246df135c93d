"""Queries: position and gene scores, ranks, top sets, overlaps, genomic windows."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions import labels as L
from sitewise.functions.schemes import WEIGHTS_FRACTION, WEIGHTS_INT, weight
from sitewise.operators import genomic as N
from sitewise.operators import ordering as O
from sitewise.operators import scoring as S
from sitewise.plans.registry import query
from sitewise.session import checkpoint

COMP = S.COMPONENTS


def _rowmean(*cols: str) -> str:
    n = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols)
    s = " + ".join(f"coalesce({c}, 0e0)" for c in cols)
    return f"(CASE WHEN {n} = 0 THEN NULL ELSE ({s}) / ({n}) END)"


_SIDE = "CASE {c} WHEN 'convergent' THEN 1e0 WHEN 'codivergent' THEN 5e-1 WHEN 'divergent' THEN 25e-2 END"
_PAR = "CASE WHEN {k} IN ('convergent','codivergent','divergent') THEN CASE WHEN {c} IS NULL OR {c} = '' THEN NULL WHEN {c} = 'False' THEN 1e0 WHEN lower({c}) = 'mixed' THEN 75e-2 WHEN {c} = 'True' OR {c} LIKE 'parallel%' THEN 5e-1 END END"


def _pen(a: str, b: str) -> str:
    return f"coalesce({_rowmean(a, b)}, 0e0) * CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1e0 ELSE 75e-2 END"


def _asr_pair(i: int) -> str:
    return f"CASE WHEN list_contains(ids, {i}) THEN least((coalesce(mrca_{i}_posterior, 0e0) + rp) / 3 / 2, 9e-1 / 3) ELSE 0e0 END"


POS = f"""
    WITH base AS (SELECT * FROM {{sites}} WHERE CAAP_Group <> 'GS0'),
    d1 AS (SELECT *, 1e0 - (ntile(10) OVER (ORDER BY Pvalue, Gene, Position, CAAP_Group) - 1) / 9e0 AS variability_score FROM base),
    d2 AS (SELECT Gene AS g2, Position AS p2, CAAP_Group AS c2,
                  1e0 - (ntile(10) OVER (ORDER BY pvalue_boot, Gene, Position, CAAP_Group) - 1) / 9e0 AS pattern_score
           FROM base WHERE pvalue_boot IS NOT NULL),
    dd AS (SELECT d1.*, pattern_score, row_number() OVER (PARTITION BY Gene, Position ORDER BY CAAP_Group) AS rn,
                  sum(CASE CAAP_Group WHEN 'US' THEN 5 WHEN 'GS4' THEN 2 ELSE 1 END) OVER (PARTITION BY Gene, Position) AS wsum
           FROM d1 LEFT JOIN d2 ON g2 = Gene AND p2 = Position AND c2 = CAAP_Group),
    f1 AS (SELECT *, {_SIDE.replace('{c}', 'change_top')} AS ct, {_SIDE.replace('{c}', 'change_bottom')} AS cb,
                  {_PAR.replace('{k}', 'change_top').replace('{c}', 'parallel_top')} AS pt,
                  {_PAR.replace('{k}', 'change_bottom').replace('{c}', 'parallel_bottom')} AS pb,
                  CASE conserved_pair WHEN '1' THEN [1] WHEN '2,3' THEN [2, 3] WHEN '3' THEN [3] ELSE [] END AS ids,
                  CASE WHEN asr_root_conserved = 'true' THEN all_mrca_posterior ELSE 0e0 END AS rp
           FROM dd WHERE rn = 1),
    f2 AS (SELECT *, {_pen('ct', 'cb')} AS convergence_score, {_pen('pt', 'pb')} AS parallel_score,
             CASE WHEN is_conserved_meta <> 'TRUE' THEN 1e0 WHEN asr_is_conserved <> 'yes' THEN 0e0 WHEN len(ids) = 0 THEN 1e0
                  ELSE least((3 - len(ids)) / 3e0 + {_asr_pair(1)} + {_asr_pair(2)} + {_asr_pair(3)}, 1e0) END AS asr_score
           FROM f1),
    pos AS (SELECT Gene, Position, CAST(wsum AS BIGINT) AS biochem_weight_sum, change_side, change_top, change_bottom, Pvalue, pvalue_boot,
              variability_score, pattern_score, round(asr_score, 6) AS asr_score, convergence_score, parallel_score,
              round({_rowmean(*COMP)}, 9) AS pre_score, round({_rowmean(*COMP)} * wsum / 10, 9) AS CAAS_score
            FROM f2)"""
LOO = POS + ", loo AS (SELECT *, CAAS_score AS CAAS_current, pre_score AS CAAS_unweighted, " + ", ".join(
    f"round({_rowmean(*[c for c in COMP if c != d])} * biochem_weight_sum / 10, 9) AS CAAS_no_{d.removesuffix('_score')}" for d in COMP
) + " FROM pos)"
VARIANTS = ["CAAS_current", "CAAS_unweighted", *["CAAS_no_" + d.removesuffix("_score") for d in COMP]]


def rounded(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def pos(t) -> DataFrame:
    # The oracle rounds at the same places, so that ties rank alike in both engines.
    return rounded(rounded(S.position_scores(t.sites, keep=["change_side"]), ["pre_score", "CAAS_score"]), ["asr_score"], 6)


def loo(t) -> DataFrame:
    return rounded(S.leave_one_out(pos(t)), VARIANTS)


@query("wn01", POS + "SELECT Gene, Position, CAAP_Group, round(variability_score, 6) AS variability_score, round(pattern_score, 6) AS pattern_score FROM dd")
def wn01(t):
    """Decile scores, lower is better; NULL stays NULL."""
    return rounded(S.component_deciles(t.sites.select("Gene", "Position", "CAAP_Group", "Pvalue", "pvalue_boot")), ["variability_score", "pattern_score"], 6).select(
        "Gene", "Position", "CAAP_Group", "variability_score", "pattern_score")


@query("wn02", "SELECT Gene, round((ntile(10) OVER (ORDER BY Length, Gene) - 1) / 9e0, 6) AS score FROM {genes}")
def wn02(t):
    """Decile score, higher is better."""
    return O.decile_score(t.genes, ["Length", "Gene"], "score", lower_better=False).select("Gene", F.round("score", 6).alias("score"))


@query("ag18", POS + "SELECT Gene, Position, biochem_weight_sum, change_side, Pvalue, round(variability_score, 6) AS variability_score FROM pos")
def ag18(t):
    """Position aggregate: weight sum and first row."""
    return rounded(S.positions(S.component_deciles(t.sites)), ["variability_score"], 6).select(
        "Gene", "Position", "biochem_weight_sum", "change_side", "Pvalue", "variability_score")


@query("sc17", "SELECT CAAP_Group, CASE CAAP_Group WHEN 'US' THEN 5 WHEN 'GS4' THEN 2 WHEN 'GS0' THEN NULL ELSE 1 END AS wi, CASE CAAP_Group WHEN 'US' THEN 5e-1 WHEN 'GS4' THEN 2e-1 WHEN 'GS0' THEN 0e0 ELSE 1e-1 END AS wf, count(*) AS n FROM {sites} GROUP BY CAAP_Group")
def sc17(t):
    """Scheme weights."""
    g = F.col("CAAP_Group")
    return t.sites.groupBy("CAAP_Group").agg(F.count(F.lit(1)).alias("n")).select(
        g, weight(g, WEIGHTS_INT).alias("wi"), weight(g, WEIGHTS_FRACTION).alias("wf"), "n")


@query("sc18", f"WITH x AS (SELECT *, {_SIDE.replace('{c}', 'change_top')} AS ct, {_SIDE.replace('{c}', 'change_bottom')} AS cb, {_PAR.replace('{k}', 'change_top').replace('{c}', 'parallel_top')} AS pt, {_PAR.replace('{k}', 'change_bottom').replace('{c}', 'parallel_bottom')} AS pb FROM {{sites}}) SELECT Gene, Position, CAAP_Group, {_pen('ct', 'cb')} AS convergence_score, {_pen('pt', 'pb')} AS parallel_score FROM x")
def sc18(t):
    """Convergence and parallelism scores."""
    c = F.col
    return t.sites.select("Gene", "Position", "CAAP_Group", S.convergence_score(c("change_top"), c("change_bottom")).alias("convergence_score"),
                          S.parallel_score(c("parallel_top"), c("parallel_bottom"), c("change_top"), c("change_bottom")).alias("parallel_score"))


@query("sc19", POS + "SELECT Gene, Position, asr_score FROM pos")
def sc19(t):
    """Ancestral-state score."""
    return pos(t).select("Gene", "Position", "asr_score")


@query("sc20", POS + "SELECT Gene, Position, pre_score, CAAS_score FROM pos")
def sc20(t):
    """Null-aware component mean and weighted composite."""
    return pos(t).select("Gene", "Position", "pre_score", "CAAS_score")


@query("sc21", LOO + "SELECT Gene, Position, " + ", ".join(VARIANTS) + " FROM loo")
def sc21(t):
    """Leave-one-out composites."""
    return loo(t).select("Gene", "Position", *VARIANTS)


GENE = POS + """,
    gc AS (SELECT Gene, quantile_cont(CAAS_score, 0.9) AS gene_caas_score,
             quantile_cont(CAAS_score, 0.9) FILTER (change_side IN ('top','both')) AS gene_caas_score_top,
             quantile_cont(CAAS_score, 0.9) FILTER (change_side IN ('bottom','both')) AS gene_caas_score_bottom,
             count(*) AS n_positions, count(*) FILTER (change_side IN ('top','both')) AS n_positions_top,
             count(*) FILTER (change_side IN ('bottom','both')) AS n_positions_bottom FROM pos GROUP BY Gene)"""
GCOLS = ["gene_caas_score", "gene_caas_score_top", "gene_caas_score_bottom"]


def gscore(t):
    return rounded(S.gene_scores(pos(t)), GCOLS, 8)


@query("ag19", GENE + "SELECT Gene, " + ", ".join(f"round({c}, 8) AS {c}" for c in GCOLS) + ", n_positions, n_positions_top, n_positions_bottom FROM gc")
def ag19(t):
    """Gene scores."""
    return gscore(t)


ACC_W = {"us": 0.5, "gs4": 0.2, "gs3": 0.1, "gs2": 0.1, "gs1": 0.1}
ACC = """
    aw AS (SELECT Gene, """ + ", ".join(f"min(CASE WHEN scheme = '{k}' THEN pval END) AS a_{k}" for k in ACC_W) + """ FROM {accum} GROUP BY Gene),
    ar AS (SELECT Gene, """ + ", ".join(f"a_{k}" for k in ACC_W) + """, round(1e0 - (""" + " + ".join(f"coalesce(a_{k} * {w * 10:.0f}e-1, 0e0)" for k, w in ACC_W.items()) + """) / (""" + " + ".join(
    f"CASE WHEN a_{k} IS NULL THEN 0 ELSE 1 END" for k in ACC_W) + """), 9) AS gene_rand_score FROM aw),
    ac AS (SELECT *, gene_rand_score >= (SELECT quantile_cont(gene_rand_score, 0.95) FROM ar) AS accum_significant FROM ar)"""


def acc(t):
    out = S.accumulation_scores(t.accum, ACC_W)
    # The threshold is compared after the same rounding the oracle applies.
    out = out.withColumn("gene_rand_score", F.round("gene_rand_score", 9)).drop("accum_significant")
    thr = O.quantiles(out, [], "gene_rand_score", {"_thr": 0.95})
    return O.attach_scalars(out, thr).withColumn("accum_significant", F.col("gene_rand_score") >= F.col("_thr")).drop("_thr")


@query("ag20", "WITH" + ACC + " SELECT Gene, gene_rand_score, accum_significant FROM ac")
def ag20(t):
    """Accumulation score and its top-5% flag."""
    return acc(t).select("Gene", "gene_rand_score", "accum_significant")


@query("jn15", "WITH tb AS (SELECT gene, max(bayes_factor) AS max_bf FROM {fade} WHERE bayes_factor IS NOT NULL AND direction = 'top' GROUP BY gene), bb AS (SELECT gene, max(bayes_factor) AS max_bf FROM {fade} WHERE bayes_factor IS NOT NULL AND direction = 'bottom' GROUP BY gene) SELECT coalesce(tb.gene, bb.gene) AS Gene, tb.max_bf AS fade_max_bf_top, tb.max_bf >= 100 AS fade_significant_top, bb.max_bf AS fade_max_bf_bottom, bb.max_bf >= 100 AS fade_significant_bottom FROM tb FULL JOIN bb ON bb.gene = tb.gene")
def jn15(t):
    """Full outer join of directional maxima."""
    return fade_dirs(t)


def fade_dirs(t):
    mx = t.fade.where("bayes_factor IS NOT NULL").groupBy("gene", "direction").agg(F.max("bayes_factor").alias("max_bf"))
    return S.fade_directions(mx.where("direction = 'top'"), mx.where("direction = 'bottom'"))


@query("jn14", GENE + "," + ACC + """,
    fd AS (SELECT gene AS Gene, max(bayes_factor) FILTER (direction = 'top') AS ft, max(bayes_factor) FILTER (direction = 'bottom') AS fb FROM {fade} GROUP BY gene)
    SELECT g.Gene, g.n_positions, a.gene_rand_score, a.accum_significant, r.p_perm AS rer_min_pval, r.p_perm <= 5e-2 AS rer_significant,
           CASE WHEN r.p_perm IS NULL THEN NULL WHEN r.Rho > 0 THEN 'accelerated' WHEN r.Rho < 0 THEN 'decelerated' ELSE 'neutral' END AS rer_acceleration,
           ft AS fade_max_bf_top, fb >= 100 AS fade_significant_bottom
    FROM gc g LEFT JOIN ac a ON a.Gene = g.Gene LEFT JOIN (SELECT * FROM {rer} WHERE p_perm IS NOT NULL) r ON r.gene = g.Gene LEFT JOIN fd ON fd.Gene = g.Gene""")
def jn14(t):
    """Gene score chain."""
    out = S.combine_genes(gscore(t), acc(t), S.rer_summary(t.rer, "p_perm"), fade_dirs(t))
    return out.select("Gene", "n_positions", "gene_rand_score", "accum_significant", "rer_min_pval", "rer_significant",
                      "rer_acceleration", "fade_max_bf_top", "fade_significant_bottom")


# ------------------------------------------------------------------ ranks
_AVG = "rank() OVER (ORDER BY {c}{d}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0"


@query("wn03", "SELECT Gene, " + _AVG.replace("{c}", "Length").replace("{d}", "") + " AS rk FROM {genes}")
def wn03(t):
    """Average rank."""
    return O.average_rank(t.genes, "Length", "rk").select("Gene", "rk")


@query("wn04", "WITH q AS (SELECT Gene, " + _AVG.replace("{c}", "Length").replace("{d}", "") + " AS rk FROM {genes}) SELECT Gene, round((rk - 1) / (max(rk) OVER () - 1), 6) AS norm FROM q")
def wn04(t):
    """Rank normalisation."""
    return O.rank_norm(t.genes, "Length", "norm").select("Gene", F.round("norm", 6).alias("norm"))


_RKS = LOO + ", rk AS (SELECT Gene, Position, " + ", ".join(
    f"{_AVG.replace('{c}', v).replace('{d}', ' DESC')} AS r_{v}" for v in VARIANTS) + " FROM loo)"


@query("wn05", _RKS + "SELECT Gene, Position, greatest(" + ", ".join(f"r_{v}" for v in VARIANTS) + ") - least(" + ", ".join(f"r_{v}" for v in VARIANTS) + ") AS rank_spread FROM rk")
def wn05(t):
    """Rank spread across variants."""
    return S.rank_spread(loo(t).select("Gene", "Position", *VARIANTS), VARIANTS).select("Gene", "Position", "rank_spread")


@query("wn06", _RKS + " UNION ALL ".join(
    f"SELECT '{v}' AS variant, round(avg(abs(r_CAAS_current - r_{v})), 6) AS mean_abs_rank_shift, round(quantile_cont(abs(r_CAAS_current - r_{v}), 0.5), 6) AS median_abs_rank_shift, max(abs(r_CAAS_current - r_{v})) AS max_abs_rank_shift FROM rk" for v in VARIANTS[1:4]))
def wn06(t):
    """Rank shift statistics."""
    return rounded(S.rank_shifts(loo(t), "CAAS_current", VARIANTS[1:4]), ["mean_abs_rank_shift", "median_abs_rank_shift"], 6)


@query("wn07", POS + "SELECT Gene, change_side AS gene_direction FROM (SELECT *, row_number() OVER (PARTITION BY Gene ORDER BY CAAS_score DESC, Position) AS rn FROM pos) z WHERE rn = 1")
def wn07(t):
    """Direction of each gene's best position."""
    best = F.max_by("change_side", F.struct("CAAS_score", (-F.col("Position")).alias("p")))
    return pos(t).groupBy("Gene").agg(best.alias("gene_direction"))


@query("wn08", GENE + "SELECT Gene FROM (SELECT Gene, rank() OVER (ORDER BY round(gene_caas_score_top, 8) DESC) AS r, count(*) OVER () AS n FROM gc WHERE gene_caas_score_top IS NOT NULL) z WHERE r <= floor(n * 5e-2)")
def wn08(t):
    """Top share of genes with ties."""
    ranked = O.min_rank(gscore(t).where("gene_caas_score_top IS NOT NULL"), "gene_caas_score_top", "r", descending=True)
    return ranked.where(F.col("r") <= F.floor(F.col("r_n") * 0.05)).select("Gene")


# ------------------------------------------------------------------ top sets
@query("st02", POS + "SELECT Gene, Position, CAAS_score FROM pos ORDER BY CAAS_score DESC, Gene, Position")
def st02(t):
    """Positions by descending score."""
    return pos(t).select("Gene", "Position", "CAAS_score").orderBy(F.desc("CAAS_score"), "Gene", "Position")


@query("st03", POS + "SELECT Gene, Position FROM pos WHERE CAAS_score >= (SELECT quantile_cont(CAAS_score, 0.95) FROM pos)")
def st03(t):
    """Top 5% set by quantile threshold."""
    return O.top_share(pos(t), "CAAS_score", 0.05).select("Gene", "Position")


@query("st04", "SELECT gene, P FROM {rer} ORDER BY P, gene LIMIT 25")
def st04(t):
    """Head of a sorted table."""
    return O.top_n(t.rer.select("gene", "P"), ["P", "gene"], 25)


_ST5 = ", ".join(
    f"change_side IN ('{s}','both') AND CAAS_score >= (SELECT quantile_cont(CAAS_score, 0.{100 - k:02d}) FROM pos WHERE change_side IN ('{s}','both')) AS is_{n}_{k}pct"
    for n, s in (("top", "top"), ("bot", "bottom")) for k in (10, 5, 1))


@query("st05", POS + f"SELECT Gene, Position, {_ST5} FROM pos")
def st05(t):
    """Percentile flags per direction."""
    cols = [f"is_{n}_{k}pct" for n in ("top", "bot") for k in (10, 5, 1)]
    return S.top_flags(pos(t).select("Gene", "Position", "change_side", "CAAS_score")).select("Gene", "Position", *cols)


@query("st01", "SELECT Gene, CASE chr WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrMT' THEN 25 ELSE CAST(substr(chr, 4) AS INT) END AS chr_order FROM {genes}")
def st01(t):
    """Natural chromosome order."""
    return N.with_chromosome_order(t.genes).select("Gene", "chr_order")


SETS = ["CAAS_current", "CAAS_unweighted", "CAAS_no_asr"]
_SE1 = LOO + ", m AS (" + " UNION ALL ".join(
    [f"SELECT '{c}' AS s, '{n}' AS th, concat(Gene, '::', CAST(Position AS VARCHAR)) AS id FROM loo WHERE {c} >= (SELECT quantile_cont({c}, {q}) FROM loo)"
     for c in SETS for n, q in (("top10pct", "0.9"), ("top5pct", "0.95"), ("top1pct", "0.99"))]
    + [f"SELECT * FROM (SELECT '{c}' AS s, 'topN' AS th, concat(Gene, '::', CAST(Position AS VARCHAR)) AS id FROM loo WHERE {c} IS NOT NULL ORDER BY {c} DESC, Gene, Position LIMIT 25) z{i}" for i, c in enumerate(SETS)]) + """),
    sz AS (SELECT s, th, count(*) AS n FROM m GROUP BY s, th),
    ix AS (SELECT a.s AS sa, b.s AS sb, a.th, count(*) AS n FROM m a JOIN m b ON b.th = a.th AND b.id = a.id AND a.s < b.s GROUP BY 1, 2, 3)
    SELECT a.s AS score_a, b.s AS score_b, a.th AS threshold, a.n AS n_a, b.n AS n_b, coalesce(ix.n, 0) AS n_intersection, a.n + b.n - coalesce(ix.n, 0) AS n_union,
      round(coalesce(ix.n, 0) * 1e0 / (a.n + b.n - coalesce(ix.n, 0)), 6) AS jaccard, round(coalesce(ix.n, 0) * 1e0 / least(a.n, b.n), 6) AS overlap_smaller
    FROM sz a JOIN sz b ON b.th = a.th AND a.s < b.s LEFT JOIN ix ON ix.sa = a.s AND ix.sb = b.s AND ix.th = a.th"""


@query("se01", _SE1)
def se01(t):
    """Overlap of top sets between score variants."""
    members = S.top_sets(loo(t), SETS, {"top10pct": 0.10, "top5pct": 0.05, "top1pct": 0.01}, 25, ["Gene", "Position"])
    return rounded(S.set_overlaps(members, "score", "id", ["threshold"], SETS), ["jaccard", "overlap_smaller"], 6)


@query("se04", GENE + """,
    caas AS (SELECT 'top' AS direction, Gene FROM gc WHERE gene_caas_score_top >= (SELECT quantile_cont(gene_caas_score_top, 0.9) FROM gc)
             UNION ALL SELECT 'bottom', Gene FROM gc WHERE gene_caas_score_bottom >= (SELECT quantile_cont(gene_caas_score_bottom, 0.9) FROM gc))
    SELECT direction, 'rer' AS tool, c.Gene FROM caas c WHERE Gene IN (SELECT gene FROM {rer} WHERE P <= 5e-2)
    UNION ALL SELECT direction, 'fade', c.Gene FROM caas c WHERE EXISTS (SELECT 1 FROM {fade} f WHERE f.gene = c.Gene AND f.direction = c.direction AND f.bayes_factor >= 100)""")
def se04(t):
    """Intersections of top genes with the other tools, per direction."""
    g = checkpoint(S.gene_scores(pos(t)))
    top = O.top_share(g, "gene_caas_score_top", 0.1).select(F.lit("top").alias("direction"), "Gene")
    bot = O.top_share(g, "gene_caas_score_bottom", 0.1).select(F.lit("bottom").alias("direction"), "Gene")
    caas = top.unionByName(bot)
    rer = t.rer.where("P <= 0.05").select(F.col("gene").alias("Gene")).distinct()
    fade = t.fade.where("bayes_factor >= 100").select(F.col("gene").alias("Gene"), "direction").distinct()
    a = caas.join(rer, "Gene", "left_semi").select("direction", F.lit("rer").alias("tool"), "Gene")
    b = caas.join(fade, ["Gene", "direction"], "left_semi").select("direction", F.lit("fade").alias("tool"), "Gene")
    return a.unionByName(b)


@query("se06", "WITH a AS (SELECT DISTINCT Gene FROM {sites} WHERE Pvalue <= 1e-2), b AS (SELECT DISTINCT gene AS Gene FROM {fade} WHERE bayes_factor >= 100) SELECT count(*) FILTER (a.Gene IS NOT NULL) AS n_a, count(*) FILTER (b.Gene IS NOT NULL) AS n_b, count(*) FILTER (a.Gene IS NOT NULL AND b.Gene IS NOT NULL) AS n_ab, count(*) FILTER (b.Gene IS NULL) AS n_only_a, count(*) FILTER (a.Gene IS NULL) AS n_only_b FROM a FULL JOIN b ON b.Gene = a.Gene")
def se06(t):
    """Venn counts of two gene sets."""
    a = t.sites.where("Pvalue <= 0.01").select("Gene", F.lit("a").alias("set_name"))
    b = t.fade.where("bayes_factor >= 100").select(F.col("gene").alias("Gene"), F.lit("b").alias("set_name"))
    flags = a.unionByName(b).groupBy("Gene").agg(F.bool_or(F.col("set_name") == "a").alias("a"), F.bool_or(F.col("set_name") == "b").alias("b"))
    return flags.agg(F.count_if("a").alias("n_a"), F.count_if("b").alias("n_b"), F.count_if(F.col("a") & F.col("b")).alias("n_ab"),
                     F.count_if(F.col("a") & ~F.col("b")).alias("n_only_a"), F.count_if(~F.col("a") & F.col("b")).alias("n_only_b"))


@query("ps10", POS + """, pr AS (SELECT 'asr_score' AS a, 'pre_score' AS b, asr_score AS x, pre_score AS y FROM pos
      UNION ALL SELECT 'asr_score', 'pattern_score', asr_score, pattern_score FROM pos UNION ALL SELECT 'pattern_score', 'pre_score', pattern_score, pre_score FROM pos),
    k AS (SELECT * FROM pr WHERE x IS NOT NULL AND y IS NOT NULL),
    rk AS (SELECT *, rank() OVER (PARTITION BY a, b ORDER BY x) + (count(*) OVER (PARTITION BY a, b, x) - 1) / 2e0 AS rx,
                  rank() OVER (PARTITION BY a, b ORDER BY y) + (count(*) OVER (PARTITION BY a, b, y) - 1) / 2e0 AS ry FROM k)
    SELECT a AS score_a, b AS score_b, count(*) AS n, round(corr(x, y), 6) AS pearson_r, round(corr(rx, ry), 6) AS spearman_r FROM rk GROUP BY a, b""")
def ps10(t):
    """Pearson and Spearman correlations of score columns."""
    out = S.correlations(pos(t), ["asr_score", "pattern_score", "pre_score"])
    return rounded(out, ["pearson_r", "spearman_r"], 6)


# Moments of the five components over complete rows, then the leading direction by repeated products and the factor by its fixed point, in SQL.
_N5 = range(1, 6)
_MOM = POS + ", fl AS (SELECT " + ", ".join(f"{c} AS x{k}" for k, c in zip(_N5, COMP)) + ", CAAS_score AS y, Gene, Position FROM pos), cm AS (SELECT * FROM fl WHERE y IS NOT NULL" + "".join(f" AND x{k} IS NOT NULL" for k in _N5) + "), mo AS (SELECT " + ", ".join(
    [f"avg(x{k}) AS m{k}, stddev_samp(x{k}) AS s{k}, corr(x{k}, y) AS y{k}" for k in _N5] + [f"corr(x{i}, x{j}) AS c{i}{j}" for i in _N5 for j in _N5 if i < j]) + " FROM cm)"
_C = lambda i, j: "1e0" if i == j else f"c{min(i, j)}{max(i, j)}"
_AS5 = ", ".join(f"a{k}" for k in _N5)
_DOT = lambda i, v: "(" + " + ".join(f"{_C(i, j)} * {v}{j}" for j in _N5) + ")"
_POWER = _MOM.replace("WITH base", "WITH RECURSIVE base", 1) + f""", pw AS (SELECT 0 AS k, 1e0 AS a1, 9e-1 AS a2, 8e-1 AS a3, 7e-1 AS a4, 6e-1 AS a5
    UNION ALL SELECT k + 1, {", ".join(f"b{i} / sqrt({' + '.join(f'b{j} * b{j}' for j in _N5)})" for i in _N5)} FROM (SELECT k, {", ".join(f"{_DOT(i, 'a')} AS b{i}" for i in _N5)} FROM pw, mo WHERE k < 3000) z),
    ld AS (SELECT *, CASE WHEN {" + ".join(f"a{k} * y{k}" for k in _N5)} < 0 THEN -1e0 ELSE 1e0 END AS sg FROM pw, mo WHERE k = 3000)"""
_FACTOR = _MOM.replace("WITH base", "WITH RECURSIVE base", 1) + f""", em AS (SELECT 0 AS k, {", ".join(f"sqrt(greatest({', '.join(f'abs({_C(i, j)})' for j in _N5 if j != i)})) AS a{i}, greatest(5e-3, 1 - greatest({', '.join(f'abs({_C(i, j)})' for j in _N5 if j != i)})) AS u{i}" for i in _N5)} FROM mo
    UNION ALL SELECT k + 1, {", ".join(f"l{i}, greatest(5e-3, 1 - l{i} * t{i})" for i in _N5)} FROM (SELECT *, {", ".join(f"t{i} / (1 - ({' + '.join(f'b{j} * a{j}' for j in _N5)}) + ({' + '.join(f'b{j} * t{j}' for j in _N5)})) AS l{i}" for i in _N5)}
      FROM (SELECT *, {", ".join(f"{_DOT(i, 'b')} AS t{i}" for i in _N5)} FROM (SELECT *, {", ".join(f"a{i} / u{i} / (1 + {' + '.join(f'a{j} * a{j} / u{j}' for j in _N5)}) AS b{i}" for i in _N5)} FROM em, mo WHERE k < 20000) q) r) z),
    fa AS (SELECT em.*, mo.*, CASE WHEN {" + ".join(f"a{k} / u{k} * y{k}" for k in _N5)} < 0 THEN -1e0 ELSE 1e0 END AS sg FROM em, mo WHERE k = 20000)"""


@query("ps17_factor", _FACTOR + " SELECT v.variable, round(sg * v.a, 4) AS loading, round(v.u, 4) AS uniqueness FROM fa, LATERAL (SELECT unnest([" + ", ".join(f"'{c}'" for c in COMP) + f"]) AS variable, unnest([{_AS5}]) AS a, unnest([{', '.join(f'u{k}' for k in _N5)}]) AS u) v")
def ps17_factor(t):
    """Loadings of one factor behind the five components."""
    return rounded(S.single_factor(pos(t).select(*COMP, "CAAS_score"), COMP, "CAAS_score")[1], ["loading", "uniqueness"], 4)


@query("ps17", _POWER + " SELECT Gene, Position, round(sg * (" + " + ".join(f"(x{k} - m{k}) / s{k} * a{k}" for k in _N5) + "), 6) AS pc1 FROM fl, ld")
def ps17(t):
    """First principal component of the five components, aligned with the composite."""
    scored, _ = S.principal_component(pos(t).select("Gene", "Position", *COMP, "CAAS_score"), COMP, "CAAS_score")
    return scored.select("Gene", "Position", F.round("pc1", 6).alias("pc1"))


# ------------------------------------------------------------------ genomic
LOC = ", loc AS (SELECT p.*, g.chr, substr(g.chr, 4) AS chr_label, CASE g.chr WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrMT' THEN 25 ELSE CAST(substr(g.chr, 4) AS INT) END AS chr_order, g.end_bp, (g.start_bp + g.end_bp) / 2e0 AS gene_mid FROM pos p JOIN {genes} g ON g.Gene = p.Gene)"


def located(t):
    genes = N.with_chromosome_order(t.genes).withColumn("gene_mid", (F.col("start_bp") + F.col("end_bp")) / 2)
    return pos(t).join(genes.drop("Length"), "Gene")


@query("jn17", POS + LOC + "SELECT Gene, Position, chr_order, gene_mid FROM loc")
def jn17(t):
    """Positions with gene coordinates."""
    return located(t).select("Gene", "Position", "chr_order", "gene_mid")


@query("wn09", POS + LOC + ", c AS (SELECT chr_order, chr_label, max(end_bp) AS chr_max FROM loc GROUP BY 1, 2) SELECT chr_order, chr_label, chr_max, coalesce(sum(chr_max) OVER (ORDER BY chr_order, chr_label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (chr_order - 1) * 5e6 AS \"offset\" FROM c")
def wn09(t):
    """Cumulative chromosome offsets."""
    return N.chromosome_offsets(located(t))


@query("wn10", "SELECT Gene, CAST(coalesce(sum(Length) OVER (ORDER BY CASE chr WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrMT' THEN 25 ELSE CAST(substr(chr, 4) AS INT) END, chr, start_bp, Gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM {genes}")
def wn10(t):
    """Global gene offsets by prefix sum of lengths."""
    return N.gene_offsets(t.genes).select("Gene", "offset")


@query("ag29", POS + LOC + """ SELECT chr_order, chr_label, CAST(floor(gene_mid / 1000000) AS BIGINT) AS win_id, count(*) AS n_positions,
      count(*) FILTER (CAAS_score >= 5e-1) AS n_top10_positions, count(*) FILTER (CAAS_score >= 6e-1) AS n_top5_positions,
      round(count(*) FILTER (CAAS_score >= 5e-1) * 1e0 / count(*), 6) AS frac_top_positions, round(avg(CAAS_score) + 1e-9, 6) AS mean_caas
    FROM loc GROUP BY 1, 2, 3""")
def ag29(t):
    """Genomic window accumulation of positions."""
    out = N.window_positions(located(t), {"top10": 0.5, "top5": 0.6})
    out = out.withColumn("mean_caas", F.col("mean_caas") + 1e-9)  # exact decimal ties round alike
    return rounded(out, ["frac_top_positions", "mean_caas"], 6).drop("win_start")


@query("ag29b", """WITH g AS (SELECT Gene, Length, substr(chr, 4) AS chr_label, CAST(floor((start_bp + end_bp) / 2e0 / 1000000) AS BIGINT) AS win_id FROM {genes})
    SELECT chr_label, win_id, count(*) AS n_genes, round(avg(Length), 6) AS mean_score, max(Length) AS max_score, string_agg(DISTINCT Gene, ', ' ORDER BY Gene) AS genes FROM g GROUP BY 1, 2""")
def ag29b(t):
    """Genomic window accumulation of genes."""
    genes = N.with_chromosome_order(t.genes).withColumn("gene_mid", (F.col("start_bp") + F.col("end_bp")) / 2)
    return rounded(N.window_genes(genes, "Length"), ["mean_score"], 6).drop("chr_order", "win_start")


@query("jn18", POS + """, fs AS (SELECT gene, site, max(bayes_factor) AS max_site_bf FROM {fade} WHERE bayes_factor IS NOT NULL GROUP BY gene, site)
    SELECT p.Gene, p.Position, f.max_site_bf, coalesce(f.max_site_bf >= 100, false) AS fade_biased FROM pos p LEFT JOIN fs f ON f.gene = p.Gene AND f.site = p.Position""")
def jn18(t):
    """Positions with site-level Bayes factors."""
    fs = t.fade.where("bayes_factor IS NOT NULL").groupBy(F.col("gene").alias("Gene"), F.col("site").alias("Position")).agg(F.max("bayes_factor").alias("max_site_bf"))
    return pos(t).join(fs, ["Gene", "Position"], "left").select(
        "Gene", "Position", "max_site_bf", F.coalesce(F.col("max_site_bf") >= 100, F.lit(False)).alias("fade_biased"))


@query("ag37", GENE + """, fd AS (SELECT gene, bool_or(bayes_factor >= 100) FILTER (direction = 'top') AS ts, max(bayes_factor) FILTER (direction = 'top') AS tm,
      bool_or(bayes_factor >= 100) FILTER (direction = 'bottom') AS bs, max(bayes_factor) FILTER (direction = 'bottom') AS bm FROM {fade} WHERE bayes_factor IS NOT NULL GROUP BY gene)
    SELECT g.Gene, coalesce(ts, false) AS fade_top_sig, tm AS fade_top_max_bf, coalesce(bs, false) AS fade_bot_sig, bm AS fade_bot_max_bf FROM gc g LEFT JOIN fd ON fd.gene = g.Gene""")
def ag37(t):
    """Gene-level directional Bayes factors with FALSE fill."""
    clean = t.fade.where("bayes_factor IS NOT NULL")
    agg = clean.groupBy(F.col("gene").alias("Gene")).agg(*[
        x for d, n in (("top", "top"), ("bottom", "bot")) for x in (
            F.bool_or(F.when(F.col("direction") == d, F.col("bayes_factor") >= 100)).alias(f"fade_{n}_sig"),
            F.max(F.when(F.col("direction") == d, F.col("bayes_factor"))).alias(f"fade_{n}_max_bf"))])
    return S.gene_scores(pos(t)).select("Gene").join(agg, "Gene", "left").na.fill(False, ["fade_top_sig", "fade_bot_sig"])


