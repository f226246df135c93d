"""Queries: accumulation, enrichment, term overlap and variant annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators.columns import species_names
from sitewise.operators import accumulation as A
from sitewise.operators import enrichment as E
from sitewise.operators import ordering as O
from sitewise.operators import scan as S
from sitewise.operators import variants as V
from sitewise.plans.q_scan import columns, index
from sitewise.plans.registry import query

# ------------------------------------------------------------------ accumulation
_LG = "lgamma({a} + 1) - lgamma({b} + 1) - lgamma({a} - {b} + 1)"

GRID = """
    meta AS (SELECT * FROM {acc_sites} WHERE CAAP_Group <> 'GS0' AND NOT (is_conserved_meta = 'TRUE' AND asr_is_conserved <> 'yes')),
    cnt AS (SELECT gene, position, residue, count(*) AS n FROM {cells} WHERE residue <> '-' GROUP BY 1, 2, 3),
    con AS (SELECT gene, position, max(n) * 1e0 / sum(n) * 100 AS cons FROM cnt GROUP BY 1, 2),
    msk AS (SELECT c.gene, c.position, bool_or(c.residue = '-' AND g.species IS NOT NULL) AS masked
            FROM {cells} c LEFT JOIN {config} g ON g.species = c.species GROUP BY 1, 2),
    ofs AS (SELECT Gene, chr, CAST(coalesce(sum(Length) OVER (ORDER BY CASE chr WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrMT' THEN 25 ELSE CAST(substr(chr, 4) AS INT) END, chr, start_bp, Gene
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM {genes}),
    grid AS (SELECT m.gene, o.off + m.position AS global_pos, o.chr, m.position AS msa_pos, round(coalesce(c.cons, 1e0), 6) AS cons_idx, m.masked,
               EXISTS (SELECT 1 FROM meta s WHERE s.Gene = m.gene AND s.Position = m.position) AS iscaas
             FROM msk m JOIN ofs o ON o.Gene = m.gene LEFT JOIN con c ON c.gene = m.gene AND c.position = m.position)"""


def meta(t):
    return A.metadata(t.acc_sites)


def grid(t):
    idx = index(t)
    target = idx.symbols(species_names(t.config))
    return A.grid(columns(t), t.genes, meta(t), target).withColumn("cons_idx", F.round("cons_idx", 6))


@query("src10", "SELECT CAAP_Group, Gene, Position, tag FROM {acc_sites} WHERE CAAP_Group <> 'GS0' AND NOT (is_conserved_meta = 'TRUE' AND asr_is_conserved <> 'yes')")
def src10(t):
    """Usable accumulation metadata."""
    return meta(t).select("CAAP_Group", "Gene", "Position", "tag")


@query("ca11", "WITH" + GRID + " SELECT gene, global_pos, chr, msa_pos, cons_idx, masked, iscaas FROM grid")
def ca11(t):
    """Accumulation grid."""
    return grid(t).drop("start_bp", "end_bp")


@query("ag31", "WITH" + GRID + " " + " UNION ALL ".join(
    f"SELECT {i} AS Decile, round(quantile_cont(cons_idx, {i / 10}), 6) AS Threshold FROM grid WHERE iscaas" for i in range(1, 10)))
def ag31(t):
    """Conservation deciles among hits."""
    return A.conservation_deciles(grid(t)).withColumn("Threshold", F.round("Threshold", 6))


BINS = [0.0, 40.0, 60.0, 70.0, 80.0, 90.0, 100.0]
_KEY = "1 + " + " + ".join(f"CASE WHEN cons_idx >= {int(b)} THEN 1 ELSE 0 END" for b in BINS[1:-1])


@query("ag32", "WITH" + GRID + f" SELECT {_KEY} AS decile, count(*) AS NumPositions FROM grid WHERE NOT masked GROUP BY 1")
def ag32(t):
    """Conservation histogram of unmasked columns."""
    return A.decile_histogram(grid(t), BINS)


@query("ag32b", "WITH" + GRID + ", h AS (SELECT gene, " + _KEY + " AS k FROM grid WHERE NOT masked) SELECT gene, " + ", ".join(
    f'count(*) FILTER (k = {i}) AS "{i}"' for i in range(1, len(BINS))) + " FROM h GROUP BY gene")
def ag32b(t):
    """Conservation histogram pivoted per gene."""
    return A.decile_histogram(grid(t), BINS, by_gene=True)


MERGED = "WITH" + GRID + """,
    mrg AS (SELECT g.*, s.CAAP_Group, s.change_side, s.is_conserved_meta, s.asr_is_conserved
            FROM grid g LEFT JOIN {acc_sites} s ON s.Gene = g.gene AND s.Position = g.msa_pos)"""
LAW = MERGED + """,
    el AS (SELECT gene, {key} AS bin, count(*) AS e_g FROM mrg WHERE NOT masked GROUP BY 1, 2),
    eb AS (SELECT bin, sum(e_g) AS e FROM el GROUP BY 1),
    hit AS (SELECT gene, {key} AS bin, unnest(['all', lower(CAAP_Group)]) AS category FROM mrg
            WHERE CAAP_Group IS NOT NULL AND change_side <> 'none' AND NOT (is_conserved_meta = 'TRUE' AND asr_is_conserved <> 'yes')),
    dr AS (SELECT category, bin, count(*) AS n FROM hit GROUP BY 1, 2),
    ob AS (SELECT category, gene, count(*) AS actual FROM hit GROUP BY 1, 2),
    pr AS (SELECT dr.category, el.gene, dr.bin, dr.n, el.e_g * 1e0 / eb.e AS p FROM el JOIN eb ON eb.bin = el.bin JOIN dr ON dr.bin = el.bin),
    mo AS (SELECT category, gene, sum(n * p) AS mean_sim, sqrt(sum(n * p * (1 - p))) AS sd_sim FROM pr GROUP BY 1, 2)"""
def law(t, bins=None):
    return A.expected_draws(A.eligible_rows(grid(t), t.acc_sites), F.array(F.lit("all"), F.lower("CAAP_Group")), bins=bins)


@query("jn11", MERGED + " SELECT gene, msa_pos, CAAP_Group, masked FROM mrg")
def jn11(t):
    """Grid left joined to deduplicated sites (fan-out by scheme)."""
    return A.eligible_rows(grid(t), t.acc_sites).select("gene", "msa_pos", "CAAP_Group", "masked")


@query("ca12", LAW.replace("{key}", "0") + """
    SELECT coalesce(m.category, o.category) AS category, coalesce(m.gene, o.gene) AS gene, coalesce(o.actual, 0) AS actual,
           round(coalesce(mean_sim, 0e0), 6) AS mean_sim, round(coalesce(sd_sim, 0e0), 6) AS sd_sim,
           CASE WHEN coalesce(o.actual, 0) = 0 THEN 1e0 WHEN p.p IS NULL THEN 0e0
                ELSE round(1 - (SELECT sum(exp(""" + _LG.replace("{a}", "p.n").replace("{b}", "k") + """ + k * ln(p.p) + (p.n - k) * ln(1 - p.p))) FROM unnest(range(0, o.actual)) AS r(k)), 6) END AS p_exact
    FROM mo m FULL JOIN ob o ON o.category = m.category AND o.gene = m.gene
    LEFT JOIN pr p ON p.category = coalesce(m.category, o.category) AND p.gene = coalesce(m.gene, o.gene)""")
def ca12(t):
    """Accumulation test, exact law of the naive null."""
    return A.exact_test(law(t)).withColumns({c: F.round(c, 6) for c in ("mean_sim", "sd_sim", "p_exact")})


@query("ps09", LAW.replace("{key}", _KEY) + """
    SELECT coalesce(m.category, o.category) AS category, coalesce(m.gene, o.gene) AS gene, coalesce(o.actual, 0) AS actual,
           round(coalesce(mean_sim, 0e0), 6) AS mean_sim, round(coalesce(sd_sim, 0e0), 6) AS sd_sim
    FROM mo m FULL JOIN ob o ON o.category = m.category AND o.gene = m.gene""")
def ps09(t):
    """Moments of the conservation-matched null."""
    return A.exact_test(law(t, BINS)).withColumns({c: F.round(c, 6) for c in ("mean_sim", "sd_sim")}).drop("p_exact")


@query("ca12_mc")
def ca12_mc(t):
    """Monte Carlo counterpart of the accumulation test."""
    return A.monte_carlo(law(t), 2_000, seed=7)


@query("ag30", """WITH a AS (SELECT gene, count(*) AS n, sum(c) AS s, sum(c * c) AS ss, max(hi) AS act FROM {draws} GROUP BY gene),
      g AS (SELECT d.gene, count(*) AS ge FROM {draws} d JOIN a ON a.gene = d.gene AND d.c >= a.act GROUP BY d.gene)
    SELECT a.gene, a.act AS "ActualCount", coalesce(g.ge, 0) AS "RandsAbove", a.n - coalesce(g.ge, 0) AS "RandsBelow",
           round((coalesce(g.ge, 0) + 1) * 1e0 / (a.n + 1), 6) AS "PValueEmpirical", round(a.s * 1e0 / a.n, 6) AS "MeanSim",
           round(sqrt(greatest(a.ss * 1e0 / a.n - (a.s * 1e0 / a.n) * (a.s * 1e0 / a.n), 0e0)), 6) AS "SD", a.n AS "NumRands"
    FROM a LEFT JOIN g ON g.gene = a.gene""")
def ag30(t):
    """Moment merge of partial randomization sums."""
    act = t.draws.groupBy("gene").agg(F.max("hi").alias("actual"))
    d = t.draws.join(act, "gene")
    parts = d.select(F.lit("all").alias("category"), "gene", "actual", F.lit(1).cast("long").alias("n_rands"), F.col("c").alias("sum_c"),
                     (F.col("c") * F.col("c")).cast("double").alias("sum_sq"), (F.col("c") >= F.col("actual")).cast("long").alias("n_ge"))
    out = A.merge_moments(parts).drop("category")
    return out.withColumns({c: F.round(c, 6) for c in ("PValueEmpirical", "MeanSim", "SD")})


@query("snk10", MERGED + """,
    pool AS (SELECT gene, global_pos, coalesce(CAAP_Group, '') AS cg, row_number() OVER (ORDER BY global_pos, gene, coalesce(CAAP_Group, '')) - 1 AS i FROM mrg WHERE NOT masked),
    h AS (SELECT DISTINCT global_pos, concat('t', CAST(global_pos AS VARCHAR)) AS tag FROM mrg WHERE iscaas),
    w AS (SELECT h.*, r.k, (global_pos * 31 + r.k * 17) % (SELECT count(*) FROM pool) AS i FROM h CROSS JOIN (SELECT unnest(range(0, 5)) AS k) r)
    SELECT CAST(w.k AS VARCHAR) AS rand_id, w.global_pos AS caas_position, w.tag, p.global_pos AS randomized_position, p.gene AS randomized_gene
    FROM w JOIN pool p ON p.i = w.i""")
def snk10(t):
    """Explicit randomized positions for export."""
    rows = A.eligible_rows(grid(t), t.acc_sites)
    hits = grid(t).where("iscaas").select("global_pos", F.concat(F.lit("t"), F.col("global_pos").cast("string")).alias("tag")).distinct()
    return A.individual_draws(rows, hits, 5, F.col("global_pos") * 31 + F.col("rand_id") * 17)


# ------------------------------------------------------------------ enrichment
ORA = """
    bg AS (SELECT DISTINCT Gene AS gene FROM {sites}),
    li AS (SELECT DISTINCT gene_list, gene FROM {gene_lists}),
    se AS (SELECT DISTINCT set_name, s.gene FROM {gene_sets} s JOIN bg ON bg.gene = s.gene),
    sz AS (SELECT set_name, count(*) AS size FROM se GROUP BY 1 HAVING count(*) BETWEEN 3 AND 500),
    lz AS (SELECT gene_list, count(*) AS n_list FROM li GROUP BY 1 HAVING count(*) >= 3),
    hit AS (SELECT li.gene_list, se.set_name, sz.size, lz.n_list, count(*) AS overlap FROM li JOIN se ON se.gene = li.gene JOIN sz ON sz.set_name = se.set_name
            JOIN lz ON lz.gene_list = li.gene_list GROUP BY 1, 2, 3, 4),
    hm AS (SELECT hit.*, b.m FROM hit CROSS JOIN (SELECT count(*) AS m FROM bg) b),
    pv AS (SELECT *, least(1e0, (SELECT sum(exp(
        lgamma(size + 1) - lgamma(k + 1) - lgamma(size - k + 1) + lgamma(m - size + 1) - lgamma(n_list - k + 1) - lgamma(m - size - n_list + k + 1)
        - lgamma(m + 1) + lgamma(n_list + 1) + lgamma(m - n_list + 1))) FROM unnest(range(greatest(overlap, n_list - (m - size)), least(size, n_list) + 1)) AS r(k))) AS p_value
      FROM hm)"""


@query("ps14", "WITH" + ORA + " SELECT gene_list, set_name, size, n_list, overlap, round(overlap * 1e0 / (size * 1e0 * n_list / m), 6) AS enrichment_ratio, round(p_value, 6) AS p_value FROM pv")
def ps14(t):
    """Over-representation of gene lists in gene sets."""
    out = E.over_representation(t.gene_lists, t.gene_sets, t.sites.select(F.col("Gene").alias("gene")), min_size=3)
    return out.select("gene_list", "set_name", "size", "n_list", "overlap", F.round("enrichment_ratio", 6).alias("enrichment_ratio"),
                      F.round("p_value", 6).alias("p_value"))


@query("ps15", """WITH r AS (SELECT gene, P, count(*) OVER () AS m, rank() OVER (ORDER BY P) + count(*) OVER (PARTITION BY P) - 1 AS rk FROM {rer})
    SELECT gene, P, round(least(1e0, min(P * m / rk) OVER (ORDER BY P DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS p_adj FROM r""")
def ps15(t):
    """Benjamini-Hochberg adjustment."""
    return O.bh_adjust(t.rer.select("gene", "P"), "P", [], "p_adj").select("gene", "P", F.round("p_adj", 6).alias("p_adj"))


@query("ps16", """WITH st AS (SELECT gene, Rho AS stat FROM {rer}),
    rk AS (SELECT gene, rank() OVER (ORDER BY stat) + (count(*) OVER (PARTITION BY stat) - 1) / 2e0 AS rk FROM st),
    ti AS (SELECT sum(t * t * t - t) * 1e0 AS ties, sum(t) * 1e0 AS n FROM (SELECT count(*) AS t FROM st GROUP BY stat) z),
    pe AS (SELECT set_name, count(*) AS n1, sum(rk) AS r1 FROM {gene_sets} s JOIN rk ON rk.gene = s.gene GROUP BY 1 HAVING count(*) >= 3),
    u AS (SELECT set_name, n1, r1 - n1 * (n1 + 1) / 2e0 AS u, n - n1 AS n2, n, ties FROM pe CROSS JOIN ti)
    SELECT set_name, n1 AS n_genes, round(u / (n1 * n2) - 5e-1, 6) AS stat, round((u - n1 * n2 / 2e0) / sqrt(n1 * n2 / 12e0 * (n + 1 - ties / (n * (n - 1)))), 6) AS z FROM u""")
def ps16(t):
    """Rank-sum gene-set enrichment."""
    out = E.rank_sum_enrichment(t.rer.select("gene", F.col("Rho").alias("stat")), t.gene_sets, 3)
    return out.select("set_name", "n_genes", F.round("stat", 6).alias("stat"), F.round("z", 6).alias("z"))


@query("jn27", "SELECT DISTINCT l.gene_list, l.gene, p.p_partkey AS id FROM {gene_lists} l JOIN {part} p ON concat('G', CAST(p.p_partkey AS VARCHAR)) = l.gene WHERE p.p_partkey % 3 <> 0")
def jn27(t):
    """Symbol to id mapping, unmapped dropped."""
    ids = t.part.where("p_partkey % 3 <> 0").select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("symbol"), F.col("p_partkey").alias("id"))
    return t.gene_lists.join(E.map_symbols(t.gene_lists.select("gene").distinct(), ids), "gene").select("gene_list", "gene", "id")


TERMS = """
    std AS (SELECT gene_list, fdr AS FDR_std, db AS database_std, term AS term_std, round(-log10(greatest(fdr, 22250738585072014e-324)), 6) AS neglog10FDR,
        CASE WHEN gene_list LIKE '%top%' THEN 'top' WHEN gene_list LIKE '%bottom%' THEN 'bottom' ELSE 'global' END AS scenario FROM {terms})"""


def terms(t):
    return E.standard_terms(t.terms)


@query("sc31", "WITH" + TERMS + " SELECT gene_list, term_std, database_std, scenario, neglog10FDR FROM std")
def sc31(t):
    """Term normalisation."""
    return terms(t).select("gene_list", "term_std", "database_std", "scenario", F.round("neglog10FDR", 6).alias("neglog10FDR"))


@query("ag27", "WITH" + TERMS + " SELECT scenario, term_std, database_std, count(DISTINCT gene_list) AS n_lists, min(FDR_std) AS best_fdr, round(avg(FDR_std), 9) AS mean_fdr FROM std GROUP BY 1, 2, 3")
def ag27(t):
    """Term recurrence across lists."""
    return E.term_recurrence(terms(t)).withColumn("mean_fdr", F.round("mean_fdr", 9))


TOP = "WITH" + TERMS + ", top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene_list ORDER BY FDR_std, term_std, database_std) AS rn FROM std) z WHERE rn <= 50)"


@query("wn14", TOP + " SELECT gene_list, term_std FROM top")
def wn14(t):
    """Top terms per list."""
    return E.top_terms(terms(t), 50).select("gene_list", "term_std")


_OVL = TOP + """, mem AS (SELECT DISTINCT gene_list, term_std FROM top), sz AS (SELECT gene_list, count(*) AS n FROM mem GROUP BY 1),
    ix AS (SELECT a.gene_list AS x, b.gene_list AS y, count(*) AS n FROM mem a JOIN mem b ON b.term_std = a.term_std GROUP BY 1, 2)
    SELECT a.gene_list AS gene_list_x, b.gene_list AS gene_list_y, round(coalesce(ix.n, 0) * 1e0 / {den}, 6) AS overlap
    FROM sz a CROSS JOIN sz b LEFT JOIN ix ON ix.x = a.gene_list AND ix.y = b.gene_list"""


@query("se02", _OVL.replace("{den}", "least(a.n, b.n)"))
def se02(t):
    """Overlap-coefficient matrix of term sets."""
    return E.term_overlap_matrix(E.top_terms(terms(t), 50)).withColumn("overlap", F.round("overlap", 6))


@query("se02_jaccard", _OVL.replace("{den}", "(a.n + b.n - coalesce(ix.n, 0))"))
def se02_jaccard(t):
    """Jaccard matrix of term sets."""
    return E.term_overlap_matrix(E.top_terms(terms(t), 50), "jaccard").withColumn("overlap", F.round("overlap", 6))


@query("se03", "WITH" + TERMS + ", mem AS (SELECT DISTINCT gene_list, term_std FROM std) SELECT a.gene_list AS from_list, b.gene_list AS to_list, count(*) AS n_shared FROM mem a JOIN mem b ON b.term_std = a.term_std AND a.gene_list < b.gene_list GROUP BY 1, 2")
def se03(t):
    """Shared-term edges between lists."""
    return E.shared_term_edges(terms(t))


@query("se10", "SELECT gene FROM {gene_lists} WHERE gene_list LIKE 'caas_top_%' UNION SELECT gene FROM {fade} WHERE direction = 'top' AND bayes_factor >= 150")
def se10(t):
    """Union of gene sets of one direction."""
    a = t.gene_lists.where("gene_list LIKE 'caas_top_%'").select("gene")
    b = t.fade.where("direction = 'top' AND bayes_factor >= 150").select("gene")
    return a.union(b).distinct()


# ------------------------------------------------------------------ variants
def _char_sets(i: int) -> str:
    same = f"(CASE WHEN CAAP_Group = 'US' THEN substr(caas, {i}, 1) = substr(caas, {i + 4}, 1) ELSE substr(amino_encoded, {i}, 1) = substr(amino_encoded, {i + 4}, 1) END)"
    return f"CASE WHEN NOT {same} THEN substr(caas, {{o}} + {i}, 1) END"


def _side(o: int) -> str:
    return "list_sort(list_distinct(list_filter([" + ", ".join(_char_sets(i).replace("{o}", str(o)) for i in (1, 2, 3)) + "], lambda x: x IS NOT NULL)))"


LET = f"""
    qs AS (SELECT *, {_side(0)} AS tp, {_side(4)} AS bt FROM {{queries}}),
    le AS (SELECT *, CASE change_side WHEN 'top' THEN bt WHEN 'bottom' THEN tp ELSE [] END AS anc,
                  CASE change_side WHEN 'top' THEN tp WHEN 'bottom' THEN bt ELSE list_sort(list_distinct(list_concat(tp, bt))) END AS der FROM qs)"""


@query("sc10", "WITH" + LET + " SELECT query, CAAP_Group, array_to_string(anc, '') AS anc, array_to_string(der, '') AS der FROM le")
def sc10(t):
    """Pair-aware ancestral and derived letters."""
    a, d = V.letter_sets(F.col("caas"), F.col("amino_encoded"), F.col("change_side"), F.col("CAAP_Group"))
    return t.queries.select("query", "CAAP_Group", F.array_join(a, "").alias("anc"), F.array_join(d, "").alias("der"))


ANN = "WITH" + LET + """,
    en AS (SELECT query, Gene, Position, CAAP_Group, substr(coord, length(coord), 1) AS ref, anc, CASE WHEN len(list_filter(der, lambda x: x <> substr(coord, length(coord), 1))) > 0
             THEN list_filter(der, lambda x: x <> substr(coord, length(coord), 1)) ELSE der END AS alt,
             concat('chr', CAST(1 + CAST(substr(Gene, 2) AS BIGINT) % 3 AS VARCHAR)) AS chrom, CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3 AS st,
             CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3 + CASE WHEN Position % 4 = 0 THEN 0 ELSE 2 END AS ed FROM le),
    an AS (SELECT query, ref AS hg38_ref_aa, array_to_string(alt, '') AS caas_alt_aas, CAAP_Group AS caap_group,
             CASE CAAP_Group WHEN 'US' THEN 5e-1 WHEN 'GS4' THEN 2e-1 WHEN 'GS0' THEN 0e0 ELSE 1e-1 END AS scheme_weight, v.*
           FROM en JOIN {variants} v ON v.chr = en.chrom AND v.pos BETWEEN en.st AND en.ed AND v.ref_aa = en.ref
           WHERE list_contains(alt, v.alt_aa) AND (len(anc) = 0 OR list_contains(anc, ref)))"""


def annotated(t):
    return V.annotate(t.variants, t.queries)


@query("jn19", ANN + " SELECT query, hg38_ref_aa, caas_alt_aas, caap_group, scheme_weight, chr, pos, alt_aa, score FROM an")
def jn19(t):
    """Variant probe of codon ranges."""
    return annotated(t).select("query", "hg38_ref_aa", "caas_alt_aas", "caap_group", "scheme_weight", "chr", "pos", "alt_aa", "score")


PAI = ANN + """,
    pm AS (SELECT query, caap_group, max(score) AS m FROM an WHERE score IS NOT NULL AND scheme_weight > 0 GROUP BY 1, 2),
    pp AS (SELECT query, avg(m) AS pai_char_score, count(*) AS n_pai_schemes FROM pm GROUP BY 1)"""


def pai(t):
    return V.protein_score(annotated(t))


@query("ag28", PAI + " SELECT query, round(pai_char_score, 6) AS pai_char_score, n_pai_schemes FROM pp")
def ag28(t):
    """Protein score: maximum per scheme, then mean."""
    return pai(t).withColumn("pai_char_score", F.round("pai_char_score", 6))


POSM = PAI + """,
    pmap AS (SELECT DISTINCT Gene, Position, query FROM {queries}),
    mt AS (SELECT Gene, Position, min(change_side) AS change_side, min(Pvalue) AS Pvalue FROM {sites} GROUP BY 1, 2),
    ps AS (SELECT m.Gene, m.Position, m.query, p.pai_char_score, p.n_pai_schemes, mt.change_side, mt.Pvalue FROM pmap m JOIN pp p ON p.query = m.query JOIN mt ON mt.Gene = m.Gene AND mt.Position = m.Position)"""


def pos_pai(t):
    pmap = t.queries.select("Gene", "Position", "query").distinct()
    mt = t.sites.groupBy("Gene", "Position").agg(F.min("change_side").alias("change_side"), F.min("Pvalue").alias("Pvalue"))
    return V.position_scores(pai(t), pmap, mt)


@query("jn20", "SELECT DISTINCT q.query, s.tag, s.CAAP_Group FROM {queries} q JOIN {acc_sites} s ON s.Gene = q.Gene AND s.Position = q.Position AND s.CAAP_Group = q.CAAP_Group")
def jn20(t):
    """Tag to site to query chain."""
    return t.acc_sites.join(t.queries, ["Gene", "Position", "CAAP_Group"]).select("query", "tag", "CAAP_Group").distinct()


@query("jn21", POSM + " SELECT Gene, Position, query, round(pai_char_score, 6) AS pai_char_score, change_side FROM ps")
def jn21(t):
    """Protein scores mapped to sites with metadata."""
    return pos_pai(t).select("Gene", "Position", "query", F.round("pai_char_score", 6).alias("pai_char_score"), "change_side")


@query("ag38", POSM + " SELECT Gene, count(*) AS n_pai_positions, round(avg(pai_char_score), 6) AS mean_pai_char, round(sum(pai_char_score), 6) AS sum_pai_char FROM ps WHERE Gene IN (SELECT Gene FROM {genes}) GROUP BY Gene")
def ag38(t):
    """Gene-level protein scores."""
    out = V.gene_scores(pos_pai(t), t.genes.select("Gene"))
    return out.select("Gene", "n_pai_positions", F.round("mean_pai_char", 6).alias("mean_pai_char"), F.round("sum_pai_char", 6).alias("sum_pai_char"))


@query("ps13", """WITH d AS (SELECT *, value > (SELECT quantile_cont(value, 0.5) FROM {events}) AS high FROM {events})
    SELECT 'TOP' AS direction, 'v50' AS threshold, count(*) FILTER (user_id % 2 = 0) AS n_top, count(*) FILTER (user_id % 2 = 0 AND high) AS n_top_high FROM d
    UNION ALL SELECT 'TOP', 'v10', count(*) FILTER (user_id % 10 = 0), count(*) FILTER (user_id % 10 = 0 AND high) FROM d""")
def ps13(t):
    """2x2 counts per threshold with Fisher's exact test."""
    return fisher(t).select("direction", "threshold", "n_top", "n_top_high")


@query("ps13_test")
def ps13_test(t):
    """Odds ratio and exact p of the same tables."""
    return fisher(t)


def fisher(t):
    med = O.quantiles(t.events, [], "value", {"med": 0.5})
    df = O.attach_scalars(t.events, med).withColumn("high", F.col("value") > F.col("med"))
    return E.fisher_by_threshold(df, "TOP", {"v50": F.col("user_id") % 2 == 0, "v10": F.col("user_id") % 10 == 0})
