"""Queries over the alignment columns: scan, background, bootstrap, conservation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators.columns import species_names
from sitewise.functions import patterns as P
from sitewise.functions.pvalue import site_pvalue, symbol_counts
from sitewise.functions.schemes import PARTITIONS, RESIDUES, codes
from sitewise.operators import scan as S
from sitewise.operators.columns import (
    SpeciesIndex,
    column_filter,
    columns_from_cells,
    columns_from_sequences,
    conservation,
    masked,
)
from sitewise.plans.registry import query

LIMITS = S.Limits(fg_gaps=1, bg_gaps=1, fg_miss=3, bg_miss=3)


def index(t) -> SpeciesIndex:
    if "index" not in t.__dict__:
        t.__dict__["index"] = SpeciesIndex.of(t.species)
    return t.__dict__["index"]


def columns(t):
    return columns_from_cells(t.cells, index(t))


# ------------------------------------------------------------------ oracle pieces
# One row per column with the ungapped residues of both sides in pair order.
SIDES = """
    WITH colstat AS (
      SELECT gene, position, count(*) AS n_all, sum(CASE WHEN residue = '-' THEN 1 ELSE 0 END) AS n_gap
      FROM {cells} GROUP BY gene, position),
    sym AS (
      SELECT gene, position, residue, count(*) AS n FROM {cells} WHERE residue <> '-' GROUP BY gene, position, residue),
    kept AS (
      SELECT c.gene, c.position FROM colstat c
      JOIN (SELECT gene, position, sum(n) - max(n) AS minor FROM sym GROUP BY gene, position) m
        ON m.gene = c.gene AND m.position = c.position
      WHERE c.n_gap * 1e0 / c.n_all <= 5e-1 AND m.minor >= 1),
    sides AS (
      SELECT k.gene, k.position,
        coalesce(string_agg(residue, '' ORDER BY pair, g.species) FILTER (grp = 1 AND residue NOT IN ('-','X')), '') AS fg,
        coalesce(string_agg(residue, '' ORDER BY pair, g.species) FILTER (grp = 0 AND residue NOT IN ('-','X')), '') AS bg,
        coalesce(string_agg(g.species, ',' ORDER BY pair, g.species) FILTER (grp = 1 AND residue NOT IN ('-','X')), '') AS ffg,
        coalesce(string_agg(g.species, ',' ORDER BY pair, g.species) FILTER (grp = 0 AND residue NOT IN ('-','X')), '') AS fbg,
        string_agg(g.species, ',' ORDER BY grp DESC, pair, g.species) FILTER (residue IS NULL) AS ms,
        count(*) FILTER (grp = 1 AND residue IN ('-','X')) AS gfg, count(*) FILTER (grp = 0 AND residue IN ('-','X')) AS gbg,
        count(*) FILTER (grp = 1 AND residue IS NULL) AS mfg, count(*) FILTER (grp = 0 AND residue IS NULL) AS mbg,
        count(*) FILTER (grp = 1 AND residue <> '-') AS sfg, count(*) FILTER (grp = 0 AND residue <> '-') AS sbg
      FROM kept k CROSS JOIN {config} g
      LEFT JOIN {cells} c ON c.gene = k.gene AND c.position = k.position AND c.species = g.species
      GROUP BY k.gene, k.position),
    tested AS (
      SELECT * FROM sides WHERE sfg > 0 AND sbg > 0 AND gfg <= 1 AND gbg <= 1 AND mfg <= 3 AND mbg <= 3)"""

SCHEMES_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS scheme, '{codes(s)}' AS codes" for s in PARTITIONS
)

TEST = """
    , schemes AS (""" + SCHEMES_SQL + f"""),
    coded AS (
      SELECT t.*, scheme, codes, translate(regexp_replace(fg, '[^{RESIDUES}]', '', 'g'), '{RESIDUES}', codes) AS efg,
             translate(regexp_replace(bg, '[^{RESIDUES}]', '', 'g'), '{RESIDUES}', codes) AS ebg
      FROM tested t CROSS JOIN schemes),
    counted AS (
      SELECT *, length(translate(efg, ebg, '')) AS ofg, length(translate(ebg, efg, '')) AS obg FROM coded),
    classed AS (
      SELECT *, CASE WHEN efg = '' OR ebg = '' THEN 'null'
        WHEN replace(efg, substr(efg,1,1), '') = '' AND replace(ebg, substr(ebg,1,1), '') = '' THEN '1'
        WHEN replace(efg, substr(efg,1,1), '') = '' THEN '2'
        WHEN replace(ebg, substr(ebg,1,1), '') = '' THEN '3' ELSE '4' END AS pattern,
        least(length(efg) - ofg, length(ebg) - obg) AS overlap
      FROM counted),
    hits AS (
      SELECT * FROM classed WHERE overlap <= {{tol}} AND (ofg >= 2 OR obg >= 2) AND pattern IN ('1','2','3'))"""

# C(n, k) for non-negative n, as a double.
_C = "(CASE WHEN {n} < {k} THEN 0e0 ELSE CAST(factorial(CAST({n} AS INT)) AS DOUBLE) / CAST(factorial(CAST({k} AS INT)) AS DOUBLE) / CAST(factorial(CAST({n} - {k} AS INT)) AS DOUBLE) END)"


def _c(n: str, k: str) -> str:
    return _C.replace("{n}", f"({n})").replace("{k}", f"({k})")


PVALUE = f"""
    , freq AS (
      SELECT h.gene, h.position, h.scheme, length(h.fg) AS f, length(h.bg) AS b,
             translate(s.residue, '{RESIDUES}', h.codes) AS sym, sum(s.n) AS n
      FROM hits h JOIN sym s ON s.gene = h.gene AND s.position = h.position
      GROUP BY h.gene, h.position, h.scheme, length(h.fg), length(h.bg), translate(s.residue, '{RESIDUES}', h.codes)),
    tot AS (SELECT gene, position, scheme, sum(n) AS m, count(*) AS k FROM freq GROUP BY gene, position, scheme),
    parts AS (
      SELECT q.gene, q.position, q.scheme, q.f, q.b, t.k,
             {_c('q.n','q.f')} / {_c('t.m','q.f')} AS f_one, {_c('t.m - q.n','q.f')} / {_c('t.m','q.f')} AS f_rest,
             {_c('q.n','q.b')} / {_c('t.m - q.f','q.b')} AS b_one, {_c('t.m - q.n','q.b')} / {_c('t.m - q.f','q.b')} AS b_rest
      FROM freq q JOIN tot t ON t.gene = q.gene AND t.position = q.position AND t.scheme = q.scheme),
    pv AS (
      SELECT gene, position, scheme,
        CASE WHEN max(k) < 2 THEN NULL WHEN max(f) = max(b) THEN sum(f_one * b_rest)
             WHEN max(k) > 2 THEN sum(f_one * b_rest) + sum(f_rest * b_one) - (sum(f_one) * sum(b_one) - sum(f_one * b_one))
             ELSE sum(f_one * b_rest) + sum(f_rest * b_one) END AS pvalue
      FROM parts GROUP BY gene, position, scheme)"""

_OUT = """
    SELECT h.gene AS Gene, '{mode}' AS Mode, h.scheme AS CAAP_Group, 'trait' AS Trait, h.position AS Position,
           concat(h.fg, '/', h.bg) AS Substitution, {enc} round(p.pvalue, 9) AS Pvalue, h.pattern AS Pattern,
           CAST(length(h.fg) AS INT) AS FFGN, CAST(length(h.bg) AS INT) AS FBGN,
           CAST(gfg AS INT) AS GFG, CAST(gbg AS INT) AS GBG, CAST(mfg AS INT) AS MFG, CAST(mbg AS INT) AS MBG,
           ffg AS FFG, fbg AS FBG, coalesce(ms, '{none}') AS MS
    FROM hits h JOIN pv p ON p.gene = h.gene AND p.position = h.position AND p.scheme = h.scheme"""


def _hits(tol: int = 0) -> str:
    return SIDES + TEST.replace("{tol}", str(tol))


def _tested(t):
    return S.tested_columns(column_filter(columns(t)), S.load_contrasts(t.config), index(t), LIMITS)


def _discovery(t, **kw):
    return S.discover(_tested(t), **kw)


@query("ca06", _hits() + PVALUE + _OUT.format(mode="CAAP", none="NA", enc="concat(h.efg, '/', h.ebg) AS Encoded,"))
def ca06(t):
    """Discovery under the six residue schemes."""
    return _discovery(t).withColumn("Pvalue", F.round("Pvalue", 9))


@query("ca04", _hits() + PVALUE + _OUT.format(mode="CAAS", none="-", enc="") + " WHERE h.scheme = 'US'")
def ca04(t):
    """Classical residue-level discovery."""
    return _discovery(t, mode="CAAS").withColumn("Pvalue", F.round("Pvalue", 9))


@query("ca05", _hits(1) + """
    SELECT gene AS Gene, position AS Position, scheme AS CAAP_Group, concat(efg, '/', ebg) AS Encoded, pattern AS Pattern,
           overlap > 0 AS ConservedPair,
           concat(CAST(overlap AS VARCHAR), ':', coalesce((
             SELECT string_agg(CAST(g.pair AS VARCHAR), ',' ORDER BY i)
             FROM (SELECT unnest(range(1, 6)) AS i) r JOIN {config} g ON g.species = string_split(ffg, ',')[i]
             WHERE i <= least(length(efg), length(ebg)) AND substr(efg, i, 1) = substr(ebg, i, 1)), '')) AS ConservedPairs
    FROM hits""")
def ca05(t):
    """Property scan with overlap tolerance 1 and its conserved pair list."""
    return _discovery(t, max_conserved=1).select(
        "Gene", "Position", "CAAP_Group", "Encoded", "Pattern", "ConservedPair", "ConservedPairs"
    )


@query("ca01", SIDES + """
    SELECT gene, position, fg, bg, CAST(gfg AS INT) AS gfg, CAST(gbg AS INT) AS gbg, CAST(mfg AS INT) AS mfg,
           CAST(mbg AS INT) AS mbg FROM sides""")
def ca01(t):
    """Per-column sides: ungapped residues, gap and missing counts."""
    from sitewise.operators.scan import contrast_table, read_sides

    kept = column_filter(columns(t))
    df = read_sides(kept.select("*", F.inline(contrast_table(S.load_contrasts(t.config), index(t)))))
    return df.select(
        "gene", "position", "fg", "bg", F.col("GFG").alias("gfg"), F.col("GBG").alias("gbg"),
        F.col("MFG").alias("mfg"), F.col("MBG").alias("mbg"),
    )


@query("ca02", _hits() + "SELECT gene, position, fg, bg, pattern, overlap <= 0 AND (ofg >= 2 OR obg >= 2) AS caas FROM classed WHERE scheme = 'US'")
def ca02(t):
    """Strict divergence test and pattern class per tested column."""
    fg, bg = F.col("fg"), F.col("bg")
    return _tested(t).select("gene", "position", "fg", "bg", P.pattern_class(fg, bg).alias("pattern"), P.diverges(fg, bg).alias("caas"))


@query("ca03", _hits() + "SELECT scheme, pattern, overlap <= 0 AND (ofg >= 2 OR obg >= 2) AS caap, count(*) AS n FROM classed WHERE fg <> '' AND bg <> '' GROUP BY 1, 2, 3")
def ca03(t):
    """Property test counts per scheme and pattern class."""
    from sitewise.functions.schemes import encode, scheme_table

    df = _tested(t).where("fg <> '' AND bg <> ''").select("*", F.inline(scheme_table()))
    efg, ebg = encode(F.col("fg"), F.col("codes")), encode(F.col("bg"), F.col("codes"))
    return df.select("scheme", P.pattern_class(efg, ebg).alias("pattern"), P.diverges(efg, ebg).alias("caap")).groupBy(
        "scheme", "pattern", "caap").agg(F.count(F.lit(1)).alias("n"))


@query("flt01", SIDES + "SELECT gene, position FROM kept")
def flt01(t):
    """Column pre-filter."""
    return column_filter(columns(t)).select("gene", "position")


@query("flt02", SIDES + "SELECT gene, count(*) AS n_tested FROM tested GROUP BY gene")
def flt02(t):
    """Gap and missing caps: tested columns per gene."""
    return _tested(t).groupBy("gene").agg(F.count(F.lit(1)).alias("n_tested"))


@query("flt03", SIDES + """
    , prs AS (
      SELECT k.gene, k.position,
        string_agg(DISTINCT CAST(pair AS VARCHAR), ',' ORDER BY CAST(pair AS VARCHAR)) FILTER (grp = 1 AND residue IS NULL) AS mf,
        string_agg(DISTINCT CAST(pair AS VARCHAR), ',' ORDER BY CAST(pair AS VARCHAR)) FILTER (grp = 0 AND residue IS NULL) AS mb,
        string_agg(DISTINCT CAST(pair AS VARCHAR), ',' ORDER BY CAST(pair AS VARCHAR)) FILTER (grp = 1 AND residue IN ('-','X')) AS gf,
        string_agg(DISTINCT CAST(pair AS VARCHAR), ',' ORDER BY CAST(pair AS VARCHAR)) FILTER (grp = 0 AND residue IN ('-','X')) AS gb
      FROM kept k CROSS JOIN {config} g
      LEFT JOIN {cells} c ON c.gene = k.gene AND c.position = k.position AND c.species = g.species
      GROUP BY k.gene, k.position)
    SELECT t.gene, t.position FROM tested t JOIN prs p ON p.gene = t.gene AND p.position = t.position
    WHERE (mf IS NULL OR mb IS NULL OR mf = mb) AND (gf IS NULL OR gb IS NULL OR gf = gb)""")
def flt03(t):
    """Pair-aware rule: both sides missing (or gapped) only in the same pairs."""
    lim = S.Limits(fg_gaps=1, bg_gaps=1, fg_miss=3, bg_miss=3, pair_aware=True)
    return S.tested_columns(column_filter(columns(t)), S.load_contrasts(t.config), index(t), lim).select("gene", "position")


@query("snk02", SIDES + """
    SELECT g.gene, coalesce(p.positions, 'NULL') AS positions
    FROM (SELECT DISTINCT gene FROM {cells}) g
    LEFT JOIN (SELECT gene, string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS positions
               FROM tested GROUP BY gene) p ON p.gene = g.gene""")
def snk02(t):
    """Tested-position background, rendered as it is written."""
    from sitewise.sinks.tables import render_background

    return render_background(S.background(_tested(t), t.cells))


@query("ps01", SIDES + f"""
    SELECT s.gene, s.position, s.residue,
           round({_c('s.n', '2')} / {_c('m.m', '2')}, 9) AS p
    FROM sym s JOIN (SELECT gene, position, sum(n) AS m FROM sym GROUP BY gene, position) m
      ON m.gene = s.gene AND m.position = s.position WHERE m.m >= 2""")
def ps01(t):
    """Probability that two drawn sequences both carry a given symbol."""
    from sitewise.functions.pvalue import choose_ratio

    text = F.replace("residues", F.lit("-"), F.lit(""))
    df = columns(t).withColumn("text", text).where("length(text) >= 2")
    df = df.withColumn("residue", F.explode(F.filter(F.array_distinct(F.split("text", "")), lambda s: s != "")))
    n = F.length("text") - F.length(F.replace("text", F.col("residue"), F.lit("")))
    return df.select("gene", "position", "residue", F.round(choose_ratio(n, F.length("text"), F.lit(2)), 9).alias("p"))


@query("ps02", _hits() + PVALUE + " SELECT gene, position, scheme, round(pvalue, 9) AS pvalue FROM pv")
def ps02(t):
    """Closed-form site p-value."""
    return _discovery(t).select(
        F.col("Gene").alias("gene"), F.col("Position").alias("position"),
        F.col("CAAP_Group").alias("scheme"), F.round("Pvalue", 9).alias("pvalue"),
    )


RESAMPLE_SETS = """
    SELECT cycle, string_agg(species, ',' ORDER BY species) FILTER (rk <= 4) AS fg,
           string_agg(species, ',' ORDER BY species) FILTER (rk > 4) AS bg
    FROM {resamples} GROUP BY cycle"""


def resample_sets(t):
    return t.resamples.groupBy("cycle").agg(
        F.array_sort(F.collect_list(F.when(F.col("rk") <= 4, F.col("species")))).alias("fg"),
        F.array_sort(F.collect_list(F.when(F.col("rk") > 4, F.col("species")))).alias("bg"),
    )


BOOT = _hits() + """
    , want AS (SELECT gene, position, scheme, codes FROM hits),
    memb AS (
      SELECT w.gene, w.position, w.scheme, r.cycle,
        coalesce(string_agg(translate(c.residue, '""" + RESIDUES + """', w.codes), '') FILTER (rk <= 4 AND residue NOT IN ('-','X')), '') AS f,
        coalesce(string_agg(translate(c.residue, '""" + RESIDUES + """', w.codes), '') FILTER (rk > 4 AND residue NOT IN ('-','X')), '') AS b,
        count(*) FILTER (rk <= 4 AND residue IN ('-','X')) AS gfg, count(*) FILTER (rk > 4 AND residue IN ('-','X')) AS gbg
      FROM want w CROSS JOIN {resamples} r
      LEFT JOIN {cells} c ON c.gene = w.gene AND c.position = w.position AND c.species = r.species
      GROUP BY w.gene, w.position, w.scheme, r.cycle),
    tst AS (
      SELECT *, length(translate(f, b, '')) AS of_, length(translate(b, f, '')) AS ob_,
        CASE WHEN f = '' OR b = '' THEN 'null'
          WHEN replace(f, substr(f,1,1), '') = '' OR replace(b, substr(b,1,1), '') = '' THEN '123' ELSE '4' END AS pat
      FROM memb),
    hit AS (
      SELECT *, CASE WHEN gfg <= 1 AND gbg <= 1 AND pat = '123' AND least(length(f) - of_, length(b) - ob_) <= 0
                      AND (of_ >= 2 OR ob_ >= 2) THEN 1 ELSE 0 END AS h
      FROM tst)"""
BOOT_LIMITS = S.Limits(fg_gaps=1, bg_gaps=1)


@query("ca07", BOOT + """
    SELECT gene AS Gene, position AS Position, scheme AS CAAP_Group, CAST(sum(h) AS BIGINT) AS Occurrences,
           count(*) AS Total, round(sum(h) * 1e0 / count(*), 9) AS Pvalue_boot
    FROM hit GROUP BY gene, position, scheme""")
def ca07(t):
    """Discovery-guided bootstrap with zero counts kept."""
    out = S.bootstrap(columns(t), _discovery(t), resample_sets(t), index(t), BOOT_LIMITS)
    return out.withColumn("Pvalue_boot", F.round("Pvalue_boot", 9))


@query("ca08", BOOT + "SELECT cycle, gene AS Gene, position AS Position, scheme AS CAAP_Group FROM hit WHERE h = 1")
def ca08(t):
    """Per-cycle hits."""
    hits = S.bootstrap_hits(columns(t), _discovery(t), resample_sets(t), index(t), BOOT_LIMITS)
    return hits.select("cycle", "Gene", "Position", "CAAP_Group")


@query("src06", RESAMPLE_SETS)
def src06(t):
    """Resample sets in their comma-list form."""
    return resample_sets(t).select("cycle", F.array_join("fg", ",").alias("fg"), F.array_join("bg", ",").alias("bg"))


@query("ag01", SIDES + """
    SELECT c.gene, c.position, round(coalesce(m.mx * 1e0 / m.tot * 100, 1e0), 6) AS cons_idx
    FROM colstat c LEFT JOIN (SELECT gene, position, max(n) AS mx, sum(n) AS tot FROM sym GROUP BY gene, position) m
      ON m.gene = c.gene AND m.position = c.position""")
def ag01(t):
    """Conservation index per column."""
    return conservation(columns(t)).select("gene", "position", F.round("cons_idx", 6).alias("cons_idx"))


@query("ag02", "SELECT c.gene, c.position, bool_or(c.residue = '-' AND g.species IS NOT NULL) AS masked FROM {cells} c LEFT JOIN {config} g ON g.species = c.species GROUP BY c.gene, c.position")
def ag02(t):
    """Columns masked by a gap in a contrast species."""
    idx = index(t)
    target = idx.symbols(species_names(t.config))
    return masked(columns(t), target).select("gene", "position", "masked")


@query("src01", "SELECT gene, position, string_agg(residue, '' ORDER BY species) AS residues FROM {cells} GROUP BY gene, position")
def src01(t):
    """Aligned sequences re-read as columns through the block-wise path."""
    width = 20
    filled = t.cells.groupBy("gene", "species").agg(
        F.map_from_entries(F.collect_list(F.struct("position", "residue"))).alias("m")
    )
    cell = lambda i: F.coalesce(F.try_element_at("m", i), F.lit("~"))
    seqs = filled.select("gene", "species", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), cell), "").alias("seq"))
    cols = columns_from_sequences(seqs, index(t), block=8)
    return cols.select("gene", "position", F.replace("residues", F.lit("~"), F.lit("")).alias("residues")).where("residues <> ''")


@query("wn12", SIDES + "SELECT gene, position, ffg, fbg FROM tested")
def wn12(t):
    """Side members in pair order."""
    return _tested(t).select("gene", "position", F.array_join(S._kept_names("fg"), ",").alias("ffg"), F.array_join(S._kept_names("bg"), ",").alias("fbg"))
