"""Queries: ancestral states, change classification, robustness, selection summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitewise.operators.columns import species_names
from sitewise.functions import labels as L
from sitewise.functions.schemes import PARTITIONS, RESIDUES, codes
from sitewise.operators import disambiguation as D
from sitewise.operators import permutation as PM
from sitewise.operators import postproc as P
from sitewise.operators import scan as S
from sitewise.operators import selection as X
from sitewise.plans.registry import query
from sitewise.session import shared_folder
from sitewise.sinks.store import ResultStore, master_table, write_master


def rnd(*cols, digits=6):
    return [F.round(c, digits).alias(c) for c in cols]


MET = """mt AS (SELECT gene, node_id, site, max(p) AS map_, max(p) - coalesce((array_agg(p ORDER BY p DESC))[2], 0e0) AS margin,
      -sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0e0 END) AS entropy FROM {posteriors} GROUP BY 1, 2, 3)"""


@query("ps22", "WITH " + MET + ' SELECT gene, node_id, site, map_ AS "MAP", round(margin, 6) AS margin, round(entropy, 6) AS entropy FROM mt')
def ps22(t):
    """MAP, margin and entropy of node posteriors."""
    return D.posterior_metrics(t.posteriors).select("gene", "node_id", "site", "MAP", *rnd("margin", "entropy"))


MOD = "mo AS (SELECT gene, node_id, site, aa AS state, p AS prob FROM (SELECT *, row_number() OVER (PARTITION BY gene, node_id, site ORDER BY p DESC, aa) AS rn FROM {posteriors}) z WHERE rn = 1)"


@query("tr07", "WITH " + MOD + " SELECT * FROM mo")
def tr07(t):
    """Modal state per node and site."""
    return D.modal_states(t.posteriors)


NODES = [("root", 100), ("mrca_contrast", 101), ("focal_1", 102), ("focal_2", 100)]
_NODES_SQL = " UNION ALL ".join(f"SELECT '{r}' AS role, {n} AS node_id" for r, n in NODES)


@query("tr08", "WITH " + MOD + ", nd AS (" + _NODES_SQL + """), j AS (SELECT mo.*, role FROM mo JOIN nd ON nd.node_id = mo.node_id),
    a AS (SELECT gene, site, max(state) FILTER (role = 'root') AS root, max(state) FILTER (role = 'mrca_contrast') AS mrca_contrast,
      max(state) FILTER (role = 'focal_1') AS f1, max(state) FILTER (role = 'focal_2') AS f2,
      coalesce(string_agg(role, ',' ORDER BY role) FILTER (prob < 7e-1), '') AS low_confidence_nodes FROM j GROUP BY 1, 2)
    SELECT * FROM a WHERE root IS NOT NULL AND mrca_contrast IS NOT NULL""")
def tr08(t):
    """Node states with the low-confidence list."""
    nodes = t.spark.createDataFrame(NODES, "role string, node_id int")
    out = D.node_states(D.modal_states(t.posteriors), nodes)
    return out.select("gene", "site", "root", "mrca_contrast", F.try_element_at("focal_states", F.lit("focal_1")).alias("f1"),
                      F.try_element_at("focal_states", F.lit("focal_2")).alias("f2"), "low_confidence_nodes")


@query("tr11", """SELECT concat('G', CAST(l_partkey AS VARCHAR)) AS gene, CAST(l_orderkey % 500 AS INT) AS site, l_returnflag AS grp,
      arg_min(r, ix) FILTER (r NOT IN ('-', 'X')) AS residue
    FROM (SELECT *, l_suppkey * 10 + l_linenumber AS ix, CASE WHEN l_suppkey % 4 = 0 THEN '-' ELSE substr('ACDXG', CAST(1 + (l_suppkey * 10 + l_linenumber) % 5 AS INT), 1) END AS r FROM {lineitem}) z GROUP BY 1, 2, 3""")
def tr11(t):
    """First resolved tip residue in group order."""
    ix = F.col("l_suppkey") * 10 + F.col("l_linenumber")
    rec = t.lineitem.select(
        F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene"), (F.col("l_orderkey") % 500).cast("int").alias("site"),
        F.col("l_returnflag").alias("grp"), ix.alias("idx"),
        F.when(F.col("l_suppkey") % 4 == 0, "-").otherwise(F.substr(F.lit("ACDXG"), (1 + ix % 5).cast("int"), F.lit(1))).alias("residue"))
    return D.tip_residue(rec)


def _chg(tip: str, anc: str = "focal_state") -> str:
    return f"{anc} IS NOT NULL AND {anc} NOT IN ('-','X','?') AND {tip} IS NOT NULL AND {tip} NOT IN ('-','X','?') AND {anc} <> {tip}"


def _cls(a: str) -> str:
    return f"CASE WHEN n_pairs < 2 OR n_{a} = 0 THEN 'no_change' WHEN n_{a} = 1 THEN 'ambiguous' WHEN k_{a} = 1 THEN 'convergent' WHEN k_{a} < n_{a} THEN 'codivergent' ELSE 'divergent' END"


_SUB = "('convergent','codivergent','divergent')"


def _par(a: str) -> str:
    return f"CASE WHEN change_{a} IN {_SUB} THEN CASE WHEN q_{a} = 1 THEN 'True' WHEN q_{a} = n_{a} THEN 'False' ELSE 'MIXED' END END"


def classify_sql(source: str = "SELECT * FROM {pair_states}") -> str:
    return f"""src AS ({source}),
    c1 AS (SELECT gene, site, count(*) AS n_pairs, count(*) FILTER ({_chg('top_tip')}) AS n_top, count(DISTINCT top_tip) FILTER ({_chg('top_tip')}) AS k_top, count(DISTINCT focal_state) FILTER ({_chg('top_tip')}) AS q_top,
      count(*) FILTER ({_chg('bottom_tip')}) AS n_bottom, count(DISTINCT bottom_tip) FILTER ({_chg('bottom_tip')}) AS k_bottom, count(DISTINCT focal_state) FILTER ({_chg('bottom_tip')}) AS q_bottom
      FROM src WHERE top_tip IS NOT NULL OR bottom_tip IS NOT NULL GROUP BY 1, 2),
    c2 AS (SELECT *, {_cls('top')} AS change_top, {_cls('bottom')} AS change_bottom FROM c1),
    cl AS (SELECT *, {_par('top')} AS parallel_top, {_par('bottom')} AS parallel_bottom FROM c2)"""


_CL_OUT = f""" SELECT gene, site, change_top, change_bottom,
      CASE WHEN change_top IN {_SUB} AND change_bottom IN {_SUB} THEN 'both' WHEN change_top IN {_SUB} THEN 'top' WHEN change_bottom IN {_SUB} THEN 'bottom' ELSE 'none' END AS change_side,
      parallel_top, parallel_bottom FROM cl"""
_CL_COLS = ["gene", "site", "change_top", "change_bottom", "change_side", "parallel_top", "parallel_bottom"]


@query("sc22", "WITH " + classify_sql() + _CL_OUT)
def sc22(t):
    """Change classification per site, focal-node ancestors."""
    return D.classify(t.pair_states).select(*_CL_COLS)


@query("sc22_gs2", "WITH " + classify_sql("SELECT gene, site, pair_id, " + ", ".join(
    f"translate({c}, '{RESIDUES}', '{codes('GS2')}') AS {c}" for c in ("focal_state", "top_tip", "bottom_tip")) + " FROM {pair_states}") + _CL_OUT)
def sc22_gs2(t):
    """Change classification on residue classes."""
    return D.classify(t.pair_states, scheme="GS2").select(*_CL_COLS)


@query("sc23", "WITH " + classify_sql("SELECT gene, site, pair_id, mrca_state AS focal_state, top_tip, bottom_tip FROM {pair_states}") + " SELECT coalesce(parallel_top, 'NA') AS parallel_top, coalesce(parallel_bottom, 'NA') AS parallel_bottom, count(*) AS n FROM cl GROUP BY 1, 2")
def sc23(t):
    """Parallelism labels against the contrast ancestor."""
    c = D.classify(t.pair_states, mode="mrca").na.fill("NA", ["parallel_top", "parallel_bottom"])
    return P.label_counts(c, "parallel_top", "parallel_bottom")


@query("sc27", "WITH " + classify_sql() + f""", cm AS (SELECT gene, site, string_agg(c, ';' ORDER BY pair_id) AS cs FROM (
      SELECT gene, site, pair_id, CASE WHEN posterior = 0 THEN concat('pair', pair_id, '_fallback:', coalesce(focal_state, '?')) WHEN posterior < 5e-1 THEN concat('pair', pair_id, '_low_posterior:', printf('%.3f', posterior)) END AS c FROM {{pair_states}}) z WHERE c IS NOT NULL GROUP BY 1, 2)
    SELECT cl.gene, cl.site, concat_ws(';', cs, CASE WHEN change_top NOT IN {_SUB} AND change_bottom NOT IN {_SUB} THEN concat('insufficient_changes(top=', change_top, ',bottom=', change_bottom, ')') END) AS comments
    FROM cl LEFT JOIN cm ON cm.gene = cl.gene AND cm.site = cl.site""")
def sc27(t):
    """Review comments."""
    return D.comments(t.pair_states, D.classify(t.pair_states))


@query("sc29", """WITH k AS (SELECT * FROM {pair_states} WHERE coalesce(focal_state, mrca_state) IS NOT NULL AND top_tip IS NOT NULL),
    a AS (SELECT gene, site, count(*) AS n, count(DISTINCT top_tip) AS d FROM k GROUP BY 1, 2)
    SELECT s.gene, s.site, CASE WHEN coalesce(n, 0) < 2 THEN 'ambiguous' WHEN d = 1 THEN 'convergent' ELSE 'divergent' END AS label
    FROM (SELECT DISTINCT gene, site FROM {pair_states}) s LEFT JOIN a ON a.gene = s.gene AND a.site = s.site""")
def sc29(t):
    """Focus transitions of the top side."""
    return D.focus_transitions(t.pair_states).select("gene", "site", "label")


@query("sc33", "SELECT gene, site, concat(string_agg(top_tip, '' ORDER BY pair_id), '/', string_agg(bottom_tip, '' ORDER BY pair_id)) AS multiset FROM {pair_states} WHERE top_tip IS NOT NULL AND bottom_tip IS NOT NULL AND top_tip <> '-' AND bottom_tip <> '-' GROUP BY 1, 2")
def sc33(t):
    """Pair multiset string."""
    return D.pair_multiset(t.pair_states)


@query("sc34", "SELECT gene, site, pair_id, concat(coalesce(focal_state, '?'), '->', coalesce(top_tip, '?'), ' (', CASE WHEN focal_state IS NULL OR top_tip IS NULL THEN 'unknown' WHEN focal_state = top_tip THEN 'maintained' ELSE 'changed' END, ')') AS txt FROM {pair_states}")
def sc34(t):
    """Transition text."""
    return t.pair_states.select("gene", "site", "pair_id", L.transition_text(F.col("focal_state"), F.col("top_tip")).alias("txt"))


@query("sc26", "SELECT gene, site, coalesce(string_agg(a, '+' ORDER BY mp) FILTER (a NOT IN ('-','X','?')), '?') AS shown FROM (SELECT gene, site, upper(top_tip) AS a, min(pair_id) AS mp FROM {pair_states} WHERE top_tip IS NOT NULL GROUP BY 1, 2, 3) z GROUP BY 1, 2")
def sc26(t):
    """Residue list normalisation and display."""
    m = F.array_sort(F.collect_list(F.struct("pair_id", "top_tip")))
    df = t.pair_states.where("top_tip IS NOT NULL").groupBy("gene", "site").agg(m.alias("m"))
    shown = D.shown_residues(D.normal_residues(F.transform("m", lambda x: F.lower(x["top_tip"]))))
    return df.select("gene", "site", shown.alias("shown"))


_GS3 = codes("GS3")


@query("sc25", f"SELECT gene, site, string_agg(g, ',' ORDER BY mp) AS groups, count(*) = 1 AS convergent FROM (SELECT gene, site, translate(top_tip, '{RESIDUES}', '{_GS3}') AS g, min(pair_id) AS mp FROM {{pair_states}} WHERE top_tip <> '-' GROUP BY 1, 2, 3) z GROUP BY 1, 2")
def sc25(t):
    """Derived-state similarity under a scheme."""
    m = F.array_sort(F.collect_list(F.struct("pair_id", "top_tip")))
    df = t.pair_states.where("top_tip <> '-'").groupBy("gene", "site").agg(m.alias("m"))
    sim = D.derived_similarity(F.transform("m", lambda x: x["top_tip"]), "GS3")
    return df.withColumn("s", sim).select("gene", "site", "s.groups", "s.convergent")


@query("sc01", "SELECT DISTINCT scheme, residue, translate(residue, '" + RESIDUES + "', codes) AS code FROM {cells} CROSS JOIN (" + " UNION ALL ".join(
    f"SELECT '{s}' AS scheme, '{codes(s)}' AS codes" for s in PARTITIONS) + f") z WHERE residue IN ({', '.join(repr(a) for a in RESIDUES)})")
def sc01(t):
    """Residue classes of the observed residues under every scheme."""
    from sitewise.functions.schemes import encode, scheme_table

    seen = t.cells.select("residue").distinct().where(F.col("residue").isin(*RESIDUES))
    return seen.select("residue", F.inline(scheme_table())).select("scheme", "residue", encode(F.col("residue"), F.col("codes")).alias("code"))


@query("sc02", f"SELECT Gene, Position, CAAP_Group, translate(split_part(caas, '/', 1), '{RESIDUES}', '{codes('GS1')}') AS enc FROM {{sites}}")
def sc02(t):
    """Pattern encoded to class codes."""
    from sitewise.functions.schemes import encode

    return t.sites.select("Gene", "Position", "CAAP_Group", encode(F.split_part("caas", F.lit("/"), F.lit(1)), F.lit(codes("GS1"))).alias("enc"))


_FG, _BG = "split_part(caas, '/', 1)", "split_part(caas, '/', 2)"


@query("sc04", f"SELECT Gene, Position, CAAP_Group, CASE WHEN replace({_FG}, substr({_FG},1,1), '') = '' AND replace({_BG}, substr({_BG},1,1), '') = '' THEN '1' WHEN replace({_FG}, substr({_FG},1,1), '') = '' THEN '2' WHEN replace({_BG}, substr({_BG},1,1), '') = '' THEN '3' ELSE '4' END AS pattern FROM {{sites}}")
def sc04(t):
    """Pattern class of a packed pattern."""
    from sitewise.functions.patterns import pattern_class

    a, b = (F.split_part("caas", F.lit("/"), F.lit(i)) for i in (1, 2))
    return t.sites.select("Gene", "Position", "CAAP_Group", pattern_class(a, b).alias("pattern"))


@query("sc05", f"SELECT Gene, Position, CAAP_Group, CAST(least(3 - length(translate({_FG}, {_BG}, '')), 3 - length(translate({_BG}, {_FG}, ''))) AS INT) AS overlap, CAST(length(translate({_FG}, {_BG}, '')) AS INT) AS non_fg, CAST(length(translate({_BG}, {_FG}, '')) AS INT) AS non_bg FROM {{sites}}")
def sc05(t):
    """Overlap and exclusive counts."""
    from sitewise.functions.patterns import outside, overlap

    a, b = (F.split_part("caas", F.lit("/"), F.lit(i)) for i in (1, 2))
    return t.sites.select("Gene", "Position", "CAAP_Group", overlap(a, b).alias("overlap"), outside(a, b).alias("non_fg"), outside(b, a).alias("non_bg"))


@query("sc06", "SELECT Gene, Position, CAAP_Group, conserved_pair AS ids FROM {sites}")
def sc06(t):
    """Conserved pair list built and parsed back."""
    raw = F.concat(F.lit("2:"), "conserved_pair")
    return t.sites.select("Gene", "Position", "CAAP_Group", L.conserved_pair_ids(raw).alias("ids"))


@query("sc06_build", f"""SELECT Gene, Position, CAAP_Group, concat(CAST(least(3 - length(translate({_FG}, {_BG}, '')), 3 - length(translate({_BG}, {_FG}, ''))) AS VARCHAR), ':',
    array_to_string(['p' || i FOR i IN [1, 2, 3] IF substr({_FG}, i, 1) = substr({_BG}, i, 1)], ',')) AS pairs FROM {{{{sites}}}}""".replace("{{", "{").replace("}}", "}"))
def sc06_build(t):
    """Conserved pair list built from the two sides."""
    from sitewise.functions.patterns import conserved_pairs

    a, b = (F.split_part("caas", F.lit("/"), F.lit(i)) for i in (1, 2))
    return t.sites.select("Gene", "Position", "CAAP_Group", conserved_pairs(a, b, F.array(F.lit("p1"), F.lit("p2"), F.lit("p3"))).alias("pairs"))


@query("sc03", f"SELECT gene, site, concat(string_agg(top_tip, '' ORDER BY pair_id), '/', string_agg(bottom_tip, '' ORDER BY pair_id)) AS packed FROM {{pair_states}} GROUP BY 1, 2")
def sc03(t):
    """Packed pattern in pair order."""
    m = F.array_sort(F.collect_list(F.struct("pair_id", "top_tip", "bottom_tip")))
    df = t.pair_states.groupBy("gene", "site").agg(m.alias("m"))
    side = lambda c: F.array_join(F.transform("m", lambda x: x[c]), "")
    return df.select("gene", "site", F.concat_ws("/", side("top_tip"), side("bottom_tip")).alias("packed"))


@query("tr10", """WITH s AS (SELECT gene, site, min(pair_id) AS p, max(pair_id) AS p2, max(mrca_state) AS rs, max(posterior) AS rp FROM {pair_states} GROUP BY 1, 2),
    k AS (SELECT s.gene, s.site, bool_and(coalesce(t.top_tip = t.bottom_tip AND t.top_tip = t.focal_state, false)) AS ok, bool_or(t.focal_state = s.rs AND s.rp >= 7e-1) AS rt
      FROM s JOIN {pair_states} t ON t.gene = s.gene AND t.site = s.site AND t.pair_id IN (s.p, s.p2) GROUP BY 1, 2)
    SELECT gene, site, ok AS asr_is_conserved, ok AND coalesce(rt, false) AS asr_root_conserved FROM k""")
def tr10(t):
    """Conserved pairs confirmed by ancestral states."""
    s = t.pair_states.groupBy("gene", "site").agg(
        F.concat_ws(",", F.min("pair_id").cast("string"), F.max("pair_id").cast("string")).alias("conserved_pair"),
        F.max("mrca_state").alias("root_state"), F.max("posterior").alias("root_prob"), F.lit(True).alias("is_conserved_meta"))
    return D.confirm_conserved(t.pair_states, s)


@query("tr12", """SELECT Gene, Position, string_agg(DISTINCT CAAP_Group, ',' ORDER BY CAAP_Group) AS "CAAP_Group", string_agg(DISTINCT caas, '; ' ORDER BY caas) AS caas,
      bool_or(is_conserved_meta = 'TRUE') AS is_conserved_meta, bool_or(asr_is_conserved = 'yes') AS asr_is_conserved FROM {sites} GROUP BY 1, 2""")
def tr12(t):
    """Multi-hypothesis merge per site."""
    return D.merge_hypotheses(t.sites.withColumn("tag", F.col("Pattern"))).select("Gene", "Position", "CAAP_Group", "caas", "is_conserved_meta", "asr_is_conserved")


@query("snk08", "SELECT gene, site, " + ", ".join(
    f"max({v}) FILTER (pair_id = {i}) AS mrca_{i}_{n}" for i in (1, 2, 3) for v, n in (("focal_state", "state"), ("posterior", "posterior"))) + " FROM {pair_states} GROUP BY 1, 2")
def snk08(t):
    """Master table with columns per pair."""
    ps = t.pair_states.withColumnRenamed("focal_state", "state")
    return D.pivot_pairs(ps, ["state", "posterior"], 3)


_MASTER_SQL = """WITH mp AS (SELECT gene, site, """ + ", ".join(
    f"max(CAST(99 + pair_id AS INT)) FILTER (pair_id = {k}) AS n{k}, max(focal_state) FILTER (pair_id = {k}) AS s{k}, max(posterior) FILTER (pair_id = {k}) AS p{k}" for k in (1, 2, 3)) + """ FROM {pair_states} GROUP BY 1, 2)
    SELECT s.Gene AS gene, CAST(s.Position AS VARCHAR) AS msa_pos, '' AS tag, caas, CASE WHEN Pvalue <= 5e-2 THEN 'True' ELSE 'False' END AS is_significant, CAST(CAST(floor(Pvalue * 1000) AS BIGINT) AS VARCHAR) AS pvalue,
      '' AS pvalue_boot, '' AS pattern_type, CAAP_Group AS caap_group, amino_encoded, is_conserved_meta, coalesce(conserved_pair, '') AS conserved_pair, '' AS sig_hyp, '' AS sig_perm, '' AS sig_both, change_top, change_bottom,
      change_side, coalesce(parallel_top, '') AS parallel_top, coalesce(parallel_bottom, '') AS parallel_bottom, parallel_type, concat(change_side, ',', caas) AS low_confidence_nodes, asr_is_conserved, asr_root_conserved,
      '' AS comments, '' AS all_mrca_state, coalesce(CAST(CAST(floor(all_mrca_posterior * 10) AS BIGINT) AS VARCHAR), '') AS all_mrca_posterior, '' AS all_mrca_node, """ + ", ".join(
    f"coalesce(CAST(n{k} AS VARCHAR), '') AS mrca_{k}_node, coalesce(s{k}, '') AS mrca_{k}_state, coalesce(CAST(CAST(floor(p{k} * 100) AS BIGINT) AS VARCHAR), '') AS mrca_{k}_posterior" for k in (1, 2, 3)) + """
    FROM {sites} s LEFT JOIN mp ON mp.gene = s.Gene AND mp.site = s.Position"""


@query("snk08_master", _MASTER_SQL)
def snk08_master(t):
    """Master table: every fixed field and the columns of as many pairs as there are, written and read back."""
    s = t.sites.select(F.col("Gene").alias("gene"), F.col("Position").alias("msa_pos"), "caas", (F.col("Pvalue") <= 0.05).alias("is_significant"), F.floor(F.col("Pvalue") * 1000).alias("pvalue"),
                       F.col("CAAP_Group").alias("caap_group"), "amino_encoded", "is_conserved_meta", "conserved_pair", "change_top", "change_bottom", "change_side", "parallel_top", "parallel_bottom",
                       "parallel_type", F.array("change_side", "caas").alias("low_confidence_nodes"), "asr_is_conserved", "asr_root_conserved", F.floor(F.col("all_mrca_posterior") * 10).alias("all_mrca_posterior"))
    pairs = t.pair_states.select("gene", F.col("site").alias("msa_pos"), "pair_id", (F.col("pair_id") + 99).cast("int").alias("node"), F.col("focal_state").alias("state"), F.floor(F.col("posterior") * 100).alias("posterior"))
    path = f"{shared_folder(t.spark)}/master-{uuid.uuid4().hex}"
    table = master_table(s, pairs)
    write_master(table, path)
    return t.spark.read.schema(table.schema).option("header", True).csv(path).na.fill("")


@query("snk07", """SELECT gene, site, pair_id, focal_state, posterior FROM {pair_states} WHERE CAST(substr(gene, 2) AS BIGINT) % 3 <> 0
    UNION ALL SELECT gene, site, pair_id, focal_state, posterior + 1 FROM {pair_states} WHERE CAST(substr(gene, 2) AS BIGINT) % 3 = 0 AND pair_id = 1""")
def snk07(t):
    """Result store: all genes written, a third of them written anew twice, everything read."""
    rows = t.pair_states.select("gene", "site", "pair_id", "focal_state", "posterior")
    store = ResultStore(t.spark, f"{shared_folder(t.spark)}/store-{uuid.uuid4().hex}", 16)
    store.put(rows)
    again = rows.where("CAST(substr(gene, 2) AS BIGINT) % 3 = 0 AND pair_id = 1").withColumn("posterior", F.col("posterior") + 1)
    store.put(again)
    store.put(again)
    return store.read()


@query("jn26", "WITH " + MET + ", pr AS (SELECT gene, site, pair_id, CAST(99 + pair_id AS INT) AS node_id FROM {pair_states}) SELECT p.gene, p.site, " + ", ".join(
    f"round(avg({v}) FILTER (pair_id = {i}), 6) AS {v}{i}" for v in ("margin", "entropy") for i in (1, 2, 3)) + " FROM pr p LEFT JOIN mt ON mt.gene = p.gene AND mt.site = p.site AND mt.node_id = p.node_id GROUP BY 1, 2")
def jn26(t):
    """Pair node metrics pivoted."""
    pr = t.pair_states.select("gene", "site", "pair_id", (F.col("pair_id") + 99).cast("int").alias("node_id"))
    out = D.pair_metrics(pr, D.posterior_metrics(t.posteriors), 3)
    return out.select("gene", "site", *rnd(*[f"{v}{i}" for v in ("margin", "entropy") for i in (1, 2, 3)]))


WIDE = "wd AS (SELECT gene, site, " + ", ".join(f"max(posterior) FILTER (pair_id = {i}) AS p{i}" for i in (1, 2, 3)) + " FROM {pair_states} GROUP BY 1, 2), ft AS (SELECT *, least(p1, p2, p3) AS p_min, p1 * p2 * p3 AS p_prod FROM wd)"


def filt(t, tau=0.3):
    return D.site_posteriors(D.pivot_pairs(t.pair_states, ["posterior"], 3, "p{i}"), ["p1", "p2", "p3"], tau)


@query("ps23", "WITH " + WIDE + ' SELECT gene, site, round(p_min, 6) AS p_min, round(p_prod, 6) AS p_prod, p_min >= 3e-1 AS "PASS" FROM ft')
def ps23(t):
    """Smallest and product posterior with the PASS flag."""
    return filt(t).select("gene", "site", *rnd("p_min", "p_prod"), "PASS")


TAUS = [0.1, 0.3, 0.5, 0.7]


@query("flt19", "WITH " + WIDE + " " + " UNION ALL ".join(
    f"SELECT {int(x * 10)}e-1 AS tau, count(*) AS N_sites_total, count(*) FILTER (p_min >= {int(x * 10)}e-1) AS N_sites_retained, round(count(*) FILTER (p_min >= {int(x * 10)}e-1) * 1e0 / count(*), 6) AS retention_fraction, count(DISTINCT gene) FILTER (p_min >= {int(x * 10)}e-1) AS N_convergent_genes FROM ft" for x in TAUS))
def flt19(t):
    """Retention over a threshold grid."""
    return D.tau_grid(filt(t), TAUS).withColumn("retention_fraction", F.round("retention_fraction", 6))


@query("se11", "WITH " + WIDE + " " + " UNION ALL ".join(
    f"SELECT {a}e-1 AS tau_A, {b}e-1 AS tau_B, count(*) FILTER (p_min >= {a}e-1) AS n_A, count(*) FILTER (p_min >= {b}e-1) AS n_B, count(*) FILTER (p_min >= {b}e-1) AS n_intersect, count(*) FILTER (p_min >= {a}e-1) AS n_union, round(count(*) FILTER (p_min >= {b}e-1) * 1e0 / nullif(count(*) FILTER (p_min >= {a}e-1), 0), 6) AS jaccard FROM ft"
    for a, b in ((1, 3), (3, 5), (1, 5))))
def se11(t):
    """Callset overlap between thresholds."""
    return D.tau_overlap(filt(t), [(0.1, 0.3), (0.3, 0.5), (0.1, 0.5)]).withColumn("jaccard", F.round("jaccard", 6))


@query("ag26", "WITH " + WIDE + " SELECT gene, count(*) AS sites_total, count(*) FILTER (p_min >= 3e-1) AS sites_retained, count(*) FILTER (p_min < 3e-1) AS sites_excluded, round(count(*) FILTER (p_min >= 3e-1) * 1e0 / count(*), 6) AS retention_fraction FROM ft GROUP BY gene")
def ag26(t):
    """Retention per gene."""
    return D.retention(filt(t), "gene").withColumn("retention_fraction", F.round("retention_fraction", 6))


_PCT = [1, 5, 10, 20, 25, 40, 50, 60, 75, 80, 90, 95, 99]
_AG25 = 'count(*) AS "N_total", round(avg(map_), 6) AS mean, round(stddev_samp(map_), 6) AS sd, min(map_) AS min, max(map_) AS max, ' + ", ".join(
    f"round(avg(CASE WHEN map_ < {c}e-2 THEN 1e0 ELSE 0e0 END), 6) AS frac_lt_{c}" for c in (100, 99, 95, 90, 80, 60)) + ", " + ", ".join(
    f"round(quantile_cont(map_, {p / 100}), 6) AS pct_{p}" for p in _PCT)


@query("ag25", "WITH " + MET + f" SELECT 'full' AS part, {_AG25} FROM mt UNION ALL SELECT 'tail', {_AG25} FROM mt WHERE map_ < 1")
def ag25(t):
    """MAP distribution, full and uncertain tail."""
    m = D.posterior_metrics(t.posteriors)
    out = D.map_statistics(m).withColumn("part", F.lit("full")).unionByName(D.map_statistics(m.where("MAP < 1")).withColumn("part", F.lit("tail")))
    keep = ["N_total", "min", "max", "part"]
    return out.select(*keep, *rnd(*[c for c in out.columns if c not in keep]))


# ------------------------------------------------------------------ selection
@query("ag22", """WITH ok AS (SELECT * FROM {fade} WHERE bayes_factor IS NOT NULL),
    sg AS (SELECT gene, target_aa, site FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY bayes_factor DESC, site, target_aa) AS rn FROM ok WHERE bayes_factor >= 100) z WHERE rn = 1)
    SELECT o.gene, count(DISTINCT o.site) AS n_sites_tested, count(*) FILTER (bayes_factor >= 100) AS n_sig_site_aa, max(bayes_factor) AS max_bf, max(s.target_aa) AS top_target_aa, max(s.site) AS top_site
    FROM ok o LEFT JOIN sg s ON s.gene = o.gene GROUP BY o.gene""")
def ag22(t):
    """Gene summary of directional Bayes factors."""
    return X.fade_genes(t.fade)


@query("ag23", "SELECT gene, site, max(bayes_factor) AS max_site_bf, arg_max(target_aa, bayes_factor) AS top_target_aa, max(bayes_factor) >= 100 AS fade_biased FROM {fade} WHERE bayes_factor IS NOT NULL GROUP BY 1, 2")
def ag23(t):
    """Site summary of directional Bayes factors."""
    return X.fade_sites(t.fade)


@query("ag24", "SELECT gene, P < 5e-2 AS signif, coalesce(p_perm < 5e-2, false) AS signif_perm, coalesce(p_perm < 5e-2, false) AND Rho > 1e-1 AS pos_corr, coalesce(p_perm < 5e-2, false) AND Rho < -1e-1 AS neg_corr FROM {rer}")
def ag24(t):
    """Relative-rate significance flags."""
    return X.rate_flags(t.rer.withColumnRenamed("P", "p_adj"), rho_cut=0.1).select("gene", "signif", "signif_perm", "pos_corr", "neg_corr")


LEN = "ln AS (SELECT concat('G', CAST(l_partkey AS VARCHAR)) AS gene, l_suppkey % 25 AS branch, avg(l_quantity) AS length FROM {lineitem} GROUP BY 1, 2)"


def lengths(t):
    return t.lineitem.groupBy(F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene"), (F.col("l_suppkey") % 25).alias("branch")).agg(F.avg("l_quantity").alias("length"))


RATES = "WITH " + LEN + """, av AS (SELECT branch, avg(length) AS x FROM ln GROUP BY 1), j AS (SELECT ln.*, x FROM ln JOIN av ON av.branch = ln.branch),
    ft AS (SELECT gene, regr_slope(length, x) AS b, regr_intercept(length, x) AS a FROM j GROUP BY 1),
    rt AS (SELECT j.gene, j.branch, length - coalesce(a, 0e0) - coalesce(b, 0e0) * x AS rer FROM j JOIN ft ON ft.gene = j.gene)"""


@query("ps19", RATES + " SELECT gene, branch, round(rer, 5) AS rer FROM rt")
def ps19(t):
    """Relative-rate residuals."""
    return X.relative_rates(lengths(t)).select("gene", "branch", *rnd("rer", digits=5))


@query("ps19_corr", RATES + """, tv AS (SELECT s_nationkey AS branch, avg(s_acctbal) AS value FROM {supplier} GROUP BY 1)
    SELECT gene, round(corr(rer, value), 5) AS "Rho", count(*) AS "N" FROM rt JOIN tv ON tv.branch = rt.branch GROUP BY gene HAVING count(*) >= 5""")
def ps19_corr(t):
    """Rate correlation with a trait, gated by species count."""
    tv = t.supplier.groupBy(F.col("s_nationkey").alias("branch")).agg(F.avg("s_acctbal").alias("value"))
    return X.rate_correlation(X.relative_rates(lengths(t)), tv, 5).select("gene", *rnd("Rho", digits=5), "N")


# Permuted traits come as a table: a permutation is an order's hundred, its value on a branch an average price.
PERM = "tv AS (SELECT s_nationkey AS branch, avg(s_acctbal) AS value FROM {supplier} GROUP BY 1), pm AS (SELECT o_orderkey % 128 AS perm, o_custkey % 25 AS branch, avg(o_totalprice) AS value FROM {orders} GROUP BY 1, 2)"
_PP = """ob AS (SELECT gene, corr(rer, value) AS rho, count(*) AS n FROM rt JOIN tv ON tv.branch = rt.branch GROUP BY gene),
    nl AS (SELECT gene, perm, corr(rer, value) AS r FROM rt JOIN pm ON pm.branch = rt.branch GROUP BY gene, perm)
    SELECT o.gene, round(any_value(rho), 5) AS "Rho", any_value(n) AS "N", count(*) FILTER (abs(r) >= abs(rho) - 1e-9) AS exceedances, count(r) AS n_perms,
      round(count(*) FILTER (abs(r) >= abs(rho) - 1e-9) * 1e0 / count(r), 5) AS p_perm FROM ob o JOIN nl ON nl.gene = o.gene WHERE n >= 5 GROUP BY o.gene"""


def permuted(t):
    tv = t.supplier.groupBy(F.col("s_nationkey").alias("branch")).agg(F.avg("s_acctbal").alias("value"))
    pm = t.orders.groupBy((F.col("o_orderkey") % 128).alias("perm"), (F.col("o_custkey") % 25).alias("branch")).agg(F.avg("o_totalprice").alias("value"))
    return tv, pm


@query("ps19_perm", RATES + ", " + PERM + ", " + _PP)
def ps19_perm(t):
    """Rate correlation and its permutation p-value, continuous trait."""
    return PM.permutation_test(X.relative_rates(lengths(t)), *permuted(t), min_branches=5).select("gene", *rnd("Rho", digits=5), "N", "exceedances", "n_perms", *rnd("p_perm", digits=5))


# Tau-b by its definition, over pairs of branches; rates are rounded, so that ties are ties on both sides.
_KB = """rr AS (SELECT gene, branch, round(rer, 2) AS rer FROM rt), tb AS (SELECT branch, CASE WHEN value > 4e3 THEN 1 ELSE 0 END AS y FROM tv),
    pb AS (SELECT perm, branch, CASE WHEN value > 150e3 THEN 1 ELSE 0 END AS y FROM pm),
    px AS (SELECT perm, tb.branch, coalesce(pb.y, 0) AS y FROM (SELECT DISTINCT perm FROM pm) q CROSS JOIN tb LEFT JOIN pb USING (perm, branch)),
    dd AS (SELECT a.gene, a.branch AS b1, b.branch AS b2, sign(a.rer - b.rer) AS s FROM rr a JOIN rr b ON a.gene = b.gene AND a.branch < b.branch WHERE a.branch IN (SELECT branch FROM tb) AND b.branch IN (SELECT branch FROM tb)),
    ob AS (SELECT gene, sum(s * (u.y - v.y)) / nullif(sqrt(sum(abs(s)) * sum(abs(u.y - v.y))), 0) AS rho FROM dd JOIN tb u ON u.branch = b1 JOIN tb v ON v.branch = b2 GROUP BY gene),
    cn AS (SELECT gene, count(*) AS n, sum(y) AS pos FROM rr JOIN tb ON tb.branch = rr.branch GROUP BY gene),
    nl AS (SELECT gene, u.perm, sum(s * (u.y - v.y)) / nullif(sqrt(sum(abs(s)) * sum(abs(u.y - v.y))), 0) AS r FROM dd JOIN px u ON u.branch = b1 JOIN px v ON v.branch = b2 AND v.perm = u.perm GROUP BY gene, u.perm)
    SELECT o.gene, round(any_value(rho), 5) AS "Rho", any_value(n) AS "N", CASE WHEN any_value(rho) IS NOT NULL THEN count(*) FILTER (abs(r) >= abs(rho) - 1e-9) END AS exceedances, count(r) AS n_perms,
      round(CASE WHEN any_value(rho) IS NOT NULL THEN count(*) FILTER (abs(r) >= abs(rho) - 1e-9) * 1e0 / count(r) END, 5) AS p_perm
    FROM ob o JOIN cn ON cn.gene = o.gene JOIN nl ON nl.gene = o.gene WHERE n >= 5 AND pos >= 2 GROUP BY o.gene"""


@query("ps19_binary_perm", RATES + ", " + PERM + ", " + _KB)
def ps19_binary_perm(t):
    """Rank correlation with a 0/1 trait and its permutation p-value."""
    tv, pm = permuted(t)
    out = PM.permutation_test(X.relative_rates(lengths(t)).withColumn("rer", F.round("rer", 2)), tv.select("branch", (F.col("value") > 4000).cast("int").alias("value")),
                             pm.select("perm", "branch", (F.col("value") > 150000).cast("int").alias("value")), "binary", 5, 2)
    return out.select("gene", *rnd("Rho", digits=5), "N", "exceedances", "n_perms", *rnd("p_perm", digits=5))


@query("ps19_winsor", RATES + """, rk AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY rer) AS k, count(*) OVER (PARTITION BY gene) AS n FROM rt),
    bd AS (SELECT gene, min(rer) AS lo, max(rer) AS hi FROM rk WHERE k > 2 AND k <= n - 2 GROUP BY gene)
    SELECT rt.gene, branch, round(CASE WHEN lo IS NULL THEN rer ELSE greatest(least(rer, hi), lo) END, 5) AS rer FROM rt LEFT JOIN bd ON bd.gene = rt.gene""")
def ps19_winsor(t):
    """Residuals whose two extremes on either side are drawn inwards."""
    return PM.winsorised(X.relative_rates(lengths(t)), 2).select("gene", "branch", *rnd("rer", digits=5))


SEQ = "sq AS (SELECT gene, species, string_agg(residue, '' ORDER BY position) AS seq FROM {cells} GROUP BY 1, 2)"


def sequences(t):
    m = F.array_sort(F.collect_list(F.struct("position", "residue")))
    return t.cells.groupBy("gene", "species").agg(F.array_join(F.transform(m, lambda x: x["residue"]), "").alias("seq"))


@query("flt16", "WITH " + SEQ + " SELECT gene, species, seq FROM sq WHERE regexp_replace(seq, '[-?Xx]', '', 'g') <> ''")
def flt16(t):
    """Gap-only sequences dropped."""
    return X.drop_gap_only(sequences(t))


@query("flt17", "WITH " + SEQ + " SELECT gene, concat('>', species, chr(10), seq) AS record FROM sq WHERE species IN (SELECT species FROM {config} WHERE grp = 1)")
def flt17(t):
    """FASTA records of foreground taxa."""
    return X.fasta_lines(X.keep_taxa(sequences(t), t.config.where("grp = 1")))


@query("flt18", "SELECT 'kept' AS part, gene FROM (SELECT DISTINCT gene FROM {cells}) c WHERE gene IN (SELECT Gene FROM {genes} WHERE Length > 200) UNION ALL SELECT 'missing', Gene FROM {genes} WHERE Length > 200 AND Gene NOT IN (SELECT gene FROM {cells})")
def flt18(t):
    """Gene list filter with the missing report."""
    want = t.genes.where("Length > 200").select(F.col("Gene").alias("gene"))
    kept, missing = X.keep_genes(t.cells.select("gene").distinct(), want)
    return kept.select(F.lit("kept").alias("part"), "gene").unionByName(missing.select(F.lit("missing").alias("part"), "gene"))


@query("tr13", """SELECT gene, concat('(', string_agg(concat(sp, CASE WHEN f THEN concat(chr(123), 'Foreground', chr(125)) ELSE '' END, ':1'), ',' ORDER BY sp), ');') AS marked
    FROM (SELECT DISTINCT c.gene, c.species AS sp, g.species IS NOT NULL AS f FROM {cells} c LEFT JOIN (SELECT species FROM {config} WHERE grp = 1) g ON g.species = c.species) z GROUP BY gene""")
def tr13(t):
    """Foreground marking of one Newick text per gene."""
    names = F.array_join(F.transform(F.array_sort(F.collect_set("species")), lambda s: F.concat(s, F.lit(":1"))), ",")
    trees = t.cells.groupBy("gene").agg(F.concat(F.lit("("), names, F.lit(");")).alias("newick"))
    fg = species_names(t.config.where("grp = 1"))
    return trees.select("gene", X.mark_foreground(F.col("newick"), fg).alias("marked"))


@query("flt04", "SELECT o_orderkey, NOT (o_custkey % 5 + o_custkey % 3 > 5) AND NOT (o_custkey % 5 > 3) AND NOT (o_custkey % 3 > 1) AS keep FROM {orders}")
def flt04(t):
    """Gap caps of the bootstrap: overall, foreground and background."""
    df = t.orders.select("o_orderkey", (F.col("o_custkey") % 5).alias("GFG"), (F.col("o_custkey") % 3).alias("GBG"), F.lit(0).alias("MFG"), F.lit(0).alias("MBG"),
                         F.lit("A").alias("fg_seen"), F.lit("A").alias("bg_seen"))
    return df.select("o_orderkey", S.testable(S.Limits(fg_gaps=3, bg_gaps=1, all_gaps=5)).alias("keep"))


@query("flt04_missing", "WITH c AS (SELECT gene, position, " + ", ".join(
    f"count(*) FILTER (c.residue = '-' AND g.grp = {g}) AS g{g}, (SELECT count(*) FROM {{config}} WHERE grp = {g}) - count(g.species) FILTER (g.grp = {g}) AS m{g}, count(*) FILTER (c.residue <> '-' AND g.grp = {g}) AS s{g}" for g in (1, 0)) +
    " FROM {cells} c LEFT JOIN {config} g ON g.species = c.species GROUP BY 1, 2) SELECT gene, position, CAST(m1 AS INT) AS fg_missing, CAST(m0 AS INT) AS bg_missing, s1 > 0 AND s0 > 0 AND g1 <= 1 AND m1 <= 3 AND m0 <= 2 AND m1 + m0 <= 4 AS keep FROM c")
def flt04_missing(t):
    """Gap and missing caps on counts of absent species."""
    cfg = t.config.select("species", "grp")
    n = {r["grp"]: r["count"] for r in cfg.groupBy("grp").count().collect()}  # two numbers
    j = t.cells.join(cfg, "species", "left")
    is_in = lambda g: F.coalesce(F.col("grp") == g, F.lit(False))
    held = lambda g: F.array_join(F.collect_list(F.when(is_in(g), F.col("residue"))), "")
    per = j.groupBy("gene", "position").agg(*[x for g, s in ((1, "F"), (0, "B")) for x in (
        F.count_if(is_in(g) & (F.col("residue") == "-")).alias(f"G{s}G"), (F.lit(n.get(g, 0)) - F.count_if(is_in(g))).cast("int").alias(f"M{s}G"), held(g).alias("fg_seen" if g else "bg_seen"))])
    limits = S.Limits(fg_gaps=1, fg_miss=3, bg_miss=2, all_miss=4)
    return per.select("gene", "position", F.col("MFG").alias("fg_missing"), F.col("MBG").alias("bg_missing"), S.testable(limits).alias("keep"))


@query("flt05", "SELECT count(DISTINCT sid - sid % 2) AS n_pairs, CAST(floor(count(DISTINCT sid - sid % 2) * 3e-1) AS BIGINT) AS cap, CAST(floor(count(DISTINCT sid - sid % 2) * 5e-1) AS BIGINT) AS max_conserved FROM {traits}")
def flt05(t):
    """Fraction thresholds from the pair count of a configuration over all trait species."""
    n = t.traits.select((F.col("sid") - F.col("sid") % 2).alias("pair")).distinct().count()
    lim = S.fraction_limits(n, gaps=0.3)
    return t.spark.createDataFrame([(n, lim.fg_gaps, S.max_conserved_from_fraction(n, 0.5))], "n_pairs long, cap long, max_conserved long")


@query("flt13", "SELECT count(*) >= 3 AS enough FROM {traits} WHERE value > 0")
def flt13(t):
    """Minimum-contrast gate over all trait species."""
    from sitewise.operators.contrasts import enough_contrasts

    cfg = t.traits.select("species", (F.col("value") > 0).cast("int").alias("grp"))
    return t.spark.createDataFrame([(enough_contrasts(cfg),)], "enough boolean")


@query("flt14", "SELECT gene FROM (SELECT DISTINCT gene FROM {cells}) g ORDER BY md5(concat('1', gene)), gene LIMIT 50")
def flt14(t):
    """Toy mode: a random sample of alignments (the sample is the feature)."""
    genes = t.cells.select("gene").distinct()
    return genes.orderBy(F.md5(F.concat(F.lit("1"), "gene").cast("binary")), "gene").limit(50)
