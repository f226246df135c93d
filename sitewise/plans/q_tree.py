"""Queries: traits, trees, contrast pairs and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators import ancestry as A
from sitewise.operators import contrasts as C
from sitewise.operators import intervals as I
from sitewise.operators import resampling as R
from sitewise.operators import trees as T
from sitewise.plans.registry import query


def rnd(*cols, digits=6):
    return [F.round(c, digits).alias(c) for c in cols]


Q = "quantile_cont(value, {p})"
G = "g AS (SELECT avg(value) AS g_mean, stddev_samp(value) AS g_sd, " + ", ".join(
    f"quantile_cont(value, {p}) AS {n}" for n, p in (("g_q10", 0.1), ("g_q20", 0.2), ("g_q25", 0.25), ("g_median", 0.5), ("g_q75", 0.75), ("g_q80", 0.8), ("g_q90", 0.9))) + " FROM {traits})"


@query("ps11", "WITH " + G + """ SELECT m.method, round(CASE m.method WHEN 'quartile' THEN g_q25 WHEN 'quintile' THEN g_q20 WHEN 'decile' THEN g_q10 WHEN 'median_sd' THEN g_median - g_sd
      ELSE (SELECT quantile_cont(value, 0.05) FROM {traits}) END, 6) AS lower_thresh,
    round(CASE m.method WHEN 'quartile' THEN g_q75 WHEN 'quintile' THEN g_q80 WHEN 'decile' THEN g_q90 WHEN 'median_sd' THEN g_median + g_sd
      ELSE (SELECT quantile_cont(value, 0.95) FROM {traits}) END, 6) AS upper_thresh
    FROM g CROSS JOIN (SELECT unnest(['quartile','quintile','decile','median_sd','parameterized']) AS method) m""")
def ps11(t):
    """Trait thresholds of every method."""
    out = None
    for m in C.METHODS:
        one = C.thresholds(t.traits, m, top=0.95, bottom=0.05).select(F.lit(m).alias("method"), *rnd("lower_thresh", "upper_thresh"))
        out = one if out is None else out.unionByName(one)
    return out


LABELS = "WITH " + G + """, tx AS (SELECT taxon, avg(value) AS taxa_mean, quantile_cont(value, 0.5) AS taxa_median, stddev_samp(value) AS taxa_sd,
      quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {traits} GROUP BY taxon)"""


@query("ps12", LABELS + """ SELECT species, CASE WHEN value < g_q25 - 1.5 * (g_q75 - g_q25) THEN 'low_outlier' WHEN value > g_q75 + 1.5 * (g_q75 - g_q25) THEN 'high_outlier' ELSE 'normal' END AS outlier,
      CASE WHEN value <= g_q10 AND value < g_median THEN 'low_extreme' WHEN value >= g_q90 AND value > g_median THEN 'high_extreme' ELSE 'normal' END AS global_label,
      CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN 'low_outlier' WHEN value > q3 + 1.5 * (q3 - q1) THEN 'high_outlier' ELSE 'normal' END AS taxa_outlier,
      CASE WHEN value < q1 AND value < taxa_median THEN 'low_extreme' WHEN value > q3 AND value > taxa_median THEN 'high_extreme' ELSE 'normal' END AS taxa_label
    FROM {traits} t CROSS JOIN g JOIN tx ON tx.taxon = t.taxon""")
def ps12(t):
    """Outlier and extreme labels."""
    return C.labels(t.traits, C.thresholds(t.traits)).select("species", "outlier", "global_label", "taxa_outlier", "taxa_label")


@query("wn11", LABELS + " SELECT species, CASE WHEN value < q1 - 3 * (q3 - q1) THEN 'low_outlier' WHEN value > q3 + 3 * (q3 - q1) THEN 'high_outlier' ELSE 'normal' END AS extreme_taxa_outlier FROM {traits} t JOIN tx ON tx.taxon = t.taxon")
def wn11(t):
    """Within-taxon median/IQR labels."""
    return C.labels(t.traits, C.thresholds(t.traits)).select("species", "extreme_taxa_outlier")


@query("ag21", LABELS + " SELECT taxon, round(taxa_mean, 6) AS taxa_mean, round(taxa_median, 6) AS taxa_median, round(taxa_sd, 6) AS taxa_sd, round(q1, 6) AS taxa_q25, round(q3, 6) AS taxa_q75 FROM tx")
def ag21(t):
    """Taxon statistics."""
    return C.taxon_statistics(t.traits).select("taxon", *rnd("taxa_mean", "taxa_median", "taxa_sd", "taxa_q25", "taxa_q75"))


@query("sc15", "WITH g AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) AS q3 FROM {traits}) SELECT species, round((value - m) / (q3 - q1), 6) AS scaled, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS is_outlier FROM {traits} CROSS JOIN g")
def sc15(t):
    """Robust scaling and outlier flag."""
    return C.robust_scale(t.traits).select("species", *rnd("scaled"), "is_outlier")


@query("sc14", "WITH s AS (SELECT min(n_cases) FILTER (n_cases > 0) / 1e1 AS sh FROM {traits}) SELECT species, round(ln(greatest(least(n_cases * 1e0 / n_population, 9999e-4), 1e-4) / (1 - greatest(least(n_cases * 1e0 / n_population, 9999e-4), 1e-4))), 6) AS lg, round(log10(n_cases + sh), 6) AS ls FROM {traits} CROSS JOIN s")
def sc14(t):
    """Logit and shifted log10 transforms."""
    df = C.log_shift(t.traits, "n_cases", "ls")
    return df.select("species", F.round(C.logit(F.col("n_cases") / F.col("n_population")), 6).alias("lg"), *rnd("ls"))


@query("sc16")
def sc16(t):
    """Credible interval of a proportion."""
    return C.intervals(t.traits, C.thresholds(t.traits)).select("species", *rnd("trait_ci_lb", "trait_ci_ub"), "category")


CAT = "WITH " + G + ", ct AS (SELECT t.*, g_q10 AS lo, g_q90 AS hi, CASE WHEN value >= g_q90 THEN 'top' WHEN value <= g_q10 THEN 'bottom' ELSE 'intermediate' END AS category FROM {traits} t CROSS JOIN g)"


def cat(t):
    return C.discrete(t.traits, C.thresholds(t.traits))


@query("jn08", CAT + " SELECT a.species AS species1, b.species AS species2, round(a.value - b.value, 6) AS trait_diff, NOT (a.category <> 'intermediate' AND b.category <> 'intermediate' AND a.category <> b.category) AS trait_overlap FROM ct a CROSS JOIN ct b")
def jn08(t):
    """All species pairs with difference and discrete overlap."""
    return C.pairwise(cat(t), use_counts=False).select("species1", "species2", *rnd("trait_diff"), "trait_overlap")


JN09 = "b AS (SELECT species, value, value - {w} AS lb, value + {w} AS ub FROM {{traits}})"


@query("jn09", "WITH " + JN09.format(w="5e2") + " SELECT x.species AS species1, y.species AS species2, x.lb <= y.ub AND y.lb <= x.ub AS trait_overlap FROM b x CROSS JOIN b y")
def jn09(t):
    """Interval overlap of all species pairs, as a flag."""
    b = t.traits.select("species", "value", (F.col("value") - 500).alias("trait_ci_lb"), (F.col("value") + 500).alias("trait_ci_ub"), F.lit("").alias("category"))
    return C.pairwise(b, use_counts=True).select("species1", "species2", "trait_overlap")


@query("jn09_overlaps", "WITH " + JN09.format(w="(50 + sid % 7 * 40)") + " SELECT x.species AS species1, y.species AS species2, round(x.value - y.value, 6) AS trait_diff FROM b x JOIN b y ON x.lb <= y.ub AND y.lb <= x.ub")
def jn09_overlaps(t):
    """Species pairs whose intervals overlap."""
    w = 50 + F.col("sid") % 7 * 40
    b = t.traits.select("species", "value", (F.col("value") - w).alias("lb"), (F.col("value") + w).alias("ub"))
    side = lambda k: b.select(*[F.col(c).alias(f"{c}{k}") for c in b.columns])
    out = I.overlapping(side(1), side(2), ("lb1", "ub1"), ("lb2", "ub2"))
    return out.withColumn("trait_diff", F.col("value1") - F.col("value2")).select("species1", "species2", *rnd("trait_diff"))


@query("jn09_events", "WITH a AS (SELECT event_id, value - user_id % 5 * 1e-2 AS lo, value + user_id % 5 * 1e-2 AS hi FROM {events}), g AS (SELECT o_orderkey, o_totalprice / 1e3 AS glo, o_totalprice / 1e3 + o_custkey % 3 * 1e-2 AS ghi FROM {orders}) SELECT o_orderkey, count(*) AS n, min(event_id) AS first_event FROM g JOIN a ON lo <= ghi AND glo <= hi GROUP BY 1")
def jn09_events(t):
    """Overlaps of two large interval tables of very different widths, counted."""
    r = F.col("user_id") % 5 * 0.01
    a = t.events.select("event_id", (F.col("value") - r).alias("lo"), (F.col("value") + r).alias("hi"))
    g = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("glo"), (F.col("o_totalprice") / 1000 + F.col("o_custkey") % 3 * 0.01).alias("ghi"))
    return I.overlapping(g, a, ("glo", "ghi"), ("lo", "hi")).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query("jn09_matrix", "WITH " + JN09.format(w="5e2") + " SELECT x.species AS species1, y.species AS species2, x.lb <= y.ub AND y.lb <= x.ub AS trait_overlap FROM b x CROSS JOIN b y")
def jn09_matrix(t):
    """The same flags under the name they had while ``jn09`` returned overlapping pairs only."""
    return jn09(t)


# Distances written out from the nation and region keys, independent of the tree code.
DIST = """dk AS (SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS species, s_suppkey, n_nationkey AS nk, n_regionkey AS rk,
      CAST(1 + s_suppkey % 5 AS DOUBLE) / 16 AS bl, CAST(1 + n_nationkey % 7 AS DOUBLE) / 8 AS nl, CAST(1 + n_regionkey AS DOUBLE) / 4 AS rl
      FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey)"""


def _d(a: str, b: str) -> str:
    return f"(CASE WHEN {a}.s_suppkey = {b}.s_suppkey THEN 0e0 ELSE {a}.bl + {b}.bl + CASE WHEN {a}.nk = {b}.nk THEN 0e0 ELSE {a}.nl + {b}.nl + CASE WHEN {a}.rk = {b}.rk THEN 0e0 ELSE {a}.rl + {b}.rl END END END)"


@query("tr03", "WITH " + DIST + f" SELECT a.species AS species1, b.species AS species2, {_d('a', 'b')} AS distance FROM dk a JOIN dk b ON a.species <> b.species")
def tr03(t):
    """Patristic distances between all species."""
    return T.patristic(t.tree, t.traits)


@query("tr03_pairs", "WITH " + DIST + f""", pr AS (SELECT DISTINCT x.l_suppkey AS s1, y.l_suppkey AS s2 FROM {{lineitem}} x JOIN {{lineitem}} y ON y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber + 1)
    SELECT a.species AS species1, b.species AS species2, {_d('a', 'b')} AS distance,
      CASE WHEN a.s_suppkey = b.s_suppkey THEN 1000 + a.s_suppkey WHEN a.nk = b.nk THEN 100 + a.nk WHEN a.rk = b.rk THEN 1 + a.rk ELSE 0 END AS ancestor
    FROM pr JOIN dk a ON a.s_suppkey = pr.s1 JOIN dk b ON b.s_suppkey = pr.s2""")
def tr03_pairs(t):
    """Common ancestor and distance of given species pairs: suppliers of neighbouring order lines."""
    tree = A.lifting(t.tree)
    x = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s1"))
    y = t.lineitem.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_suppkey").alias("s2"))
    pairs = x.join(y, ["l_orderkey", "l_linenumber"]).select("s1", "s2").distinct()
    for k in (1, 2):
        named = tree.nodes.select(F.col("name").alias(f"species{k}"), F.col("node").alias(f"node{k}"))
        pairs = pairs.withColumn(f"species{k}", F.concat(F.lit("S"), F.col(f"s{k}").cast("string"))).join(named, f"species{k}")
    return A.pair_ancestors(tree, pairs).select("species1", "species2", "distance", F.col("ancestor").cast("long").alias("ancestor"))


@query("ps07", "WITH " + DIST + f" SELECT species1, arg_max(species2, row(distance, species2)) AS farthest, max(distance) AS distance FROM (SELECT a.species AS species1, b.species AS species2, {_d('a', 'b')} AS distance FROM dk a JOIN dk b ON a.species <> b.species) z GROUP BY 1")
def ps07(t):
    """The farthest species of every species and its distance."""
    return A.farthest_members(A.lifting(t.tree), t.traits.select("species"))


@query("jn10", CAT + ", " + DIST + f""" SELECT a.species AS species1, b.species AS species2, round({_d('da', 'db')}, 4) AS distance, round(a.value - b.value, 4) AS abs_diff, CAST(a.n_population + b.n_population AS DOUBLE) AS pair_n
    FROM ct a JOIN ct b ON a.category = 'top' AND b.category = 'bottom' JOIN dk da ON da.species = a.species JOIN dk db ON db.species = b.species WHERE round(a.value - b.value, 4) > 0""")
def jn10(t):
    """Candidate pairs: distance x trait x trait."""
    return C.candidates(cat(t), A.lifting(t.tree), "n_population")


def _greedy() -> str:
    sql = CAT + ", " + DIST + f""", cd AS (SELECT a.species AS s1, b.species AS s2, {_d('da', 'db')} AS rd, round({_d('da', 'db')}, 4) AS distance, round(a.value - b.value, 4) AS ad, a.n_population + b.n_population AS pn
      FROM ct a JOIN ct b ON a.category = 'top' AND b.category = 'bottom' JOIN dk da ON da.species = a.species JOIN dk db ON db.species = b.species WHERE round(a.value - b.value, 4) > 0),
    p1 AS (SELECT s1, s2, 1 AS cluster, CAST(NULL AS DOUBLE) AS dunn FROM cd ORDER BY distance, ad DESC, pn DESC, s1, s2 LIMIT 1)"""
    prev = "p1"
    for k in (2, 3, 4):
        sql += f""", sel{k} AS (SELECT s1 AS sp FROM {prev} UNION ALL SELECT s2 FROM {prev}),
    du{k} AS (SELECT c.s1, c.s2, c.ad, c.pn, round(min(least({_d('x', 'y')}, {_d('z', 'y')})) / max(c.rd), 4) AS dunn
      FROM cd c JOIN dk x ON x.species = c.s1 JOIN dk z ON z.species = c.s2 CROSS JOIN sel{k} s JOIN dk y ON y.species = s.sp GROUP BY 1, 2, 3, 4),
    bs{k} AS (SELECT * FROM du{k} ORDER BY dunn DESC, ad DESC, pn DESC, s1, s2 LIMIT 1),
    p{k} AS (SELECT * FROM {prev} UNION ALL SELECT s1, s2, {k}, dunn FROM bs{k} WHERE dunn >= 1 AND (SELECT count(*) FROM {prev}) = {k - 1})"""
        prev = f"p{k}"
    return sql + f" SELECT s1 AS species1, s2 AS species2, cluster, dunn FROM {prev}"


@query("tr09", _greedy())
def tr09(t):
    """Greedy independent pair selection."""
    rows = C.select_pairs(cat(t), A.lifting(t.tree), "n_population")
    return t.spark.createDataFrame([(r["species1"], r["species2"], r["cluster"], r["dunn"]) for r in rows],
                                   "species1 string, species2 string, cluster int, dunn double")


@query("flt15", CAT + " SELECT species, CASE WHEN value >= hi THEN 'top' ELSE 'bottom' END AS side FROM ct WHERE category <> 'intermediate'")
def flt15(t):
    """Extreme species by global label."""
    return C.extreme_species(C.labels(t.traits, C.thresholds(t.traits)))


@query("flt12", "SELECT species, value FROM {traits} WHERE taxon NOT IN ('NATION_1', 'NATION_7')")
def flt12(t):
    """Prune listed taxa from the trait table."""
    gone = t.nation.where("n_name IN ('NATION_1', 'NATION_7')").select(F.col("n_name").alias("taxon"))
    return t.traits.join(gone, "taxon", "left_anti").select("species", "value")


@query("ps20", "SELECT species, CASE WHEN value > 0 THEN 1 ELSE 0 END AS recoded, 'binary' AS trait_type FROM {traits}")
def ps20(t):
    """Trait type detection and binary recode."""
    df = t.traits.select("species", F.when(F.col("value") > 0, 7).otherwise(3).alias("value"))
    return C.recode_binary(df).select("species", "recoded", F.lit(C.trait_type(df)).alias("trait_type"))


# ------------------------------------------------------------------ trees
CLO = """WITH RECURSIVE anc(node, ancestor, up, dist) AS (
      SELECT node_id, node_id, 0, CAST(0 AS DOUBLE) FROM {tree} UNION ALL
      SELECT a.node, e.parent_id, a.up + 1, a.dist + e.branch_length FROM anc a JOIN {tree} e ON a.ancestor = e.node_id WHERE e.parent_id IS NOT NULL)"""
MEM = "mem AS (SELECT clade AS set_id, species FROM {traits})"
_MR = ", nt AS (SELECT set_id, count(*) AS n_tips FROM mem GROUP BY 1), dep AS (SELECT node, max(up) AS depth FROM anc GROUP BY 1), cm AS (SELECT m.set_id, a.ancestor, count(*) AS k FROM mem m JOIN {tree} e ON e.name = m.species JOIN anc a ON a.node = e.node_id GROUP BY 1, 2), mr AS (SELECT c.set_id, arg_max(c.ancestor, d.depth) AS m FROM cm c JOIN nt ON nt.set_id = c.set_id AND nt.n_tips = c.k JOIN dep d ON d.node = c.ancestor GROUP BY 1)"


def members(t):
    return t.traits.select(F.col("clade").alias("set_id"), "species")


@query("tr01", "SELECT name, branch_length FROM {tree} WHERE node_id NOT IN (SELECT parent_id FROM {tree} WHERE parent_id IS NOT NULL)")
def tr01(t):
    """Tip labels."""
    return T.tips(t.tree).select("name", "branch_length")


@query("tr01_postorder", CLO + """, pth AS (SELECT a.node, string_agg(e.name, '/' ORDER BY a.up DESC) AS k FROM anc a JOIN {tree} e ON e.node_id = a.ancestor GROUP BY a.node)
    SELECT node, row_number() OVER (ORDER BY concat(k, '/', chr(65535)), node) - 1 AS postorder_id FROM pth""")
def tr01_postorder(t):
    """Post-order node ids."""
    return T.postorder_ids(t.tree).select("node", "postorder_id")


@query("tr02", CLO + ", " + MEM + _MR + " SELECT nt.set_id, n_tips, CASE WHEN n_tips >= 2 THEN m END AS mrca FROM nt LEFT JOIN mr ON mr.set_id = nt.set_id")
def tr02(t):
    """Most recent common ancestors."""
    return T.mrca(t.tree, members(t))


MEM2 = "mem AS (SELECT taxon AS set_id, species FROM {traits})"


@query("ag34", CLO + ", " + MEM2 + _MR + " SELECT nt.set_id, n_tips, CASE WHEN n_tips >= 2 THEN m ELSE (SELECT min(e.node_id) FROM mem JOIN {tree} e ON e.name = mem.species WHERE mem.set_id = nt.set_id) END AS node FROM nt LEFT JOIN mr ON mr.set_id = nt.set_id")
def ag34(t):
    """Tips and node per taxon, single species mapped to its tip."""
    return T.taxon_mrca(t.tree, t.traits.select(F.col("taxon").alias("set_id"), "species"))


@query("tr04", CLO + """, kt AS (SELECT e.node_id FROM {tree} e JOIN {traits} t ON t.species = e.name WHERE t.sid % 4 = 0),
    al AS (SELECT DISTINCT a.ancestor AS node_id FROM anc a JOIN kt ON kt.node_id = a.node),
    br AS (SELECT e.parent_id AS node_id FROM {tree} e JOIN al ON al.node_id = e.node_id WHERE e.parent_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2),
    nd AS (SELECT node_id FROM br UNION SELECT node_id FROM kt),
    pr AS (SELECT a.node, arg_min(a.ancestor, a.up) AS parent_id, min(a.dist) AS bl FROM anc a JOIN nd ON nd.node_id = a.node JOIN nd x ON x.node_id = a.ancestor WHERE a.up > 0 GROUP BY a.node)
    SELECT nd.node_id, pr.parent_id, e.name, coalesce(pr.bl, 0e0) AS branch_length FROM nd JOIN {tree} e ON e.node_id = nd.node_id LEFT JOIN pr ON pr.node = nd.node_id""")
def tr04(t):
    """Prune to species with unary nodes suppressed."""
    return T.prune(t.tree, t.traits.where("sid % 4 = 0"))


@query("tr04_polytomy", "SELECT parent_id AS node_id, count(*) AS n_children FROM {tree} WHERE parent_id IS NOT NULL GROUP BY parent_id HAVING count(*) > 2")
def tr04_polytomy(t):
    """Polytomy check."""
    return T.polytomies(t.tree)


@query("tr05", CLO + " SELECT e.name, string_agg(CAST(a.ancestor AS VARCHAR), ',' ORDER BY a.up DESC) AS nodes FROM anc a JOIN {tree} e ON e.node_id = a.node WHERE a.node NOT IN (SELECT parent_id FROM {tree} WHERE parent_id IS NOT NULL) GROUP BY e.name")
def tr05(t):
    """Root-to-tip paths."""
    return T.paths_to_tips(t.tree).select("name", F.array_join(F.transform("nodes", lambda x: x.cast("string")), ",").alias("nodes"))


@query("tr05_between", "WITH " + DIST + """ SELECT a.species AS species1, b.species AS species2,
      CASE WHEN a.nk = b.nk THEN 100 + a.nk WHEN a.rk = b.rk THEN 1 + a.rk ELSE 0 END AS mrca,
      CASE WHEN a.nk = b.nk THEN concat(1000 + a.s_suppkey, ',', 100 + a.nk, ',', 1000 + b.s_suppkey)
           WHEN a.rk = b.rk THEN concat(1000 + a.s_suppkey, ',', 100 + a.nk, ',', 1 + a.rk, ',', 100 + b.nk, ',', 1000 + b.s_suppkey)
           ELSE concat(1000 + a.s_suppkey, ',', 100 + a.nk, ',', 1 + a.rk, ',0,', 1 + b.rk, ',', 100 + b.nk, ',', 1000 + b.s_suppkey) END AS nodes
    FROM dk a JOIN dk b ON b.s_suppkey = a.s_suppkey + 1""")
def tr05_between(t):
    """Node-to-node paths through the MRCA."""
    s = t.traits.select("sid", "species")
    pairs = s.select("sid", F.col("species").alias("species1")).join(s.select((F.col("sid") - 1).alias("sid"), F.col("species").alias("species2")), "sid").drop("sid")
    return T.node_path(t.tree, pairs).select("species1", "species2", "mrca", F.array_join(F.transform("nodes", lambda x: x.cast("string")), ",").alias("nodes"))


@query("tr06", CLO + ", mem AS (SELECT CAST(sid % 7 AS INT) AS set_id, species FROM {traits})" + _MR + """,
    fo AS (SELECT nt.set_id AS pair_id, CASE WHEN n_tips >= 2 THEN m ELSE (SELECT min(e.node_id) FROM mem JOIN {tree} e ON e.name = mem.species WHERE mem.set_id = nt.set_id) END AS focal_node FROM nt LEFT JOIN mr ON mr.set_id = nt.set_id),
    bt AS (SELECT DISTINCT a.node FROM anc a JOIN fo ON fo.focal_node = a.ancestor WHERE a.node NOT IN (SELECT parent_id FROM {tree} WHERE parent_id IS NOT NULL)),
    cc AS (SELECT arg_max(a.ancestor, d.depth) AS mc FROM (SELECT a.ancestor, count(*) AS k FROM anc a JOIN bt ON bt.node = a.node GROUP BY 1) a JOIN dep d ON d.node = a.ancestor WHERE a.k = (SELECT count(*) FROM bt))
    SELECT pair_id, focal_node, mc AS mrca_contrast FROM fo CROSS JOIN cc""")
def tr06(t):
    """Focal node per pair and the contrast node."""
    pairs = t.traits.select((F.col("sid") % 7).cast("int").alias("pair_id"), "species")
    return T.focal_nodes(t.tree, pairs)


@query("tr15", CLO + ", " + MEM + _MR + """ SELECT m.set_id, m.species, mr.m AS mrca, string_agg(CAST(a.ancestor AS VARCHAR), ',' ORDER BY a.up DESC) AS nodes
    FROM mem m JOIN mr ON mr.set_id = m.set_id JOIN nt ON nt.set_id = m.set_id AND nt.n_tips >= 2 JOIN {tree} e ON e.name = m.species JOIN anc a ON a.node = e.node_id
    JOIN anc z ON z.node = e.node_id AND z.ancestor = mr.m WHERE a.up <= z.up GROUP BY 1, 2, 3""")
def tr15(t):
    """Contrast node map: MRCA to tip paths."""
    return T.contrast_map(t.tree, members(t)).select("set_id", "species", "mrca", F.array_join(F.transform("nodes", lambda x: x.cast("string")), ",").alias("nodes"))


@query("jn16", "SELECT coalesce(e.name, t.species) AS label, e.node_id, t.value FROM {tree} e FULL JOIN (SELECT * FROM {traits}) t ON t.species = e.name")
def jn16(t):
    """Tree table full outer joined to traits."""
    tr = t.traits.select(F.col("species").alias("name"), "value")
    return t.tree.join(tr, "name", "full").select(F.col("name").alias("label"), "node_id", "value")


TAX = "tax AS (SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS species, CAST(s_suppkey % 40 AS BIGINT) AS tax_id FROM {supplier}), ali AS (SELECT species FROM {traits} WHERE sid % 3 <> 1)"


def tax(t):
    return t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("species"), (F.col("s_suppkey") % 40).alias("tax_id"))


def ali(t):
    return t.traits.where("sid % 3 <> 1").select("species")


@query("jn23", "WITH " + TAX + """, rep AS (SELECT tax_id, min(a.species) AS nm FROM ali a JOIN tax ON tax.species = a.species GROUP BY 1)
    SELECT t.species AS original_name, CASE WHEN a.species IS NOT NULL THEN t.species ELSE coalesce(r.nm, '') END AS curated_name,
      CASE WHEN a.species IS NOT NULL THEN 'kept' WHEN r.nm IS NOT NULL THEN 'renamed' ELSE 'pruned' END AS fate
    FROM {traits} t LEFT JOIN ali a ON a.species = t.species LEFT JOIN tax x ON x.species = t.species LEFT JOIN rep r ON r.tax_id = x.tax_id""")
def jn23(t):
    """Tip curation with fate report."""
    return T.match_tips(t.traits.select(F.col("species").alias("tip")), ali(t), tax(t))


@query("jn24", "WITH " + TAX + """, j AS (SELECT a.species, tax.tax_id, row_number() OVER (PARTITION BY tax.tax_id ORDER BY a.species) AS rk FROM ali a JOIN tax ON tax.species = a.species)
    SELECT species, tax_id, tax_id AS unique_id FROM j WHERE rk = 1
    UNION ALL SELECT species, tax_id, (SELECT max(tax_id) FROM tax) + row_number() OVER (ORDER BY tax_id, species) FROM j WHERE rk > 1""")
def jn24(t):
    """Unique tax ids for alignment species."""
    return T.synthetic_tax_ids(ali(t), tax(t))


@query("jn22", "WITH " + TAX + """, rep AS (SELECT tax_id, min(a.species) AS nm FROM ali a JOIN tax ON tax.species = a.species GROUP BY 1),
    tv AS (SELECT t.species, x.tax_id, t.value FROM {traits} t JOIN tax x ON x.species = t.species)
    SELECT coalesce(r.nm, tv.species) AS species, tv.tax_id, tv.value FROM tv LEFT JOIN rep r ON r.tax_id = tv.tax_id WHERE coalesce(r.nm, tv.species) IN (SELECT species FROM ali)""")
def jn22(t):
    """Trait rows remapped through tax ids."""
    tv = t.traits.select("species", "value").join(tax(t), "species")
    return T.remap_traits(tv, ali(t).select(F.col("species").alias("tip")), tax(t)).select("species", "tax_id", "value")


@query("src21", "WITH " + TAX + " SELECT tax_id, count(*) AS n, string_agg(species, ',' ORDER BY species) AS names FROM tax GROUP BY 1")
def src21(t):
    """Tax id to species names."""
    return tax(t).groupBy("tax_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("species")), ",").alias("names"))


@query("sc30", "SELECT concat(c_name, '_', CAST(c_custkey AS VARCHAR)) AS label, CAST(c_custkey AS VARCHAR) AS tax_id FROM {customer}")
def sc30(t):
    """Tax id from a tip label."""
    lab = F.concat("c_name", F.lit("_"), F.col("c_custkey").cast("string"))
    return t.customer.select(lab.alias("label"), F.element_at(F.split(lab, "_"), -1).alias("tax_id"))


# ------------------------------------------------------------------ resampling
def _cycles(t):
    return t.supplier.select(F.concat(F.lit("b_"), F.col("s_suppkey").cast("string")).alias("cycle"))


@query("ps04", "SELECT concat('b_', CAST(s_suppkey AS VARCHAR)) AS cycle, 5 AS n_fg, 6 AS n_bg, 0 AS n_shared FROM {supplier}")
def ps04(t):
    """Random resampling: sizes and disjointness per cycle."""
    r = R.random_labels(_cycles(t), t.species, 5, 6)
    return r.select("cycle", F.size("fg").alias("n_fg"), F.size("bg").alias("n_bg"), F.size(F.array_intersect("fg", "bg")).alias("n_shared"))


@query("ps05", """SELECT concat('b_', CAST(s_suppkey AS VARCHAR)) AS cycle, taxon, n_fg, n_bg FROM {supplier} CROSS JOIN (
    SELECT sp.taxon, count(*) FILTER (c.grp = 1) AS n_fg, count(*) FILTER (c.grp = 0) AS n_bg FROM {config} c JOIN {species} sp ON sp.species = c.species GROUP BY 1) z""")
def ps05(t):
    """Family-restricted resampling: every family keeps its template counts."""
    fam = t.species.select("species", F.col("taxon").alias("family"))
    r = R.family_labels(_cycles(t), t.config, fam)
    long = r.select("cycle", F.explode("fg").alias("species"), F.lit(1).alias("grp")).union(r.select("cycle", F.explode("bg"), F.lit(0)))
    return long.join(t.species, "species").groupBy("cycle", "taxon").agg(F.count_if(F.col("grp") == 1).alias("n_fg"), F.count_if(F.col("grp") == 0).alias("n_bg"))


@query("ps06_values", """WITH g AS (SELECT *, CASE WHEN value > 5e3 THEN 1 WHEN value < -5e2 THEN 0 END AS grp FROM {traits})
    SELECT grp, count(*) AS species_in_group, (SELECT count(*) FROM {supplier}) AS cycles, count(*) * (SELECT count(*) FROM {supplier}) AS drawn, 0 AS outside FROM g WHERE grp IS NOT NULL GROUP BY grp""")
def ps06_values(t):
    """Trait permutation: labels drawn for each group over all cycles, none twice in a cycle and none unknown."""
    cfg = t.traits.where("value > 5000 OR value < -500").select("species", (F.col("value") > 0).cast("int").alias("grp"))
    r = R.permulated_labels(_cycles(t), t.tree, t.traits.select("species", "value"), cfg)
    # A cycle is one row, so it is made distinct there; species are counted before they meet the known ones.
    side = lambda g, c: F.struct(F.lit(g).alias("grp"), F.array_distinct(c).alias("species"))
    long = r.select("cycle", F.inline(F.array(side(1, "fg"), side(0, "bg")))).select("cycle", "grp", F.posexplode("species").alias("_k", "species"))
    times = long.groupBy("grp", "species").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("_k") == 0) & F.col("cycle").isNotNull()).alias("firsts"))
    known = times.join(t.traits.groupBy("species").agg(F.count(F.lit(1)).alias("_in")), "species", "left")
    out = known.groupBy("grp").agg(F.sum("firsts").alias("cycles"), F.sum(F.col("n") * F.coalesce("_in", F.lit(1))).alias("drawn"), F.coalesce(F.sum(F.when(F.col("_in").isNull(), F.col("n"))), F.lit(0)).cast("int").alias("outside"))
    return out.join(cfg.groupBy("grp").agg(F.count(F.lit(1)).alias("species_in_group")), "grp")


@query("ps06", "WITH c AS (SELECT count(*) FILTER (value > 5e3) AS f, count(*) FILTER (value < -5e2) AS b FROM {traits}) SELECT concat('b_', CAST(s_suppkey AS VARCHAR)) AS cycle, CAST(f AS INT) AS n_fg, CAST(b AS INT) AS n_bg, 0 AS n_shared FROM {supplier} CROSS JOIN c")
def ps06(t):
    """Trait permutation on the tree: group sizes and disjointness per cycle."""
    cfg = t.traits.where("value > 5000 OR value < -500").select("species", (F.col("value") > 0).cast("int").alias("grp"))
    r = R.permulated_labels(_cycles(t), t.tree, t.traits.select("species", "value"), cfg)
    return r.select("cycle", F.size("fg").alias("n_fg"), F.size("bg").alias("n_bg"), F.size(F.array_intersect("fg", "bg")).alias("n_shared"))
