"""Ancestral-state disambiguation: posteriors, node states, change classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions import labels as L
from sitewise.functions.schemes import RESIDUES, codes

# States that never take part in a change.
INVALID = ["-", "X", "?"]


def posterior_metrics(post: DataFrame) -> DataFrame:
    """MAP, margin to the runner-up and entropy per (gene, node, site) of long posteriors."""
    p = F.sort_array(F.collect_list("p"), asc=False)  # at most one entry per residue
    agg = post.groupBy("gene", "node_id", "site").agg(
        p.alias("ps"), (-F.sum(F.when(F.col("p") > 0, F.col("p") * F.ln("p")).otherwise(0.0))).alias("entropy"))
    first = F.element_at("ps", 1)
    second = F.coalesce(F.try_element_at("ps", F.lit(2)), F.lit(0.0))
    return agg.select("gene", "node_id", "site", first.alias("MAP"), (first - second).alias("margin"), "entropy")


def modal_states(post: DataFrame) -> DataFrame:
    """Most probable residue per (gene, node, site); ties go to the first residue."""
    key = F.struct(F.col("p"), (-F.ascii("aa")).alias("o"))
    return post.groupBy("gene", "node_id", "site").agg(F.max_by("aa", key).alias("state"), F.max("p").alias("prob"))


def node_states(modal: DataFrame, nodes: DataFrame, threshold: float = 0.7) -> DataFrame:
    """States of the mapped nodes per (gene, site) with the list of low-confidence roles.

    ``nodes`` is ``role, node_id`` (``root``, ``mrca_contrast``, ``focal_1`` ...), a dimension
    of one row per role.  Sites without a root, contrast or any focal state drop out.
    """
    j = modal.join(nodes, "node_id")
    low = F.sort_array(F.collect_set(F.when(F.col("prob") < threshold, F.col("role"))))
    out = j.groupBy("gene", "site").agg(
        F.max(F.when(F.col("role") == "root", F.col("state"))).alias("root"),
        F.max(F.when(F.col("role") == "mrca_contrast", F.col("state"))).alias("mrca_contrast"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("role").startswith("focal_"), F.struct("role", "state"))))).alias("focal_states"),
        F.array_join(low, ",").alias("low_confidence_nodes"),
    )
    return out.where("root IS NOT NULL AND mrca_contrast IS NOT NULL AND size(focal_states) > 0")


def tip_residue(records: DataFrame) -> DataFrame:
    """First resolved residue per (gene, site, group) in group order ``idx``."""
    ok = F.col("residue").isNotNull() & ~F.col("residue").isin("-", "X")
    return records.groupBy("gene", "site", "grp").agg(F.min_by(F.when(ok, F.col("residue")), F.when(ok, F.col("idx"))).alias("residue"))


def map_state(state: Column, scheme: str | None) -> Column:
    """Upper-case state, replaced by its class code under ``scheme``; unmapped states stay."""
    aa = F.nullif(F.upper(F.trim(state)), F.lit(""))
    return aa if not scheme or scheme == "US" else F.translate(aa, RESIDUES, codes(scheme))


def classify(pairs: DataFrame, mode: str = "focal_clade", scheme: str | None = None) -> DataFrame:
    """Change and parallelism labels per (gene, site) from one row per pair.

    A pair needs a tip residue to count, and a site needs two such pairs.  Each site
    holds one row per contrast pair.
    """
    ancestor = map_state(F.col("mrca_state" if mode == "mrca" else "focal_state"), scheme)
    usable = pairs.where("top_tip IS NOT NULL OR bottom_tip IS NOT NULL")

    def changed(tip: str) -> Column:
        state = map_state(F.col(tip), scheme)
        ok = ancestor.isNotNull() & ~ancestor.isin(*INVALID) & state.isNotNull() & ~state.isin(*INVALID) & (ancestor != state)
        return F.when(ok, F.struct(F.col("pair_id"), state.alias("d"), ancestor.alias("a")))

    agg = usable.groupBy("gene", "site").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.array_sort(F.collect_list(changed("top_tip"))).alias("top"), F.array_sort(F.collect_list(changed("bottom_tip"))).alias("bottom"))
    enough = F.col("n_pairs") >= 2
    for side in ("top", "bottom"):
        label = L.change_class(F.transform(side, lambda x: x["d"]))
        par = L.parallelism(F.transform(side, lambda x: x["a"]))
        agg = agg.withColumn(f"change_{side}", F.when(enough, label).otherwise("no_change"))
        agg = agg.withColumn(f"parallel_{side}", F.when(F.col(f"change_{side}").isin(*L.SUBSTANTIVE), par))
    t, b = F.col("change_top"), F.col("change_bottom")
    return agg.select(
        "gene", "site", "change_top", "change_bottom", L.change_side(t, b).alias("change_side"), L.pattern_type(t, b).alias("pattern_type"),
        "parallel_top", "parallel_bottom", L.parallel_type(F.col("parallel_top"), F.col("parallel_bottom")).alias("parallel_type"))


def confirm_conserved(pairs: DataFrame, sites: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Whether every conserved pair is confirmed by its focal node, and whether the root agrees.

    ``sites`` is ``gene, site, is_conserved_meta, conserved_pair, root_state, root_prob``.
    """
    ids = F.filter(F.transform(F.split(F.coalesce("conserved_pair", F.lit("")), ","), lambda x: F.trim(x).try_cast("double").cast("int")), lambda x: x.isNotNull())
    want = sites.withColumn("ids", F.when(F.col("is_conserved_meta"), ids).otherwise(F.array().cast("array<int>")))
    per = pairs.groupBy("gene", "site").agg(
        F.map_from_entries(F.collect_list(F.struct("pair_id", F.struct("top_tip", "bottom_tip", "focal_state").alias("v")))).alias("m"),
        F.max("pair_id").alias("n"))
    j = want.join(per, ["gene", "site"], "left")
    kept = F.filter("ids", lambda i: (i >= 1) & (i <= F.col("n")))
    agree = F.transform(kept, lambda i: F.coalesce(
        (F.try_element_at("m", i)["top_tip"] == F.try_element_at("m", i)["bottom_tip"]) & (F.try_element_at("m", i)["top_tip"] == F.try_element_at("m", i)["focal_state"]), F.lit(False)))
    states = F.transform(kept, lambda i: F.try_element_at("m", i)["focal_state"])
    j = j.withColumn("asr_is_conserved", (F.size(agree) > 0) & F.forall(agree, lambda x: x))
    root = F.col("asr_is_conserved") & F.coalesce(F.array_contains(states, F.col("root_state")) & (F.col("root_prob") >= threshold), F.lit(False))
    return j.select("gene", "site", F.coalesce("asr_is_conserved", F.lit(False)).alias("asr_is_conserved"), F.coalesce(root, F.lit(False)).alias("asr_root_conserved"))


def conserved_flags(sites: DataFrame, pair_states: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``sites`` with ``is_conserved_meta``, ``conserved_pair``, ``asr_is_conserved`` and ``asr_root_conserved``, the flags as text.

    A hit of the scan is conserved where its ``ConservedPairs`` (``overlap:pair,pair``) count an
    overlap; without that column none is.  Confirmation is by site, over the pairs that any
    of its schemes names, against the states of ``pair_states``; the root is the site's
    ``mrca_state`` where those have one.
    """
    text = F.col("ConservedPairs") if "ConservedPairs" in sites.columns else F.lit(None).cast("string")
    some = F.coalesce(F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int") > 0, F.lit(False))
    rows = sites.withColumns({"is_conserved_meta": some, "conserved_pair": F.when(some, F.split_part(text, F.lit(":"), F.lit(2))).otherwise("")})
    named = rows.where("is_conserved_meta").select(F.col("Gene").alias("gene"), F.col("Position").alias("site"), F.explode(F.split("conserved_pair", ",")).alias("pair"))
    per = named.groupBy("gene", "site").agg(F.array_join(F.array_sort(F.collect_set("pair")), ",").alias("conserved_pair"), F.lit(True).alias("is_conserved_meta"))
    has_root = {"mrca_state", "posterior"} <= set(pair_states.columns)
    root = pair_states.groupBy("gene", "site").agg((F.max("mrca_state") if has_root else F.lit(None).cast("string")).alias("root_state"), (F.max("posterior") if has_root else F.lit(None).cast("double")).alias("root_prob"))
    seen = confirm_conserved(pair_states, per.join(root, ["gene", "site"], "left"), threshold)
    seen = seen.withColumnsRenamed({"gene": "Gene", "site": "Position"})
    words = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), "true").otherwise("false")
    return rows.join(seen, ["Gene", "Position"], "left").withColumns({c: words(c) for c in ("is_conserved_meta", "asr_is_conserved", "asr_root_conserved")})


def merge_hypotheses(results: DataFrame) -> DataFrame:
    """One row per (gene, position): sorted distinct tags, schemes, codes and patterns; flags or-ed."""
    def uniq(c: str, sep: str) -> Column:
        text = F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim(c), F.lit("")))), sep)
        return F.nullif(text, F.lit("")).alias(c)

    return results.groupBy("Gene", "Position").agg(
        uniq("tag", ","), uniq("CAAP_Group", ","), uniq("amino_encoded", ","), uniq("caas", "; "),
        *[F.bool_or(L.as_bool(F.col(c))).alias(c) for c in ("is_conserved_meta", "asr_is_conserved", "asr_root_conserved")])


def normal_residues(values: Column) -> Column:
    """Upper-case, resolved, distinct residues in input order."""
    up = F.transform(values, lambda v: F.upper(F.trim(v)))
    return F.array_distinct(F.filter(up, lambda v: v.isNotNull() & (v != "") & ~v.isin("-", "X", "?")))


def shown_residues(residues: Column) -> Column:
    return F.when(F.size(residues) == 0, "?").otherwise(F.array_join(residues, "+"))


def derived_similarity(derived: Column, scheme: str) -> Column:
    """Distinct classes of the derived states under a scheme: list, single-class flag, text."""
    mapped = F.filter(F.transform(derived, lambda a: F.when(F.contains(F.lit(RESIDUES), a), F.translate(a, RESIDUES, codes(scheme)))), lambda x: x.isNotNull())
    groups = F.array_distinct(mapped)
    one = F.size(groups) == 1
    text = F.when(one, F.concat(F.lit("All in "), F.try_element_at(groups, F.lit(1)))).otherwise(
        F.concat(F.lit("Across "), F.size(groups).cast("string"), F.lit(" groups: "), F.array_join(groups, "/")))
    return F.struct(F.array_join(groups, ",").alias("groups"), one.alias("convergent"), text.alias("description"))


def comments(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Review comments per site: unresolved or weak pair posteriors and too few changes."""
    part = F.when(F.col("posterior") == 0, F.concat(F.lit("pair"), F.col("pair_id").cast("string"), F.lit("_fallback:"), F.coalesce("focal_state", F.lit("?")))).when(
        F.col("posterior") < 0.5, F.concat(F.lit("pair"), F.col("pair_id").cast("string"), F.lit("_low_posterior:"), F.format_string("%.3f", "posterior")))
    per = pairs.groupBy("gene", "site").agg(F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct("pair_id", part.alias("c"))))).alias("cs"))
    few = ~F.col("change_top").isin(*L.SUBSTANTIVE) & ~F.col("change_bottom").isin(*L.SUBSTANTIVE)
    tail = F.when(few, F.concat(F.lit("insufficient_changes(top="), "change_top", F.lit(",bottom="), "change_bottom", F.lit(")")))
    return labels.join(per, ["gene", "site"], "left").select(
        "gene", "site", F.concat_ws(";", F.transform("cs", lambda x: x["c"]), tail).alias("comments"))


def focus_transitions(pairs: DataFrame, side: str = "top") -> DataFrame:
    """Convergent / divergent / ambiguous label of one side from resolved transitions."""
    anc = F.coalesce(F.nullif("focal_state", F.lit("")), F.col("mrca_state"))
    known = pairs.withColumn("s", L.transition_status(anc, F.col(f"{side}_tip"))).where("s <> 'unknown'")
    agg = known.groupBy("gene", "site").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(F.col(f"{side}_tip"))).alias("d"), F.array_sort(F.collect_set(anc)).alias("a"))
    every = pairs.select("gene", "site").distinct().join(agg, ["gene", "site"], "left")
    few = F.coalesce("n", F.lit(0)) < 2
    return every.select(
        "gene", "site", F.when(few, "ambiguous").when(F.size("d") == 1, "convergent").otherwise("divergent").alias("label"),
        F.when(few, "Not enough resolved transitions").otherwise(
            F.concat(F.lit("Ancestors="), F.array_join("a", ","), F.lit(" Descendants="), F.array_join("d", ","))).alias("detail"))


def pair_multiset(pairs: DataFrame) -> DataFrame:
    """``AAA/VVI``: tips of both sides in pair order; a pair with an absent or gapped side is skipped."""
    ok = pairs.where("top_tip IS NOT NULL AND bottom_tip IS NOT NULL AND top_tip <> '-' AND bottom_tip <> '-'")
    m = F.array_sort(F.collect_list(F.struct("pair_id", "top_tip", "bottom_tip")))
    return ok.groupBy("gene", "site").agg(m.alias("m")).select("gene", "site", F.concat_ws(
        "/", F.array_join(F.transform("m", lambda x: x["top_tip"]), ""), F.array_join(F.transform("m", lambda x: x["bottom_tip"]), "")).alias("multiset"))


def pivot_pairs(pairs: DataFrame, values: list[str], n_pairs: int, prefix: str = "mrca_{i}_{v}") -> DataFrame:
    """One row per (gene, site) with a column per pair and value; the pair count is given, so no extra job."""
    names = [(i, v, prefix.format(i=i, v=v)) for i in range(1, n_pairs + 1) for v in values]
    return pairs.groupBy("gene", "site").agg(*[F.max(F.when(F.col("pair_id") == i, F.col(v))).alias(n) for i, v, n in names])


def pair_metrics(pairs: DataFrame, metrics: DataFrame, n_pairs: int) -> DataFrame:
    """Node metrics of each pair's node, averaged over duplicates and pivoted to margin1, entropy1 ..."""
    j = pairs.select("gene", "site", "pair_id", "node_id").join(metrics, ["gene", "site", "node_id"], "left")
    return j.groupBy("gene", "site").agg(*[
        F.avg(F.when(F.col("pair_id") == i, F.col(v))).alias(f"{v}{i}") for v in ("margin", "entropy") for i in range(1, n_pairs + 1)])


def site_posteriors(wide: DataFrame, cols: list[str], tau: float) -> DataFrame:
    """Smallest and product posterior over pairs and the PASS flag (missing pairs are skipped in the minimum)."""
    prod = F.lit(1.0)
    for c in cols:
        prod = prod * F.col(c)
    low = F.least(*cols) if len(cols) > 1 else F.col(cols[0])
    return wide.withColumn("p_min", low).withColumn("p_prod", prod).withColumn("PASS", F.col("p_min") >= tau)


def tau_grid(sites: DataFrame, taus: list[float]) -> DataFrame:
    """Retention at each threshold; the grid is unfolded after one conditional aggregation."""
    from sitewise.functions.arrays import entries

    per_gene = sites.groupBy("gene").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("p_min") >= t).alias(f"k{i}") for i, t in enumerate(taus)])
    one = per_gene.agg(F.sum("n").alias("n"), *[
        x for i in range(len(taus)) for x in (F.sum(f"k{i}").alias(f"k{i}"), F.count_if(F.col(f"k{i}") > 0).alias(f"g{i}"))])
    return one.select(F.inline(entries(
        ["tau", "N_sites_total", "N_sites_retained", "retention_fraction", "N_convergent_genes"],
        *[(float(t), F.col("n"), F.col(f"k{i}"), F.col(f"k{i}") / F.col("n"), F.col(f"g{i}")) for i, t in enumerate(taus)])))


def tau_overlap(sites: DataFrame, pairs: list[tuple[float, float]]) -> DataFrame:
    """Callset sizes, intersection and Jaccard of threshold pairs in one pass."""
    from sitewise.functions.arrays import entries

    p = F.col("p_min")
    one = sites.agg(*[x for i, (a, b) in enumerate(pairs) for x in (
        F.count_if(p >= a).alias(f"a{i}"), F.count_if(p >= b).alias(f"b{i}"), F.count_if((p >= a) & (p >= b)).alias(f"i{i}"))])
    rows = []
    for i, (a, b) in enumerate(pairs):
        union = F.col(f"a{i}") + F.col(f"b{i}") - F.col(f"i{i}")
        rows.append((float(a), float(b), F.col(f"a{i}"), F.col(f"b{i}"), F.col(f"i{i}"), union, F.when(union > 0, F.col(f"i{i}") / union)))
    return one.select(F.inline(entries(["tau_A", "tau_B", "n_A", "n_B", "n_intersect", "n_union", "jaccard"], *rows)))


def retention(sites: DataFrame, *keys: str) -> DataFrame:
    out = sites.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sites_total"), F.count_if("PASS").alias("sites_retained"), F.count_if(~F.col("PASS")).alias("sites_excluded"))
    return out.withColumn("retention_fraction", F.col("sites_retained") / F.col("sites_total"))


def map_statistics(metrics: DataFrame) -> DataFrame:
    """Distribution of the MAP posterior: moments, percentiles and fractions below cuts."""
    from sitewise.operators.ordering import quantiles

    pcts = [1, 5, 10, 20, 25, 40, 50, 60, 75, 80, 90, 95, 99]
    cuts = [1.0, 0.99, 0.95, 0.90, 0.80, 0.60]
    q = quantiles(metrics, [], "MAP", {f"pct_{p}": p / 100 for p in pcts})
    m = metrics.agg(
        F.count(F.lit(1)).alias("N_total"), F.avg("MAP").alias("mean"), F.stddev_samp("MAP").alias("sd"), F.min("MAP").alias("min"),
        F.max("MAP").alias("max"), *[F.avg((F.col("MAP") < c).cast("double")).alias(f"frac_lt_{int(round(c * 100))}") for c in cuts])
    return m.crossJoin(q)  # one row each
