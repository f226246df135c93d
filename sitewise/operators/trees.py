"""Tree operators on an edge table ``node_id, parent_id, name, branch_length``.

Ancestor closure is a logarithmic number of joins, for trees of any depth; everything else is
joins and aggregations over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.operators.ancestry import lifting, pair_ancestors, set_ancestors
from sitewise.operators.ordering import cumulative_counts
from sitewise.session import checkpoint


def closure(edges: DataFrame) -> DataFrame:
    """``node, name, ancestor, up, dist``: every node with each ancestor (itself included).

    Pointer doubling: jumps of 1, 2, 4, ... edges, each made of two of the last; a node's
    ancestors within twice the distance are those it has and those of where its jump ends.
    As many rounds as the depth has binary digits.
    """
    jump = checkpoint(edges.where("parent_id IS NOT NULL").select(
        F.col("node_id").alias("node"), F.col("parent_id").alias("to"), F.lit(1).alias("step"), F.col("branch_length").alias("len")))
    reach = edges.select(F.col("node_id").alias("node"), F.col("node_id").alias("ancestor"), F.lit(0).alias("up"), F.lit(0.0).alias("dist"))
    for _ in range(64):
        if jump.isEmpty():
            break
        far = jump.join(reach.withColumnRenamed("node", "to"), "to").select(
            "node", "ancestor", (F.col("step") + F.col("up")).alias("up"), (F.col("len") + F.col("dist")).alias("dist"))
        reach = checkpoint(reach.unionByName(far))
        on = jump.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("step").alias("step2"), F.col("len").alias("len2"))
        jump = checkpoint(jump.join(on, "to").select("node", F.col("to2").alias("to"), (F.col("step") + F.col("step2")).alias("step"), (F.col("len") + F.col("len2")).alias("len")))
    else:
        raise ValueError("the edges hold a cycle")
    return reach.join(edges.select(F.col("node_id").alias("node"), "name"), "node").select("node", "name", "ancestor", "up", "dist")


def root_paths(edges: DataFrame) -> DataFrame:
    """``node, name, path``: array of (depth, node, dist from root) from the root down to the node.

    An array is as long as the tree is deep.
    """
    c = closure(edges)
    total = c.groupBy("node").agg(F.max("up").alias("depth"), F.max("dist").alias("height"))
    steps = c.join(total, "node").select(
        "node", "name", F.struct((F.col("depth") - F.col("up")).alias("depth"), F.col("ancestor").alias("node"),
                                 (F.col("height") - F.col("dist")).alias("dist")).alias("s"))
    return steps.groupBy("node", "name").agg(F.sort_array(F.collect_list("s")).alias("path"))


def tips(edges: DataFrame) -> DataFrame:
    inner = edges.select(F.col("parent_id").alias("node_id")).where("node_id IS NOT NULL").distinct()
    return edges.join(inner, "node_id", "left_anti").select("node_id", "name", "branch_length")


def path_mrca(a: Column, b: Column) -> Column:
    """Deepest node on both root paths."""
    shared = F.filter(F.zip_with(a, b, lambda x, y: F.when(x["node"] == y["node"], x["node"])), lambda x: x.isNotNull())
    return F.element_at(shared, -1)


def all_pairs(left: DataFrame, right: DataFrame, block: int = 4096, least: int = 16) -> DataFrame:
    """Every (left, right) combination, where all of them are the result, as an equi-join.

    Both sides are dealt into blocks of about ``block`` rows, or ``least`` smaller ones, and each
    two blocks meet under a key of their own.  Rows are repeated once for each block of the other
    side and shuffled by key: they are never broadcast, for the planner takes them for the few
    rows that they were, and tasks are counted by keys, not by their few bytes.
    """
    n = lambda df: max(1, -(-(k := df.count()) // block), min(least, -(-k // 64)))
    a, b = n(left), n(right)
    tasks = min(a * b, 1024)
    dealt = lambda df, own, n, other, m: df.withColumn(own, F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).repartition(tasks, "_i", "_j")
    return dealt(left, "_i", a, "_j", b).join(dealt(right, "_j", b, "_i", a).hint("merge"), ["_i", "_j"]).drop("_i", "_j")


def patristic(edges: DataFrame, species: DataFrame) -> DataFrame:
    """Distance between every ordered pair of distinct species found in the tree."""
    tree = lifting(edges)
    p = tree.nodes.join(species.select(F.col("species").alias("name")).distinct(), "name", "left_semi")
    side = lambda k: p.select(F.col("name").alias(f"species{k}"), F.col("node").alias(f"node{k}"))
    return pair_ancestors(tree, all_pairs(side(1), side(2)).where("species1 <> species2")).select("species1", "species2", "distance")


def mrca(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Deepest common ancestor per ``set_id`` of ``set_id, species``; NULL below two tips."""
    leaves = tips(edges).select(F.col("name").alias("species"), F.col("node_id").alias("node"))
    found = set_ancestors(lifting(edges), members.select("set_id", "species").distinct().join(leaves, "species"))
    return found.select("set_id", F.col("n").alias("n_tips"), F.when(F.col("n") >= 2, F.col("ancestor")).alias("mrca"))


def taxon_mrca(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Node per taxon: the MRCA of its species, or the tip itself for a single species."""
    own = members.join(tips(edges).select(F.col("name").alias("species"), "node_id"), "species").groupBy("set_id").agg(
        F.min("node_id").alias("tip"))
    return mrca(edges, members).join(own, "set_id").select(
        "set_id", "n_tips", F.when(F.col("n_tips") == 1, F.col("tip")).otherwise(F.col("mrca")).alias("node"))


def postorder_ids(edges: DataFrame, start: int = 0) -> DataFrame:
    """Post-order numbering with children in name order."""
    p = root_paths(edges)
    names = edges.select(F.col("node_id").alias("sn"), F.col("name").alias("step"))
    # Names along the path, closed by a character above every name: descendants sort first.
    steps = p.select("node", "name", F.explode("path").alias("s")).join(names, F.col("s.node") == F.col("sn"))
    keyed = steps.groupBy("node", "name").agg(F.sort_array(F.collect_list(F.struct("s.depth", "step"))).alias("st"))
    key = F.concat(F.array_join(F.transform("st", lambda x: x["step"]), "/"), F.lit("/￿"))
    order = cumulative_counts(keyed.select("node", "name", key.alias("k")), [], ["k", "node", "name"])
    return order.select("node", "name", (F.col("before") + start).alias("postorder_id"))


def prune(edges: DataFrame, keep: DataFrame) -> DataFrame:
    """Subtree over the kept species with single-child nodes suppressed, lengths added up."""
    c = closure(edges)
    kept_tips = tips(edges).join(keep.select(F.col("species").alias("name")).distinct(), "name", "left_semi")
    lines = c.join(kept_tips.select(F.col("node_id").alias("node")), "node", "left_semi")
    alive = lines.select(F.col("ancestor").alias("node_id")).distinct()
    branching = (
        edges.join(alive, "node_id", "left_semi").where("parent_id IS NOT NULL")
        .groupBy("parent_id").agg(F.count(F.lit(1)).alias("k")).where("k >= 2").select(F.col("parent_id").alias("node_id"))
    )
    nodes = branching.union(kept_tips.select("node_id")).distinct()
    up = c.where("up > 0").join(nodes.select(F.col("node_id").alias("node")), "node", "left_semi").join(
        nodes.select(F.col("node_id").alias("ancestor")), "ancestor", "left_semi")
    parent = up.groupBy("node").agg(F.min(F.struct("up", "ancestor", "dist")).alias("p"))
    return nodes.join(edges.select("node_id", "name"), "node_id").join(parent.withColumnRenamed("node", "node_id"), "node_id", "left").select(
        "node_id", F.col("p.ancestor").alias("parent_id"), "name", F.coalesce("p.dist", F.lit(0.0)).alias("branch_length"))


def polytomies(edges: DataFrame) -> DataFrame:
    """Nodes with more than two children."""
    return edges.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("node_id")).agg(
        F.count(F.lit(1)).alias("n_children")).where("n_children > 2")


def paths_to_tips(edges: DataFrame) -> DataFrame:
    """Node ids from the root to each tip."""
    p = root_paths(edges)
    leaf = tips(edges).select(F.col("node_id").alias("node"))
    return p.join(leaf, "node", "left_semi").select("name", F.transform("path", lambda x: x["node"]).alias("nodes"))


def node_path(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Node ids between ``species1`` and ``species2`` through their MRCA."""
    p = root_paths(edges).select(F.col("name"), "path")
    j = pairs.join(p.select(F.col("name").alias("species1"), F.col("path").alias("p1")), "species1").join(
        p.select(F.col("name").alias("species2"), F.col("path").alias("p2")), "species2")
    top = path_mrca(F.col("p1"), F.col("p2"))
    up = F.reverse(F.transform("p1", lambda x: x["node"]))
    down = F.transform("p2", lambda x: x["node"])
    cut_up = F.slice(up, F.lit(1), F.array_position(up, top).cast("int"))
    k = F.array_position(down, top).cast("int")
    cut_down = F.when(F.size(down) > k, F.slice(down, k + 1, F.size(down) - k)).otherwise(F.array().cast("array<int>"))
    return j.select("species1", "species2", top.alias("mrca"), F.concat(cut_up, cut_down).alias("nodes"))


def focal_nodes(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Focal node of every pair and the contrast node above all of them.

    ``pairs`` is ``pair_id, species``.  A pair with one species in the tree falls back
    to that tip; the contrast node is the MRCA of all tips under the focal nodes.
    """
    per = taxon_mrca(edges, pairs.select(F.col("pair_id").alias("set_id"), "species")).select(
        F.col("set_id").alias("pair_id"), F.col("node").alias("focal_node"))
    c = closure(edges)
    below = c.join(per.select(F.col("focal_node").alias("ancestor")).distinct(), "ancestor", "left_semi").join(
        tips(edges).select(F.col("node_id").alias("node")), "node", "left_semi").select(F.lit(0).alias("set_id"), F.col("name").alias("species"))
    contrast = taxon_mrca(edges, below).select(F.col("node").alias("mrca_contrast"))
    return per.join(F.broadcast(contrast))  # one row


def contrast_map(edges: DataFrame, members: DataFrame) -> DataFrame:
    """MRCA of a contrast and the nodes from it down to each labelled tip."""
    m = mrca(edges, members).where("mrca IS NOT NULL")
    p = root_paths(edges).select(F.col("name").alias("species"), "path")
    j = members.join(m, "set_id").join(p, "species")
    nodes = F.transform("path", lambda x: x["node"])
    k = F.array_position(nodes, F.col("mrca")).cast("int")
    return j.select("set_id", "species", "mrca", F.slice(nodes, k, F.size(nodes) - k + 1).alias("nodes"))


def match_tips(tree_tips: DataFrame, alignment: DataFrame, tax: DataFrame) -> DataFrame:
    """Fate of every tree tip: kept by name, renamed through its tax id, or pruned.

    ``tree_tips`` is ``tip``, ``alignment`` is ``species``, ``tax`` is ``species, tax_id``.
    The alphabetically first alignment species represents a tax id.
    """
    by_id = alignment.join(tax, "species").groupBy("tax_id").agg(F.min("species").alias("ali_name"))
    ali = alignment.select(F.col("species").alias("tip"), F.lit(True).alias("_in")).distinct()
    out = tree_tips.join(ali, "tip", "left").join(tax.select(F.col("species").alias("tip"), "tax_id"), "tip", "left").join(by_id, "tax_id", "left")
    fate = F.when(F.col("_in"), "kept").when(F.col("ali_name").isNotNull(), "renamed").otherwise("pruned")
    name = F.when(F.col("_in"), F.col("tip")).otherwise(F.coalesce("ali_name", F.lit("")))
    return out.select(F.col("tip").alias("original_name"), name.alias("curated_name"), fate.alias("fate"))


def synthetic_tax_ids(alignment: DataFrame, tax: DataFrame) -> DataFrame:
    """Unique tax ids for alignment species: the first of a shared id keeps it, others get new ones.

    New ids continue above the largest known id in (tax id, species) order.
    """
    j = alignment.join(tax, "species")
    first = Window.partitionBy("tax_id").orderBy("species")
    ranked = j.withColumn("rk", F.row_number().over(first))
    top = tax.agg(F.max(F.col("tax_id").cast("long")).alias("_top"))
    extra = cumulative_counts(ranked.where("rk > 1"), [], ["tax_id", "species"]).select("tax_id", "species", "before")
    out = ranked.join(extra, ["tax_id", "species"], "left").join(F.broadcast(top))
    return out.select("species", "tax_id", F.when(F.col("rk") == 1, F.col("tax_id").cast("long")).otherwise(
        F.col("_top") + 1 + F.col("before")).alias("unique_id"))


def remap_traits(traits: DataFrame, tree_tips: DataFrame, tax: DataFrame) -> DataFrame:
    """Trait rows renamed to the tree species of their tax id; rows outside the tree drop out."""
    first = tree_tips.select(F.col("tip").alias("species")).join(tax, "species").groupBy("tax_id").agg(F.min("species").alias("tree_species"))
    named = traits.join(first, "tax_id", "left").withColumn("species", F.coalesce("tree_species", "species")).drop("tree_species")
    return named.join(tree_tips.select(F.col("tip").alias("species")), "species", "left_semi")
