"""Label resampling: random, family-restricted and trait-permutation on a tree.

Every draw is a hash of (seed, cycle, species or edge), so it is repeatable after task loss.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.hashing import Hashed, hash_number
from sitewise.operators.columns import MAX_SPECIES
from sitewise.operators.ordering import cumulative_counts
from sitewise.operators.trees import closure
from sitewise.session import checkpoint


def cycles(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).select(F.concat(F.lit("b_"), F.col("id").cast("string")).alias("cycle"))


def _bounded(species: DataFrame) -> None:
    """More species than the bound is an error, never a cut."""
    if species.count() > MAX_SPECIES:
        raise ValueError(f"more than {MAX_SPECIES} species")


def _first(names: Column, k: Column, seed: int) -> Column:
    """The ``k`` names with the smallest hashes of (seed, cycle, name), in that order.

    Only names below a threshold that ``k`` of them almost surely pass are sorted; where they
    do not, all are.
    """
    keyed = F.transform(names, lambda s: F.struct(F.xxhash64(F.lit(seed), F.col("cycle"), s).alias("h"), s.alias("s")))
    share = F.least(F.lit(1.0), (k + 6 * F.sqrt(k.cast("double")) + 12) / F.greatest(F.size(names), F.lit(1)))
    limit = ((2 * share - 1) * float(1 << 63)).cast("long")
    few = F.filter(keyed, lambda x: x["h"] <= limit)
    return F.transform(F.slice(F.array_sort(F.when(F.size(few) >= k, few).otherwise(keyed)), F.lit(1), k), lambda x: x["s"])


def random_labels(cycle_df: DataFrame, species: DataFrame, n_fg: int, n_bg: int, seed: int = 1) -> DataFrame:
    """Foreground and background drawn without replacement from all species.

    The names are one row of data, at most the species bound.  Fewer species than labels are an
    error; no species at all give empty draws.
    """
    names = checkpoint(species.select("species").where("species IS NOT NULL").distinct())
    _bounded(names)
    one = checkpoint(names.agg(F.array_sort(F.collect_list("species")).alias("_names")))
    found = one.select(F.size("_names")).first()[0]
    if found and n_fg + n_bg > found:
        raise ValueError(f"{n_fg} + {n_bg} labels asked of {found} species")
    drawn = cycle_df.join(F.broadcast(one)).withColumn("_o", _first(F.col("_names"), F.lit(n_fg + n_bg), seed))  # one row
    return drawn.select("cycle", F.array_sort(F.slice("_o", 1, n_fg)).alias("fg"), F.array_sort(F.slice("_o", n_fg + 1, n_bg)).alias("bg"))


def family_labels(cycle_df: DataFrame, template: DataFrame, families: DataFrame, seed: int = 1) -> DataFrame:
    """Each template species replaced by a random member of its family, never reused.

    ``template`` is ``species, grp``; ``families`` is ``species, family``.  A family too
    small for its template raises instead of looping.  The families that the template needs
    are one row of data, and one expression draws from each.
    """
    wanted = template.join(families, "species").groupBy("family").agg(
        F.count_if(F.col("grp") == 1).cast("int").alias("n_fg"), F.count_if(F.col("grp") == 0).cast("int").alias("n_bg"))
    known = checkpoint(families.where("species IS NOT NULL").join(wanted.select("family"), "family", "left_semi").select("family", "species").distinct())
    _bounded(known)
    rows = checkpoint(wanted.join(known.groupBy("family").agg(F.array_sort(F.collect_list("species")).alias("members")), "family"))
    short = rows.where(F.col("n_fg") + F.col("n_bg") > F.size("members")).agg(F.array_sort(F.collect_list("family"))).first()[0]
    if short:
        raise ValueError(f"families too small for the template: {', '.join(short)}")
    one = checkpoint(rows.agg(F.array_sort(F.collect_list(F.struct("family", "members", "n_fg", "n_bg"))).alias("_families")))
    drawn = F.transform("_families", lambda f: F.struct(_first(f["members"], f["n_fg"] + f["n_bg"], seed).alias("o"), f["n_fg"].alias("a"), f["n_bg"].alias("b")))
    df = cycle_df.join(F.broadcast(one)).withColumn("_d", drawn)  # one row
    side = lambda take: F.array_sort(F.flatten(F.transform("_d", take)))
    return df.select("cycle", side(lambda d: F.slice(d["o"], F.lit(1), d["a"])).alias("fg"), side(lambda d: F.slice(d["o"], d["a"] + 1, d["b"])).alias("bg"))


#: Terms of simulated values that a task adds up, and tips of the cycles that are returned at once.
TERMS, RETURNED = 1 << 27, 1 << 20


#: Types of node ids that are hashed as they are; others are as strings.
_HASHED = {"int": "int", "smallint": "int", "tinyint": "int", "bigint": "bigint"}


def _normal(radius: np.ndarray, angle: np.ndarray) -> np.ndarray:
    """Standard normal numbers from two hashes."""
    uniform = lambda h: ((h & ((1 << 53) - 1)) + 0.5) / float(1 << 53)
    return np.sqrt(-2 * np.log(uniform(radius))) * np.cos(2 * math.pi * uniform(angle))


def _permulated(tasks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Draws of the cycles of each row, which holds the tree, the ranks of each group and its cycles."""
    for batch in tasks:
        for r in range(batch.num_rows):
            row = {n: batch.column(n)[r] for n in batch.schema.names}
            names, tree, cycles = row["names"].values, row["lines"].values, row["cycles"].values
            starts = np.concatenate([[0], np.cumsum(row["sizes"].values.to_numpy())[:-1]])
            ends, edge = np.unique(tree.field("ancestor").to_numpy(zero_copy_only=False), return_inverse=True)
            edges, known, weight = Hashed(pa.array(ends, tree.field("ancestor").type)), Hashed(names), tree.field("w").to_numpy()
            groups = [(g, row[f"n{g}"].as_py(), row[f"ranks{g}"].values.to_numpy() - 1) for g in (1, 0)]
            wide = row["wide"].as_py()
            step = max(1, RETURNED // max(1, len(names)))
            for low in range(0, len(cycles), step):
                part = cycles.slice(low, step)
                sides: dict[int, list[np.ndarray]] = {1: [], 0: []}
                for copies, radius, angle, label in zip(*(part.field(c).to_numpy() for c in ("copies", "radius", "angle", "label"))):
                    moved = np.add.reduceat(weight * _normal(edges.seeded(radius), edges.seeded(angle))[edge], starts)
                    order = np.argsort(moved, kind="stable")  # names are in order, so equal values go by name
                    order = np.repeat(order, copies) if copies > 1 else order
                    for g, n, ranks in groups:
                        found = order[ranks]
                        if len(found) > n:
                            h = hash_number(g, wide, known.seeded(label))[found]
                            found = found[np.lexsort((found, h))[:n]]
                        sides[g].append(np.sort(found))
                lists = [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in sides[g]])]).astype(np.int32), names.take(pa.array(np.concatenate(sides[g])))) for g in (1, 0)]
                yield pa.RecordBatch.from_arrays([part.field("cycle"), *lists], ["cycle", "fg", "bg"])


def permulated_labels(cycle_df: DataFrame, edges: DataFrame, values: DataFrame, config: DataFrame, seed: int = 1) -> DataFrame:
    """Brownian simulation on the tree, real values reassigned by rank, labels resampled.

    ``values`` is ``species, value``.  Every (cycle, edge) has a normal number from a hash,
    times the root of its length; a tip's value in a cycle is their sum over its ancestors.
    The ancestors of all tips are one row of data, and a cycle is simulated, ranked and drawn
    within a task, so no (cycle, tip) is a row and none is shuffled or written.  Tips are
    ranked within the cycle and take the real value of
    their rank.  Only ranks are used, so the rate constant does not matter.  Foreground labels
    go to species now holding a foreground value, by smallest hashes, background likewise.
    Species without a value or outside the tree take no part; equal simulated values, and
    equal real ones, go by name.  Negative lengths count as 0.  In a cycle that is named several
    times each tip has as many ranks.
    """
    real = values.where("value IS NOT NULL AND species IS NOT NULL").groupBy("species").agg(F.max("value").cast("double").alias("value"))
    lines = closure(edges).join(real.withColumnRenamed("species", "name"), "name", "left_semi")
    length = edges.where("parent_id IS NOT NULL").select(F.col("node_id").alias("ancestor"), F.sqrt(F.greatest(F.col("branch_length").cast("double"), F.lit(0.0))).alias("_w"))
    lines = lines.select("name", "ancestor").join(length, "ancestor", "left").groupBy("name", "ancestor").agg(F.sum(F.coalesce("_w", F.lit(0.0))).alias("w"))
    lines = checkpoint(lines.withColumn("ancestor", F.col("ancestor").cast(_HASHED.get(dict(lines.dtypes)["ancestor"], "string"))))
    tips = checkpoint(real.join(lines.select(F.col("name").alias("species")).distinct(), "species"))
    own = config.select("species", "grp").distinct().join(tips, "species")
    sides = {r["grp"]: r["n"] for r in own.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a group
    if not sides.get(1) or not sides.get(0):
        raise ValueError("foreground or background is empty after removing species without a value")
    order = cumulative_counts(tips, [], ["value", "species"]).select((F.col("before") + 1).cast("int").alias("_r"), "value")
    sets = checkpoint(own.select("grp", "value").distinct())
    ranks = order.join(sets, "value").agg(*[F.array_sort(F.collect_list(F.when(F.col("grp") == g, F.col("_r")))).alias(f"ranks{g}") for g in (1, 0)])
    each = lines.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("ancestor", "w"))).alias("line"))
    tree = each.agg(F.array_sort(F.collect_list(F.struct("name", "line"))).alias("t")).select(
        F.col("t.name").alias("names"), F.transform("t", lambda x: F.size(x["line"])).alias("sizes"), F.flatten("t.line").alias("lines"))
    one = checkpoint(tree.crossJoin(ranks).select("*", *[F.lit(sides[g]).cast("long").alias(f"n{g}") for g in (1, 0)], F.lit(dict(config.dtypes)["grp"] == "bigint").alias("wide")))
    prefix = lambda *salt: F.xxhash64(*map(F.lit, salt), "cycle")
    drawn = cycle_df.groupBy("cycle").agg(F.count(F.lit(1)).alias("copies")).select(
        "cycle", "copies", prefix("radius", seed).alias("radius"), prefix("angle", seed).alias("angle"), prefix(seed, "label").alias("label"))
    drawn = checkpoint(drawn)
    n = drawn.count()
    tasks = max(1, min(n, max(cycle_df.sparkSession.sparkContext.defaultParallelism, -(-n * one.select(F.size("lines")).first()[0] // TERMS))))
    dealt = drawn.groupBy(F.pmod(F.xxhash64("cycle", F.lit("task")), F.lit(tasks)).alias("_task")).agg(F.collect_list(F.struct(*drawn.columns)).alias("cycles"))
    rows = dealt.drop("_task").repartition(tasks).join(F.broadcast(one))  # one row
    return rows.mapInArrow(_permulated, f"cycle {dict(cycle_df.dtypes)['cycle']}, fg array<string>, bg array<string>")


def with_observed(resamples: DataFrame, config: DataFrame) -> DataFrame:
    """Prepend the observed labels as cycle ``b_0``."""
    one = config.groupBy(F.lit("b_0").alias("cycle")).agg(
        F.array_sort(F.collect_list(F.when(F.col("grp") == 1, F.col("species")))).alias("fg"),
        F.array_sort(F.collect_list(F.when(F.col("grp") == 0, F.col("species")))).alias("bg"))
    return one.unionByName(resamples)
