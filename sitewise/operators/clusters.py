"""Positional cluster filter and run-length clusters."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewise.session import dealt

#: Positions, counted for each parameter pair, that a task sorts.
ROWS = 100_000


def clustered_positions(sites: DataFrame, params: list[tuple[int, float]], keys: tuple[str, ...] = ("Gene", "CAAP_Group")) -> DataFrame:
    """Flag positions inside any dense interval, for every ``(minlen, maxcaas)`` pair.

    With positions p_1 < ... < p_n an interval [l, r] is dense when
    ``(r - l + 1) / span >= maxcaas`` and ``span >= minlen``.  Writing
    ``F(i) = den*i - num*p_i`` (maxcaas = num/den) density reads
    ``F(r) + den - num >= F(l)``; the suffix maximum of F is non-increasing, so the
    furthest such r is a count of suffix maxima at or above ``F(l) - den + num``.
    That count comes from one ordered pass over the union of both values: no pair of
    positions is ever formed.  Groups hold distinct positions of one gene, at most
    its alignment length.
    """
    keys_l = list(keys)
    grid = F.array(
        *[
            F.struct(
                F.lit(int(m)).alias("minlen"),
                F.lit(float(d)).alias("maxcaas"),
                F.lit(Fraction(str(d)).numerator).cast("long").alias("num"),
                F.lit(Fraction(str(d)).denominator).cast("long").alias("den"),
            )
            for m, d in params
        ]
    )
    part = keys_l + ["minlen", "maxcaas"]
    g = Window.partitionBy(*part)
    rows = sites.select(*keys_l, "Position").na.drop(subset=keys_l)
    # Groups stay whole and all that follows keeps this deal, so a task's maps and sorts hold about so many rows at any size.
    base = dealt(rows, *keys_l, rows=rows.count() * len(params), each=ROWS).distinct().select("*", F.inline(grid))
    base = base.withColumn("i", F.row_number().over(g.orderBy("Position")).cast("long"))
    base = base.withColumn("n", F.count(F.lit(1)).over(g))
    base = base.withColumn("f", F.col("den") * F.col("i") - F.col("num") * F.col("Position"))
    base = base.withColumn("suffix", F.max("f").over(g.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)))
    base = base.withColumn("need", F.col("f") - F.col("den") + F.col("num"))

    # Every position appears twice: as a suffix maximum (kind 0) and as a demand (kind 1).
    both = base.select(
        *part, "Position", "i", "n",
        F.inline(F.array(
            F.struct(F.col("suffix").alias("v"), F.lit(0).alias("kind")),
            F.struct(F.col("need").alias("v"), F.lit(1).alias("kind")),
        )),
    )
    order = g.orderBy(F.desc("v"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    # The suffix maxima so far are those of members 1 to r, of which the r-th has the largest position.
    member = F.col("kind") == 0
    both = both.withColumns({"r": F.sum(member.cast("long")).over(order), "end_pos": F.max(F.when(member, F.col("Position"))).over(order)})
    reach = F.when(F.col("end_pos") - F.col("Position") + 1 >= F.col("minlen"), F.col("r"))
    cover = F.max("reach").over(g.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    flagged = both.where("kind = 1").withColumn("reach", reach).withColumn("cover", cover)
    return flagged.select(
        *part, "Position",
        F.when((F.col("n") >= F.col("minlen")) & (F.coalesce("cover", F.lit(0)) >= F.col("i")), "Discarded")
        .otherwise("Good").alias("ClusteringFlag"),
    )


def cluster_sweep_summary(flags: DataFrame, groups: list[str]) -> DataFrame:
    """Discarded positions per parameter pair, one column per residue scheme."""
    return (
        flags.where("ClusteringFlag = 'Discarded'")
        .groupBy("minlen", "maxcaas")
        .pivot("CAAP_Group", groups)
        .count()
        .na.fill(0)
    )


def run_lengths(sites: DataFrame, keys: tuple[str, ...] = ("Gene",)) -> DataFrame:
    """Sizes of runs of consecutive positions, labelled Singlet, 2..5, 6+."""
    keys_l = list(keys)
    pos = dealt(sites.select(*keys_l, "Position"), *keys_l).distinct()
    island = F.col("Position") - F.row_number().over(Window.partitionBy(*keys_l).orderBy("Position"))
    runs = pos.withColumn("island", island).groupBy(*keys_l, "island").agg(F.count(F.lit(1)).alias("size"))
    return runs.withColumn(
        "label",
        F.when(F.col("size") == 1, "Singlet").when(F.col("size") >= 6, "6+").otherwise(F.col("size").cast("string")),
    )


def run_length_shares(sites: DataFrame, keys: tuple[str, ...] = ("Gene",)) -> DataFrame:
    """Count and percentage of runs by label."""
    counts = run_lengths(sites, keys).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # at most six rows
    return counts.withColumn("pct", F.col("n") / total * 100)
