"""Permutation tests of gene rates against a branch trait, as a blocked product of matrices.

Genes x branches times branches x permutations: both tables are cut into blocks, each two
blocks meet in a task, and a few matrix products there give the correlations of all their
genes with all their permutations.  A task returns counts for each gene; counts of all blocks,
and so of all batches of permutations, are added.  There is no pass for each permutation and
no row for each gene and permutation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewise.session import checkpoint

#: Numbers in a block of genes or of permutations, and correlations that a worker holds at once; correlations this close to the observed one reach it.
CELLS, CLOSE = 1 << 18, 1e-9


def winsorised(rates: DataFrame, extremes: int, group: str = "gene", value: str = "rer") -> DataFrame:
    """Values of each group whose ``extremes`` largest and smallest are drawn to the next ones inside.

    Groups of ``2 * extremes`` values or fewer stay as they are.  Nulls stay null and are not counted.
    """
    if extremes < 1:
        return rates
    w = Window.partitionBy(group)
    known = F.col(value).isNotNull()
    place = F.row_number().over(w.orderBy(F.col(value).asc_nulls_last()))
    rows = rates.withColumns({"_place": place, "_n": F.count(value).over(w)})
    inside = (F.col("_place") > extremes) & (F.col("_place") <= F.col("_n") - extremes)
    bounds = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"_lo": F.min(F.when(inside, F.col(value))).over(bounds), "_hi": F.max(F.when(inside, F.col(value))).over(bounds)})
    drawn = F.when(known, F.greatest(F.least(F.col(value), F.coalesce("_hi", value)), F.coalesce("_lo", value)))
    return rows.withColumn(value, drawn).drop("_place", "_n", "_lo", "_hi")


def pearson(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Correlation of every row of x with every row of y over the columns where neither is NaN; NaN where one does not vary."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    # A shift by each row's own mean changes no correlation and keeps the sums small.
    x = np.where(mx, x - np.nanmean(np.where(mx.any(1, keepdims=True), x, 0), 1, keepdims=True), 0)
    y = np.where(my, y - np.nanmean(np.where(my.any(1, keepdims=True), y, 0), 1, keepdims=True), 0)
    fx, fy = mx.astype(float), my.astype(float)
    n, sx, sy = fx @ fy.T, x @ fy.T, fx @ y.T
    with np.errstate(invalid="ignore", divide="ignore"):
        vx, vy = (x * x) @ fy.T - sx * sx / n, fx @ (y * y).T - sy * sy / n
        size = (x * x).sum(1)[:, None] * 1e-12, (y * y).sum(1)[None, :] * 1e-12
        r = (x @ y.T - sx * sy / n) / np.sqrt(vx * vy)
    return np.where((n > 1) & (vx > size[0]) & (vy > size[1]), np.clip(r, -1, 1), np.nan)


def kendall(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Tau-b of every row of x with every row of zeros and ones of y, over x's columns that are not NaN.

    With two classes the concordant less the discordant pairs follow from the rank sum of the
    ones, so ranks times ones is the whole work.
    """
    mx, ones = ~np.isnan(x), np.nan_to_num(y)
    n = mx.sum(1)
    ranks, ties = np.zeros_like(x), np.zeros(len(x))
    for k in range(len(x)):
        v = x[k, mx[k]]
        _, back, count = np.unique(v, return_inverse=True, return_counts=True)
        ranks[k, mx[k]] = (np.cumsum(count) - (count - 1) / 2)[back]
        ties[k] = (count * (count - 1) / 2).sum()
    pos = mx.astype(float) @ ones.T
    neg = n[:, None] - pos
    apart = 2 * (ranks @ ones.T - pos * (pos + 1) / 2) - pos * neg
    with np.errstate(invalid="ignore", divide="ignore"):
        r = apart / np.sqrt((n * (n - 1) / 2 - ties)[:, None] * (pos * neg))
    return np.where(np.isfinite(r), r, np.nan)


MEASURES = {"continuous": pearson, "binary": kendall}


def permutation_test(rates: DataFrame, trait: DataFrame, permuted: DataFrame, kind: str = "continuous", min_branches: int = 10, min_positive: int = 2) -> DataFrame:
    """(gene, Rho, N, exceedances, n_perms, p_perm) of every gene with enough branches.

    ``rates`` is ``gene, branch, rer``, ``trait`` is ``branch, value``, ``permuted`` is ``perm,
    branch, value``, of any number of batches.  Rho is Pearson's over the branches that both
    have, or tau-b with a 0/1 trait (``binary``), whose permutations say which of the trait's
    branches are 1: missing ones are 0, others are ignored.  Exceedances are permutations whose
    absolute correlation reaches the observed one's; n_perms are those that have one; p_perm is
    their ratio.  Genes have ``min_branches`` branches, in the binary case ``min_positive`` of
    them 1; a gene whose rates or trait do not vary has a null Rho and p_perm.  Nulls are
    missing values; of repeated (gene, branch) or (perm, branch) rows the mean counts.
    """
    if kind not in MEASURES:
        raise ValueError(f"unknown kind {kind!r}")
    measure, binary = MEASURES[kind], kind == "binary"
    trait = checkpoint(trait.where("value IS NOT NULL AND branch IS NOT NULL").groupBy("branch").agg(F.avg("value").alias("value")))
    branches = trait.count()
    rates = rates.where("rer IS NOT NULL AND gene IS NOT NULL AND branch IS NOT NULL").groupBy("gene", "branch").agg(F.avg("rer").alias("rer"))
    perms = permuted.where("value IS NOT NULL AND perm IS NOT NULL AND branch IS NOT NULL").groupBy("perm", "branch").agg(F.avg("value").alias("value"))
    if binary:
        perms = perms.join(trait.select("branch"), "branch", "left_semi")
        rates = rates.join(trait.select("branch"), "branch", "left_semi")
    rates, perms = checkpoint(rates), checkpoint(perms)
    most = max(1, rates.select("branch").distinct().count(), perms.select("branch").distinct().count(), branches)
    side = max(1, CELLS // most)
    n_genes, n_perms = rates.select("gene").distinct().count(), perms.select("perm").distinct().count()
    gb, pb = max(1, -(-n_genes // side)), max(1, -(-n_perms // side))
    other = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    own = lambda c, n, name: F.pmod(F.xxhash64(c), F.lit(n)).cast("int").alias(name)
    observed = trait.select(F.lit(0).alias("role"), F.lit(None).cast("string").alias("key"), "branch", F.col("value").alias("v"))
    left = rates.select(F.lit(1).alias("role"), F.col("gene").cast("string").alias("key"), "branch", F.col("rer").alias("v"), own("gene", gb, "gb"), other(pb, "pb"))
    right = perms.select(F.lit(2).alias("role"), F.col("perm").cast("string").alias("key"), "branch", F.col("value").alias("v"), own("perm", pb, "pb"), other(gb, "gb"))
    top = observed.select("*", other(gb, "gb")).select("*", other(pb, "pb"))
    kind_of = dict(rates.dtypes)["gene"]

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        columns, at = np.unique(part["branch"].to_numpy(), return_inverse=True)
        role = part["role"].to_numpy()

        def matrix(which: int) -> tuple[list, np.ndarray]:
            mine = role == which
            keys, row = np.unique(part["key"][mine].fillna("").to_numpy().astype(str), return_inverse=True)
            m = np.full((len(keys), len(columns)), np.nan)
            m[row, at[mine]] = part["v"].to_numpy()[mine]
            return list(keys), m

        genes, x = matrix(1)
        _, seen = matrix(0)
        _, y = matrix(2)
        if not genes or not len(seen):
            return pd.DataFrame({"gene": [None], "rho": [None], "n": [0], "pos": [0], "exceed": [0], "perms": [0]})
        # Genes x permutations is the largest matrix of a block: it is made for some genes at a time.
        step, parts = max(1, CELLS // max(len(columns), len(y))), []
        for first in range(0, len(genes), step):
            some = x[first:first + step]
            both = ~np.isnan(some) & ~np.isnan(seen[0])
            rho = measure(some, seen)[:, 0]
            null = np.abs(measure(some, y)) if len(y) else np.zeros((len(some), 0))
            reach = null >= (np.abs(rho) - CLOSE)[:, None]
            parts.append(pd.DataFrame({"gene": genes[first:first + step], "rho": rho, "n": both.sum(1), "pos": (both & (np.nan_to_num(seen[0]) == 1)).sum(1), "exceed": reach.sum(1), "perms": (~np.isnan(null)).sum(1)}))
        return pd.concat(parts, ignore_index=True)

    met = left.unionByName(right).unionByName(top).groupBy("gb", "pb").applyInPandas(meet, "gene string, rho double, n long, pos long, exceed long, perms long")
    # Rho, N and the positives are the same in every block.
    out = met.where("gene IS NOT NULL").groupBy("gene").agg(F.nanvl(F.max("rho"), F.lit(None).cast("double")).alias("Rho"), F.max("n").alias("N"), F.max("pos").alias("_pos"), F.sum("exceed").alias("exceedances"), F.sum("perms").alias("n_perms"))
    out = out.where((F.col("N") >= min_branches) & ((F.col("_pos") >= min_positive) if binary else F.lit(True)))
    known = F.col("Rho").isNotNull()
    return out.select(F.col("gene").cast(kind_of).alias("gene"), "Rho", "N", F.when(known, F.col("exceedances")).alias("exceedances"), "n_perms",
                      F.when(known & (F.col("n_perms") > 0), F.col("exceedances") / F.col("n_perms")).alias("p_perm"))
