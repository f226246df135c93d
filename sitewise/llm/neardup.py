"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on many random directions.  Two of them collide in a direction if
one lies in the window centred on the other; the closer they are, the more directions they
collide in.  Pairs that collide in at least as many directions as pairs just at the wanted
similarity do with probability ``recall`` are verified by their cosine.

To spread the work, the first directions are cut into cells a few windows wide: a vector is
sent to its own cell and, if it lies near its lower bound, to the one below, so that a close
pair meets in the cell of its lower end.  Nested cells, more of them for more vectors, make
groups of bounded size out of scattered vectors; what is still large, because its vectors are
near-copies, is cut into blocks, and each two blocks meet in a task of their own.  Tasks return
a count and one link for each vector, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.llm.components import components
from sitewise.llm.simhash import local_groups
from sitewise.session import checkpoint

SEED, DIRECTIONS, RECALL = 20240229, 24, 0.995
#: Windows in standard deviations of a pair's difference at the wanted similarity: for a collision, and for a cell to miss no pair.
COLLIDE, CERTAIN = 1.5, 3.5
#: Vectors in a block, those of a label that a nested cell should hold, what one level of cells leaves of them, and the most levels.
BLOCK, CELL, LEFT, LEVELS = 256, 2048, 0.6, 16


def spread(cosine: float) -> float:
    """Standard deviation of the difference of two unit vectors' projections at this cosine."""
    return math.sqrt(max(0.0, 2 - 2 * cosine))


def least_count(directions: int = DIRECTIONS, recall: float = RECALL) -> int:
    """The largest count that pairs at the wanted similarity reach with probability ``recall``."""
    p = math.erf(COLLIDE / math.sqrt(2))
    tail = 0.0
    for k in range(directions, -1, -1):
        tail += math.comb(directions, k) * p**k * (1 - p) ** (directions - k)
        if tail >= recall:
            return k
    return 0


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim, LEVELS + DIRECTIONS))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def usable(vector: str) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(wide, lambda x: x != 0)


def cells(projected: np.ndarray, levels: int, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, own) of every nested cell a row is sent to; own: a bit for each level where the cell is its own."""
    row = np.arange(len(projected))
    cell = np.zeros((len(projected), levels), np.int16)
    own = np.zeros(len(projected), np.int64)
    for k in range(levels):
        at = projected[row, k] / (2 * reach) + 0.37 * k
        home = np.floor(at)
        low = (at - home) * 2 * reach <= reach
        lower = cell[low].copy()
        cell[:, k], lower[:, k] = home, home[low] - 1
        own, row, cell = np.concatenate([own | 1 << k, own[low]]), np.concatenate([row, row[low]]), np.concatenate([cell, lower])
    return row, cell, own


def linked(vectors: np.ndarray, weight: np.ndarray, own: np.ndarray, side: np.ndarray, two: bool, full: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, group) of each vector: summed weights of those linked to it here, and the first of its local group.

    two: only pairs of different sides count.  A pair whose cell is nobody's own is counted elsewhere.
    """
    u = units(vectors)
    p = u @ directions(vectors.shape[1])
    least, window, reach = least_count(), COLLIDE * spread(cosine), CERTAIN * spread(cosine)
    order = np.argsort(p[:, LEVELS], kind="stable")
    u, p, weight, own, side = u[order], p[order], weight[order], own[order], side[order]
    begin, end = np.searchsorted(p[:, LEVELS], p[:, LEVELS] - reach), np.searchsorted(p[:, LEVELS], p[:, LEVELS] + reach, "right")
    total = np.zeros(len(u), np.int64)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a in range(0, len(u), BLOCK):
            b = min(len(u), a + BLOCK)
            lo, hi = begin[a], end[b - 1]
            met = np.zeros((b - a, hi - lo), np.uint8)
            for k in range(LEVELS, LEVELS + DIRECTIONS):
                met += np.abs(p[a:b, k, None] - p[None, lo:hi, k]) <= window
            fits = (met >= least) & (u[a:b] @ u[lo:hi].T >= cosine) & ((own[a:b, None] | own[None, lo:hi]) == full)
            if two:
                fits &= side[a:b, None] != side[None, lo:hi]
            i = np.arange(a, b)
            inside = (i >= lo) & (i < hi)
            fits[np.flatnonzero(inside), i[inside] - lo] = False
            total[a:b] += fits @ weight[lo:hi]
            i, j = np.nonzero(fits)
            yield i + a, j + lo

    group = local_groups(len(u), pairs())
    links, first = np.empty_like(total), np.empty_like(group)
    links[order], first[order] = total, order[group]
    return links, first


def near_duplicates(df: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors are compared when their labels are equal and not null and their lengths equal.
    Those that are null, zero or hold null or non-finite components have no links and are
    their own component.  Equal vectors of a label meet as one class and link to each other.
    Repeated rows are vectors of their own, with a shared id.  A null id takes part and gets
    its group's smallest id.  An empty table gives an empty table.
    """
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    good = F.col("label").isNotNull() & usable("v")
    valid, rest = rows.where(good), rows.where(~good)
    classes = checkpoint(valid.groupBy("label", "v").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n")).withColumn("class", F.monotonically_increasing_id()))
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    levels = min(LEVELS, max(0, math.ceil(math.log(max(1, most) / CELL) / math.log(1 / LEFT))))
    reach = CERTAIN * spread(cosine)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for dim, same in part.groupby(part["v"].map(len)):
                x = np.stack(same["v"].to_numpy()).astype(np.float64)
                row, cell, own = cells(units(x) @ directions(dim), levels, reach)
                pick = same.iloc[row]
                yield pd.DataFrame({"label": pick["label"].to_numpy(), "dim": dim, "cell": [c.tobytes() for c in cell], "own": own, "class": pick["class"].to_numpy(),
                                    "n": pick["n"].to_numpy(), "x": [r.tobytes() for r in x[row]]})

    kind = dict(rows.dtypes)["label"]
    dealt = checkpoint(classes.select("label", "v", "class", "n").mapInPandas(deal, f"label {kind}, dim int, cell binary, own long, class long, n long, x binary"))
    key = ["label", "dim", "cell"]
    large = checkpoint(dealt.groupBy(*key).count().where(F.col("count") > BLOCK).select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    cut = dealt.join(large, key, "left").withColumn("side", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cut = cut.select(*key, F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "side", "own", "class", "n", "x")

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(part["x"]), np.float64).reshape(len(part), -1)
        links, first = linked(x, part["n"].to_numpy(np.int64), part["own"].to_numpy(np.int64), part["side"].to_numpy(), part["one"].iloc[0] != part["two"].iloc[0], (1 << levels) - 1, cosine)
        some = (links > 0) | (first != np.arange(len(first)))
        ids = part["class"].to_numpy()
        return pd.DataFrame({"class": ids[some], "links": links[some], "to": ids[first[some]]})

    found = checkpoint(cut.groupBy(*key, "one", "two").applyInPandas(meet, "class long, links long, to long"))
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found, "class", "to")
    named = classes.select("label", "v", "class", "n", "first_id").join(counts, "class", "left").join(groups.withColumnRenamed("node", "class"), "class", "left")
    named = checkpoint(named.select("label", "v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component"), "first_id"))
    firsts = checkpoint(named.groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = checkpoint(named.join(firsts, "component").select("label", "v", "n_links", "component_id"))
    out = valid.join(named, ["label", "v"]).select("vec_id", "n_links", "component_id").unionByName(rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
