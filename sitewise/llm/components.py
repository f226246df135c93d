"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.session import checkpoint


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that a link names; component: its smallest node.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to
    its smallest neighbour, then its smaller neighbours and itself are.  Every step is a
    grouped minimum, combined before the shuffle, and a join of two written tables, which
    adaptive execution splits where a node has very many links.  Only two numbers a round
    reach the driver.  Null ends, self links and repeated links are ignored; no links give
    an empty table.
    """
    x, y = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = checkpoint(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(x, y).distinct())
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpoint(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = checkpoint(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = checkpoint(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = checkpoint(small.select("e.*").where("u <> v").distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
