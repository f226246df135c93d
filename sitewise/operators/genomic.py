"""Genomic coordinates: chromosome order, cumulative offsets, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewise.functions.labels import chromosome_order
from sitewise.operators.ordering import cumulative_counts


def with_chromosome_order(genes: DataFrame, other: int = 26) -> DataFrame:
    return genes.withColumn("chr_label", F.regexp_replace("chr", "^chr", "")).withColumn(
        "chr_order", chromosome_order(F.col("chr"), other)
    )


def chromosome_offsets(located: DataFrame, gap: float = 5e6) -> DataFrame:
    """Cumulative x offset per chromosome (a few dozen rows after the aggregation)."""
    per = located.groupBy("chr_order", "chr_label").agg(F.max("end_bp").alias("chr_max"))
    before = Window.orderBy("chr_order", "chr_label").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("chr_max").over(before), F.lit(0)) + (F.col("chr_order") - 1) * F.lit(gap)
    return per.withColumn("offset", offset)


def gene_offsets(genes: DataFrame) -> DataFrame:
    """Global start of every gene: total length of the genes before it in genomic order."""
    order = with_chromosome_order(genes, other=1000)
    keys = ["chr_order", "chr_label", "start_bp", "Gene"]
    return cumulative_counts(order, [], keys, weight="Length").select(
        *keys, F.col("cnt").alias("Length"), F.col("before").alias("offset")
    )


def windows(df: DataFrame, size: int) -> DataFrame:
    """Fixed window id and bounds from the gene midpoint."""
    wid = F.floor(F.col("gene_mid") / size)
    return df.withColumn("win_id", wid).withColumn("win_start", F.col("win_id") * size).withColumn(
        "win_end", F.col("win_start") + size - 1).withColumn("win_mid", F.col("win_start") + size / 2)


def window_positions(df: DataFrame, thresholds: dict[str, float], size: int = 1_000_000) -> DataFrame:
    """Positions per window with counts above each threshold, their share and the mean score."""
    keys = ["chr_order", "chr_label", "win_id", "win_start"]
    out = windows(df, size).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_positions"),
        *[F.count_if(F.col("CAAS_score") >= v).alias(f"n_{k}_positions") for k, v in thresholds.items()],
        F.avg("CAAS_score").alias("mean_caas"),
    )
    first = next(iter(thresholds))
    return out.withColumn("frac_top_positions", F.col(f"n_{first}_positions") / F.col("n_positions"))


def window_genes(df: DataFrame, score: str, size: int = 1_000_000) -> DataFrame:
    """Genes per window with mean and maximum score."""
    keys = ["chr_order", "chr_label", "win_id", "win_start"]
    return windows(df, size).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_genes"), F.avg(score).alias("mean_score"), F.max(score).alias("max_score"),
        F.array_join(F.array_sort(F.collect_set("Gene")), ", ").alias("genes"),
    )
