"""Gene-level accumulation: grid, eligible pool, randomization test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.labels import as_bool
from sitewise.functions.numeric import binomial_sum_tail_udf, simulate_moments
from sitewise.operators.columns import conservation, masked
from sitewise.operators.genomic import gene_offsets, with_chromosome_order
from sitewise.operators.ordering import attach_scalars, cumulative_counts, quantiles
from sitewise.session import checkpoint

POOL = ["US", "GS0", "GS1", "GS2", "GS3", "GS4"]


#: Parts into which the genes are cut where they meet the draws of a bin.
SALTS = 64


def metadata(sites: DataFrame, order: str | None = None) -> DataFrame:
    """Usable site metadata: control scheme and dubious-conserved rows dropped, last row wins.

    ``order`` names the column that tells which of several rows for one (scheme, gene,
    position) is the last; without it rows are taken as unique.
    """
    group = F.when(F.trim("CAAP_Group").isin("", "NA", "na", "N/A"), "1").otherwise(F.trim("CAAP_Group"))
    df = sites.withColumn("CAAP_Group", group).where(F.upper("CAAP_Group") != "GS0")
    if "is_conserved_meta" in df.columns and "asr_is_conserved" in df.columns:
        df = df.where(~(as_bool(F.col("is_conserved_meta")) & ~as_bool(F.col("asr_is_conserved"))))
    if order is None:
        return df
    keys = ["CAAP_Group", "Gene", "Position"]
    rest = [c for c in df.columns if c not in keys + [order]]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def grid(columns: DataFrame, genes: DataFrame, sites: DataFrame, target_syms: str) -> DataFrame:
    """One row per alignment column with its global position, conservation, mask and hit flag."""
    loc = gene_offsets(genes).select(F.col("Gene").alias("gene"), "offset")
    loc = loc.join(with_chromosome_order(genes).select(F.col("Gene").alias("gene"), "chr", "start_bp", "end_bp"), "gene")
    hit = sites.select(F.col("Gene").alias("gene"), F.col("Position").alias("position"), F.lit(True).alias("iscaas")).distinct()
    cols = masked(conservation(columns), target_syms).select("gene", "position", "cons_idx", "masked")
    return (
        cols.join(loc, "gene").join(hit, ["gene", "position"], "left")
        .select("gene", (F.col("offset") + F.col("position")).alias("global_pos"), "chr", "start_bp", "end_bp",
                F.col("position").alias("msa_pos"), "cons_idx", "masked", F.coalesce("iscaas", F.lit(False)).alias("iscaas"))
    )


def conservation_deciles(grid_df: DataFrame) -> DataFrame:
    """Nine decile thresholds of the conservation index among hits."""
    names = {f"d{i}": i / 10 for i in range(1, 10)}
    q = quantiles(grid_df.where("iscaas"), [], "cons_idx", names)
    return q.select(F.posexplode(F.array(*names))).select((F.col("pos") + 1).alias("Decile"), F.col("col").alias("Threshold"))


def eligible_rows(grid_df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows the null draws from: the grid left joined to deduplicated sites.

    A column hit under k schemes appears k times and is k times as likely to be drawn.
    """
    keys = ["CAAP_Group", "Gene", "Position"]
    meta = sites.select(*keys, "change_side", "is_conserved_meta", "asr_is_conserved").dropDuplicates(keys).select(
        F.col("Gene").alias("gene"), F.col("Position").alias("msa_pos"), "CAAP_Group", "change_side",
        "is_conserved_meta", "asr_is_conserved")
    return grid_df.join(meta, ["gene", "msa_pos"], "left")


def decile_key(value: Column, bins: list[float], compat: bool = False) -> Column:
    """1-based bin of ``value``; in compatibility mode the top bin has no eligible rows."""
    key = F.lit(1)
    for b in bins[1:-1]:
        key = key + (value >= b).cast("int")
    return F.when(key >= len(bins) - 1, F.lit(None)).otherwise(key) if compat else key


def expected_draws(rows: DataFrame, category: Column, direction: str = "all", bins: list[float] | None = None,
                   use_mask: bool = True, compat: bool = False) -> DataFrame:
    """Per (gene, category): observed count, draws per bin and the gene's share of each bin's pool.

    ``category`` is an array column naming the pools a row counts for.  Everything is
    aggregates: the rows are made once, reduced to counts of each gene, bin and set of
    pools, and written; all sums below read those counts.
    """
    pool = F.upper(F.trim(F.coalesce("CAAP_Group", F.lit("")))).isin(*POOL)
    side = F.col("change_side").isin(direction, "both") if direction in ("top", "bottom") else F.coalesce("change_side", F.lit("")) != "none"
    dubious = as_bool(F.col("is_conserved_meta")) & ~as_bool(F.coalesce("asr_is_conserved", F.lit("true")))
    key = decile_key(F.col("cons_idx"), bins, compat) if bins else F.lit(0)
    rows = rows.withColumn("bin", key).where("bin IS NOT NULL")
    eligible = ~F.col("masked") if use_mask else F.lit(True)
    counts = checkpoint(rows.groupBy("gene", "bin", eligible.alias("eligible"), F.when(pool & side & ~dubious, category).alias("pools")).agg(F.count(F.lit(1)).alias("c")))
    per_gene = counts.where("eligible").groupBy("gene", "bin").agg(F.sum("c").alias("e_g"))
    per_bin = per_gene.groupBy("bin").agg(F.sum("e_g").alias("e"))
    hits = counts.select("gene", "bin", "c", F.explode("pools").alias("category"))
    drawn = hits.groupBy("category", "bin").agg(F.sum("c").alias("n"))
    observed = hits.groupBy("category", "gene").agg(F.sum("c").alias("actual"))
    # One row a bin is broadcast; genes meet the draws of a bin by salt, for a bin is a hot key.
    salted = drawn.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    genes = per_gene.join(F.broadcast(per_bin), "bin").withColumn("_salt", F.pmod(F.xxhash64("gene"), F.lit(SALTS)).cast("int"))
    law = genes.join(salted, ["bin", "_salt"]).withColumn("p", F.col("e_g") / F.col("e"))
    law = law.groupBy("category", "gene").agg(
        F.collect_list(F.struct("bin", "n", "p")).alias("l")  # at most one entry per bin
    ).select("category", "gene", F.expr("transform(array_sort(l), x -> x.n)").alias("ns"), F.expr("transform(array_sort(l), x -> x.p)").alias("ps"))
    return law.join(observed, ["category", "gene"], "full").select(
        "category", "gene", F.coalesce("actual", F.lit(0)).alias("actual"),
        F.coalesce("ns", F.array().cast("array<bigint>")).alias("ns"), F.coalesce("ps", F.array().cast("array<double>")).alias("ps"),
    )


def exact_test(law: DataFrame) -> DataFrame:
    """Exact tail probability, mean and deviation of the drawn count per gene."""
    zipped = F.arrays_zip("ns", "ps")
    mean = F.aggregate(zipped, F.lit(0.0), lambda a, x: a + x["ns"] * x["ps"])
    var = F.aggregate(zipped, F.lit(0.0), lambda a, x: a + x["ns"] * x["ps"] * (1 - x["ps"]))
    return law.select("category", "gene", "actual", mean.alias("mean_sim"), F.sqrt(var).alias("sd_sim"),
                      binomial_sum_tail_udf("ns", "ps", "actual").alias("p_exact"))


def merge_moments(parts: DataFrame) -> DataFrame:
    """Combine partial sums of randomizations: empirical p, mean and population deviation."""
    total = parts.groupBy("category", "gene", "actual").agg(
        F.sum("n_rands").alias("n"), F.sum("sum_c").alias("s"), F.sum("sum_sq").alias("ss"), F.sum("n_ge").alias("ge"))
    mean = F.col("s") / F.col("n")
    return total.select(
        "category", "gene", F.col("actual").alias("ActualCount"), F.col("ge").alias("RandsAbove"),
        (F.col("n") - F.col("ge")).alias("RandsBelow"), ((F.col("ge") + 1) / (F.col("n") + 1)).alias("PValueEmpirical"),
        mean.alias("MeanSim"), F.sqrt(F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0))).alias("SD"),
        F.col("n").alias("NumRands"),
    )


def monte_carlo(law: DataFrame, n_rands: int, seed: int = 1, chunk: int = 10_000) -> DataFrame:
    """Simulated counterpart of :func:`exact_test`.

    A gene's count is marginally a sum of binomials, so genes are simulated
    independently in chunks; neither the pool nor a gene vector is broadcast.
    """
    n_chunks = -(-n_rands // chunk)
    size = F.least(F.lit(chunk), F.lit(n_rands) - F.col("chunk") * chunk)
    work = law.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))).withColumn("size", size)
    work = work.withColumn("seed", F.xxhash64(F.lit(seed), "category", "gene", "chunk")).select(
        "gene", "category", "chunk", "size", "seed", "ns", "ps", "actual")
    parts = work.mapInPandas(simulate_moments, "gene string, category string, actual long, n_rands long, sum_c long, sum_sq double, n_ge long")
    return merge_moments(parts)


def individual_draws(rows: DataFrame, hits: DataFrame, n_rands: int, pick: Column) -> DataFrame:
    """Explicit randomized positions: each hit of each randomization meets one eligible row.

    ``pick`` maps (rand_id, global_pos) to any integer; its remainder indexes the
    eligible rows in global order.  The index is a join key, so the pool stays distributed.
    """
    pool = rows.where(~F.col("masked")).select("gene", "global_pos", F.coalesce("CAAP_Group", F.lit("")).alias("CAAP_Group"))
    order = cumulative_counts(pool, [], ["global_pos", "gene", "CAAP_Group"])
    size = order.select(F.max("total").alias("pool_size"))
    work = attach_scalars(
        hits.select("global_pos", "tag").withColumn("rand_id", F.explode(F.sequence(F.lit(0), F.lit(n_rands - 1)))), size
    )
    work = work.withColumn("before", F.pmod(pick, F.col("pool_size")))
    # Equal rows are one key of several places: each place is drawn.
    target = order.select(F.explode(F.sequence(F.col("before"), F.col("before") + F.col("cnt") - 1)).alias("before"), F.col("global_pos").alias("randomized_position"), F.col("gene").alias("randomized_gene"))
    return work.join(target, "before").select(
        F.col("rand_id").cast("string").alias("rand_id"), F.col("global_pos").alias("caas_position"), "tag",
        "randomized_position", "randomized_gene")


def decile_histogram(grid_df: DataFrame, bins: list[float], by_gene: bool = False) -> DataFrame:
    """Unmasked columns per conservation bin, overall or pivoted per gene."""
    df = grid_df.where(~F.col("masked")).withColumn("decile", decile_key(F.col("cons_idx"), bins))
    if not by_gene:
        return df.groupBy("decile").agg(F.count(F.lit(1)).alias("NumPositions"))
    return df.groupBy("gene").pivot("decile", list(range(1, len(bins)))).count().na.fill(0)
