"""The stages chained: every stage is a function of DataFrames, every edge a lazy plan.

Only three things are driver actions: reading the trait configuration, the contrast
gate and the greedy pair selection.  Everything else stays a plan until it is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.operators.columns import species_names
from sitewise.operators import accumulation, clusters, contrasts, disambiguation, gene_filter, postproc, resampling, scan, scoring, significance
from sitewise.operators.columns import SpeciesIndex, columns_from_sequences
from sitewise.operators.ancestry import lifting
from sitewise.session import checkpoint
from sitewise.sinks.tables import empty

DISCOVERY_SCHEMA = (
    "Gene string, Mode string, CAAP_Group string, Trait string, Position int, Substitution string, Encoded string, Pvalue double, "
    "Pattern string, FFGN int, FBGN int, GFG int, GBG int, MFG int, MBG int, FFG string, FBG string, MS string"
)


@dataclass
class Inputs:
    """Tables of one run; what is missing switches the stages that need it off."""

    sequences: DataFrame
    config: DataFrame | None = None
    traits: DataFrame | None = None
    tree: DataFrame | None = None
    genes: DataFrame | None = None
    resamples: DataFrame | None = None
    pair_states: DataFrame | None = None
    families: DataFrame | None = None


@dataclass
class Settings:
    mode: str = "CAAP"
    method: str = "decile"
    min_contrasts: int = 3
    cycles: int = 1000
    resample_strategy: str = "random"
    include_b0: bool = True
    max_conserved: int = 0
    min_changes: int = 1
    max_gaps: float = 0.5
    limits: scan.Limits = field(default_factory=scan.Limits)
    alpha: float = 0.05
    alpha_postproc: float = 0.10
    cluster_minlen: int = 3
    cluster_maxcaas: float = 0.7
    density_percentile: float = 0.99
    iqr_multiplier: float = 3.0
    n_randomizations: int = 10_000
    seed: int = 1


def contrast_stage(inputs: Inputs, s: Settings) -> DataFrame:
    """Trait configuration: given, or chosen from traits and tree."""
    if inputs.config is not None:
        return inputs.config
    if inputs.traits is None or inputs.tree is None:
        raise ValueError("either a trait configuration or traits plus a tree are needed")
    one = contrasts.thresholds(inputs.traits, s.method)
    with_counts = {"n_population", "n_cases"} <= set(inputs.traits.columns)
    table = contrasts.discrete(inputs.traits, one)
    chosen = contrasts.select_pairs(table, lifting(inputs.tree), "n_population" if with_counts else None)
    return contrasts.trait_config(inputs.sequences.sparkSession, chosen)


def resample_stage(inputs: Inputs, config: DataFrame, s: Settings) -> DataFrame:
    if inputs.resamples is not None:
        return inputs.resamples
    spark = inputs.sequences.sparkSession
    cycle_df = resampling.cycles(spark, s.cycles)
    if s.resample_strategy == "tree":
        out = resampling.permulated_labels(cycle_df, inputs.tree, inputs.traits.select("species", "value"), config, s.seed)
    elif s.resample_strategy == "family":
        if inputs.families is None:
            raise ValueError("resampling by family needs a table of families")
        out = resampling.family_labels(cycle_df, config.select("species", "grp"), inputs.families, s.seed)
    elif s.resample_strategy != "random":
        raise ValueError(f"unknown resampling strategy {s.resample_strategy!r}")
    else:
        n_fg, n_bg = (config.where(F.col("grp") == g).count() for g in (1, 0))
        species = inputs.traits if inputs.traits is not None else inputs.sequences
        out = resampling.random_labels(cycle_df, species, n_fg, n_bg, s.seed)
    return resampling.with_observed(out, config) if s.include_b0 else out


def run(inputs: Inputs, s: Settings | None = None) -> dict[str, DataFrame]:
    """All stages the inputs allow, as named DataFrames.

    Below the minimum number of contrasts the run stops early with typed empty tables.
    """
    s = s or Settings()
    spark = inputs.sequences.sparkSession
    config = contrast_stage(inputs, s)
    out = {"config": config}
    if not contrasts.enough_contrasts(config, s.min_contrasts):
        out["discovery"] = empty(spark, DISCOVERY_SCHEMA)
        out["background"] = empty(spark, "gene string, positions array<int>")
        return out

    index = SpeciesIndex.of(inputs.sequences.select("species").union(config.select("species")))
    columns = columns_from_sequences(inputs.sequences, index)
    kept = scan.column_filter(columns, s.min_changes, s.max_gaps)
    tested = scan.tested_columns(kept, scan.load_contrasts(config), index, s.limits)
    # Hits are a small share of all columns and feed every later stage: written once.
    discovery = checkpoint(scan.discover(tested, s.mode, s.max_conserved))
    out["discovery"] = discovery
    out["background"] = scan.background(tested, inputs.sequences.select("gene").distinct())

    resamples = resample_stage(inputs, config, s)
    out["resamples"] = resamples
    boot = scan.bootstrap(kept, discovery, resamples, index, s.limits, s.max_conserved)
    out["bootstrap"] = boot
    joined = significance.flag(significance.attach_bootstrap(discovery, boot), s.alpha)
    joined = checkpoint(joined)
    out["significance"] = joined
    out["meta"] = significance.meta_table(joined.where("isSignificant"))

    sites = joined
    if inputs.pair_states is not None:
        labels = disambiguation.classify(inputs.pair_states)
        out["labels"] = labels
        on = labels.select(F.col("gene").alias("Gene"), F.col("site").alias("Position"), "change_top", "change_bottom", "change_side", "pattern_type", "parallel_top", "parallel_bottom", "parallel_type")
        sites = sites.join(on, ["Gene", "Position"], "left").na.fill(
            {"change_top": "no_change", "change_bottom": "no_change", "change_side": "none", "pattern_type": "no_change", "parallel_type": "none"})
        sites = checkpoint(disambiguation.conserved_flags(sites, inputs.pair_states))
    flags = clusters.clustered_positions(sites, [(s.cluster_minlen, s.cluster_maxcaas)]).drop("minlen", "maxcaas")
    out["cluster_flags"] = flags
    filtered = sites.join(flags.where("ClusteringFlag = 'Discarded'").drop("ClusteringFlag"), ["Gene", "CAAP_Group", "Position"], "left_anti")
    if inputs.genes is not None:
        stats = checkpoint(gene_filter.gene_density(sites, inputs.genes))
        out["gene_stats"] = checkpoint(gene_filter.categorised(stats, flags, s.density_percentile, s.iqr_multiplier))
        removed = out["gene_stats"].where("Category <> 'Normal'").select(*stats.columns, "Category")
        out["removed_genes"] = removed
        out["background_main"] = gene_filter.cleaned_background_main(inputs.genes.select("Gene"), removed)
        filtered = gene_filter.drop_removed(filtered, removed)
    out["filtered"] = filtered

    if inputs.genes is not None and inputs.pair_states is not None:
        target = index.symbols(species_names(config))
        grid = accumulation.grid(columns, inputs.genes, filtered, target)
        law = accumulation.expected_draws(accumulation.eligible_rows(grid, filtered), F.array(F.lit("all"), F.lower("CAAP_Group")))
        out["accumulation"] = accumulation.monte_carlo(law, s.n_randomizations, s.seed)
        out["accumulation_exact"] = accumulation.exact_test(law)
    return out


def score(sites: DataFrame, n_pairs: int = 3) -> dict[str, DataFrame]:
    """Position and gene scores of a post-processed, disambiguated site table."""
    pos = checkpoint(scoring.position_scores(sites, n_pairs))
    return {"positions": scoring.top_flags(pos), "genes": scoring.gene_scores(pos)}


def postprocess(master: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Normalised master table split by the posterior hard filter."""
    return postproc.split_low_posterior(postproc.normalise(master), threshold)
