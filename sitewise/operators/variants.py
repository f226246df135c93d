"""Variant annotation: genomic probe of codon ranges and its aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.labels import codon_range, protein_ref
from sitewise.functions.schemes import WEIGHTS_FRACTION, weight

# Symbols that never count as a letter.
AMBIGUOUS = ["-", "X", "B", "Z", "J", "U", "O"]


def letter_sets(caas: Column, encoded: Column, side: Column, group: Column) -> tuple[Column, Column]:
    """Ancestral and derived residue arrays of a pattern, skipping conserved pairs.

    Conservation is judged on the class codes when the scheme has them, otherwise on
    the residues.  Without a defined side there is no ancestral set.
    """
    slash = F.contains(caas, F.lit("/"))
    raw_top, raw_bot = F.split_part(caas, F.lit("/"), F.lit(1)), F.substring_index(caas, "/", -1)
    coded = (group != "US") & F.coalesce(F.contains(encoded, F.lit("/")), F.lit(False))
    key_top = F.when(coded, F.split_part(encoded, F.lit("/"), F.lit(1))).otherwise(raw_top)
    key_bot = F.when(coded, F.substring_index(encoded, "/", -1)).otherwise(raw_bot)
    n = F.least(F.length(raw_top), F.length(raw_bot), F.length(key_top), F.length(key_bot))
    idx = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    free = F.filter(idx, lambda i: F.substr(key_top, i, F.lit(1)) != F.substr(key_bot, i, F.lit(1)))

    def letters(text: Column, at: Column) -> Column:
        found = F.transform(at, lambda i: F.upper(F.substr(text, i, F.lit(1))))
        return F.array_sort(F.array_distinct(F.filter(found, lambda a: ~a.isin(*AMBIGUOUS))))

    top, bot = letters(raw_top, free), letters(raw_bot, free)
    every = F.when(F.length(caas) > 0, F.sequence(F.lit(1), F.length(caas))).otherwise(F.array().cast("array<int>"))
    whole = letters(caas, every)
    none = F.array().cast("array<string>")
    anc = F.when(~slash, none).when(side == "top", bot).when(side == "bottom", top).otherwise(none)
    der = F.when(~slash, whole).when(side == "top", top).when(side == "bottom", bot).otherwise(F.array_sort(F.array_union(top, bot)))
    return anc, der


def query_coordinates(queries: DataFrame) -> DataFrame:
    """Queries with parsed codon range and reference residue."""
    chrom, start, end = codon_range(F.col("coord"))
    return queries.withColumns({"chr": chrom, "start_bp": start, "end_bp": end, "ref": protein_ref(F.col("coord"))}).where("chr IS NOT NULL")


def annotate(variants: DataFrame, queries: DataFrame) -> DataFrame:
    """Variants inside a query's codon whose substitution is derived and whose reference is ancestral.

    The range side expands to one row per base (a codon has three), which turns the
    range probe into an equi-join on (chr, pos, reference).  Letter sets are derived
    after the join, for matches only.
    """
    probe = query_coordinates(queries).withColumn("pos", F.explode(F.sequence("start_bp", "end_bp")))
    probe = probe.select("chr", "pos", F.col("ref").alias("ref_aa"), "query", "CAAP_Group", "change_side", "caas", "amino_encoded")
    anc, der = letter_sets(F.col("caas"), F.col("amino_encoded"), F.col("change_side"), F.col("CAAP_Group"))
    hit = variants.join(probe, ["chr", "pos", "ref_aa"]).withColumn("anc", anc).withColumn("der", der)
    alt = F.filter("der", lambda a: a != F.col("ref_aa"))
    hit = hit.withColumn("alt", F.when(F.size(alt) > 0, alt).otherwise(F.col("der")))
    ok = F.array_contains(F.col("alt"), F.col("alt_aa")) & ((F.size("anc") == 0) | F.array_contains(F.col("anc"), F.col("ref_aa")))
    return hit.where(ok).select(
        "query", F.col("ref_aa").alias("hg38_ref_aa"), F.array_join("alt", "").alias("caas_alt_aas"), F.col("CAAP_Group").alias("caap_group"),
        weight(F.col("CAAP_Group"), WEIGHTS_FRACTION).alias("scheme_weight"), *[F.col(c) for c in variants.columns])


def protein_score(annotated: DataFrame, score: str = "score") -> DataFrame:
    """Largest score per (query, scheme), then the mean over schemes that carry weight."""
    ok = annotated.where(F.col(score).isNotNull() & ~F.isnan(score) & (F.col("scheme_weight") > 0))
    return ok.groupBy("query", "caap_group").agg(F.max(score).alias("m")).groupBy("query").agg(
        F.avg("m").alias("pai_char_score"), F.count(F.lit(1)).alias("n_pai_schemes"))


def position_scores(scores: DataFrame, protein_map: DataFrame, meta: DataFrame) -> DataFrame:
    """Protein scores mapped to sites and joined to site metadata, one row per (Gene, Position)."""
    j = protein_map.where("query IS NOT NULL").join(scores, "query").join(meta, ["Gene", "Position"])
    rest = [c for c in j.columns if c not in ("Gene", "Position")]
    return j.groupBy("Gene", "Position").agg(F.min(F.struct(*rest)).alias("r")).select("Gene", "Position", "r.*")


def gene_scores(pos: DataFrame, genes: DataFrame) -> DataFrame:
    agg = pos.groupBy("Gene").agg(
        F.count(F.lit(1)).alias("n_pai_positions"), F.avg("pai_char_score").alias("mean_pai_char"), F.sum("pai_char_score").alias("sum_pai_char"))
    return agg.join(genes, "Gene")
