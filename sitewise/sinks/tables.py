"""Table sinks.  Writers take a DataFrame and a path; renderers return the rows to write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def render_background(background: DataFrame) -> DataFrame:
    """``gene`` and its tested positions as an ascending comma list, ``NULL`` when none."""
    text = F.array_join(F.transform("positions", lambda p: p.cast("string")), ",")
    return background.select("gene", F.coalesce(text, F.lit("NULL")).alias("positions"))


def background_genes(rendered: DataFrame) -> DataFrame:
    """Distinct genes with at least one tested position."""
    return rendered.where("positions IS NOT NULL AND positions <> 'NULL'").select("gene").distinct()


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """Header-only table of a schema: what every stage returns for empty input."""
    return spark.createDataFrame([], schema)


def write_tsv(df: DataFrame, path: str, header: bool = True, compress: bool = False) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).option(
        "compression", "gzip" if compress else "none").csv(path)


def write_csv(df: DataFrame, path: str, compress: bool = False) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip" if compress else "none").csv(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write a discovery table only when it has rows."""
    if df.limit(1).count() == 0:
        return False
    write_tsv(df, path)
    return True


def concat(parts: list[DataFrame]) -> DataFrame:
    """Union by name; columns missing in some parts become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_resamples(resamples: DataFrame, path: str, chunk: int = 500) -> None:
    """``cycle<TAB>fg<TAB>bg`` lines in files of at most ``chunk`` cycles."""
    out = resamples.select("cycle", F.array_join("fg", ",").alias("fg"), F.array_join("bg", ",").alias("bg"))
    out.write.mode("overwrite").option("sep", "\t").option("maxRecordsPerFile", chunk).csv(path)


def bootstrap_lines(boot: DataFrame) -> DataFrame:
    """Headerless five-column form with the ``GENE@position`` token."""
    return boot.select(F.concat_ws("@", "Gene", F.col("Position").cast("string")).alias("GenePos"), "CAAP_Group", "Occurrences", "Total", "Pvalue_boot")


def gene_lines(df: DataFrame, col: str = "gene") -> DataFrame:
    """Unique non-null genes in order, one per line."""
    return df.select(F.col(col).alias("gene")).where(F.col("gene").isNotNull() & (F.col("gene") != "")).distinct().orderBy("gene")


def write_gene_list(df: DataFrame, path: str, col: str = "gene") -> bool:
    lines = gene_lines(df, col)
    if lines.limit(1).count() == 0:
        return False
    lines.write.mode("overwrite").text(path)
    return True


def write_results(df: DataFrame, path: str) -> None:
    """Intermediate result store: parquet clustered by gene, ready for per-gene pruning."""
    df.repartitionByRange("gene").sortWithinPartitions("gene").write.mode("overwrite").parquet(path)


def json_cells(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text for flat files."""
    def cell(f) -> Column:
        nested = f.dataType.typeName() in ("array", "map", "struct")
        return F.to_json(F.col(f.name)).alias(f.name) if nested else F.col(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def pair_json(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """One JSON document per site: labels plus the ordered pair details.

    A site holds one entry per contrast pair.
    """
    change = lambda tip: F.struct(F.col("focal_state").alias("from"), F.col(tip).alias("to"), (F.col("focal_state") != F.col(tip)).alias("changed"))
    entry = F.struct(
        F.col("pair_id"), F.col("focal_state").alias("mrca_state"), F.col("posterior").alias("mrca_posterior"),
        F.struct(F.col("top_tip").alias("top"), F.col("bottom_tip").alias("bottom")).alias("tip_states"),
        change("top_tip").alias("top_change"), change("bottom_tip").alias("bottom_change"),
        (F.coalesce(F.col("focal_state") != F.col("top_tip"), F.lit(False)) | F.coalesce(F.col("focal_state") != F.col("bottom_tip"), F.lit(False))).alias("pair_change"),
        F.coalesce(F.col("top_tip") == F.col("bottom_tip"), F.lit(False)).alias("conserved"))
    per = pairs.groupBy("gene", "site").agg(F.array_sort(F.collect_list(entry)).alias("pairs"))
    doc = labels.join(per, ["gene", "site"], "left")
    return doc.select("gene", "site", F.to_json(F.struct(*[c for c in doc.columns])).alias("json"))


def gene_json(labels: DataFrame) -> DataFrame:
    """Per-gene summary counts of the change labels."""
    agg = labels.groupBy("gene").agg(
        F.count(F.lit(1)).alias("n_sites"), *[F.count_if(F.col("change_side") == s).alias(f"n_{s}") for s in ("top", "bottom", "both", "none")])
    return agg.select("gene", F.to_json(F.struct("n_sites", "n_top", "n_bottom", "n_both", "n_none")).alias("json"))
