"""Alignment readers: one file per gene, parsed inside Spark with array functions.

Every parser maps ``gene, text`` to ``gene, species, seq``.  A file is one alignment and
is parsed as a whole; files spread over tasks.
"""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File suffixes that are never alignments.
SKIP_SUFFIXES = ["txt", "tsv", "csv", "tab", "log", "json", "md", "html"]


def gene_of(path: Column) -> Column:
    """Base name up to the first dot."""
    return F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)


def infer_format(path: str, fmt: str = "auto") -> str:
    if fmt != "auto":
        return fmt
    return "fasta" if PurePath(path).suffix.lower() in (".fa", ".fasta") else "phylip-relaxed"


def format_of(path: Column) -> Column:
    """``infer_format`` for a column of paths."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(suffix.isin("fa", "fasta"), "fasta").otherwise("phylip-relaxed")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``path, gene, text`` for every alignment file below ``path``."""
    df = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return df.where(~suffix.isin(*SKIP_SUFFIXES)).select("path", gene_of(F.col("path")).alias("gene"), "text")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\r?\n"), lambda x: F.trim(x) != "")


def _merge(pairs: Column) -> Column:
    """Concatenate chunks of equal names in order: ``array<struct<name, chunk>>`` to ``array<struct<species, seq>>``."""
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    return F.transform(names, lambda n: F.struct(n.alias("species"), F.array_join(
        F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["chunk"]), "").alias("seq")))


def _named(line: Column) -> Column:
    """Name and gap-free remainder of a ``name sequence`` line."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\S+\s+", ""), r"\s+(\d+)?$", "")
    return F.struct(F.regexp_extract(F.trim(line), r"^(\S+)", 1).alias("name"), F.regexp_replace(rest, r"\s", "").alias("chunk"))


def fasta(text: Column) -> Column:
    records = F.filter(F.split(text, "(?:^|\n)>"), lambda r: F.trim(r) != "")
    return F.transform(records, lambda r: F.struct(
        F.regexp_extract(r, r"^\s*(\S+)", 1).alias("species"),
        F.regexp_replace(F.regexp_replace(r, r"^[^\n]*(\n|$)", ""), r"\s", "").alias("seq")))


def phylip(text: Column) -> Column:
    """Relaxed PHYLIP, sequential or interleaved: the first block carries the names."""
    lines = _lines(text)
    n = F.regexp_extract(F.element_at(lines, 1), r"^\s*(\d+)", 1).cast("int")
    body = F.slice(lines, F.lit(2), F.size(lines))
    blocks = F.greatest(F.floor(F.size(body) / n).cast("int"), F.lit(1))

    def one(i: Column) -> Column:
        first = F.get(body, i)
        more = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.when(
            b == 0, F.regexp_replace(F.trim(first), r"^\S+\s+", "")).otherwise(F.get(body, b * n + i)))
        return F.struct(F.regexp_extract(F.trim(first), r"^(\S+)", 1).alias("species"), F.regexp_replace(F.array_join(more, ""), r"\s", "").alias("seq"))

    return F.transform(F.sequence(F.lit(0), n - 1), one)


def clustal(text: Column) -> Column:
    body = F.filter(_lines(text), lambda x: ~x.rlike(r"^\s") & ~F.upper(x).startswith("CLUSTAL"))
    return _merge(F.transform(body, _named))


def stockholm(text: Column) -> Column:
    body = F.filter(_lines(text), lambda x: ~x.startswith("#") & ~x.startswith("//"))
    return _merge(F.transform(body, _named))


def nexus(text: Column) -> Column:
    matrix = F.regexp_extract(text, r"(?is)matrix\s*\n(.*?);", 1)
    body = F.filter(_lines(matrix), lambda x: ~F.trim(x).startswith("["))
    return _merge(F.transform(body, _named))


def maf(text: Column) -> Column:
    """Alignment blocks of ``s`` lines; a source that a block lacks is gaps as wide as the block."""
    def block(part: Column) -> Column:
        rows = F.transform(F.filter(_lines(part), lambda x: x.rlike(r"^s\s")), lambda x: F.struct(
            F.regexp_extract(x, r"^s\s+(\S+)", 1).alias("name"), F.regexp_extract(x, r"(\S+)\s*$", 1).alias("chunk")))
        return F.struct(rows.alias("rows"), F.array_max(F.transform(rows, lambda r: F.length(r["chunk"]))).alias("width"))

    blocks = F.filter(F.transform(F.split(text, r"(?m)^a(?=\s|$)"), block), lambda b: F.size(b["rows"]) > 0)
    names = F.array_distinct(F.flatten(F.transform(blocks, lambda b: F.transform(b["rows"], lambda r: r["name"]))))

    def chunk(b: Column, name: Column) -> Column:
        return F.coalesce(F.get(F.filter(b["rows"], lambda r: r["name"] == name), F.lit(0))["chunk"], F.repeat(F.lit("-"), b["width"]))

    return F.transform(names, lambda n: F.struct(n.alias("species"), F.array_join(F.transform(blocks, lambda b: chunk(b, n)), "").alias("seq")))


PARSERS = {
    "fasta": fasta, "phylip": phylip, "phylip-relaxed": phylip, "phylip-sequential": phylip,
    "clustal": clustal, "stockholm": stockholm, "nexus": nexus, "maf": maf,
}


def parse(texts: DataFrame, fmt: str) -> DataFrame:
    """``gene, species, seq``; the last record of a repeated name wins."""
    rows = texts.select("gene", F.posexplode(PARSERS[fmt](F.col("text")))).select("gene", "pos", "col.species", "col.seq")
    return rows.groupBy("gene", "species").agg(F.max_by("seq", "pos").alias("seq"))


def read_alignments(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    texts = read_texts(spark, path)
    if fmt != "auto":
        return parse(texts, fmt)
    is_fasta = F.lower("path").rlike(r"\.(fa|fasta)$")
    return parse(texts.where(is_fasta), "fasta").unionByName(parse(texts.where(~is_fasta), "phylip-relaxed"))
