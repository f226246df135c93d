"""From filtered alignment columns to residues, and from residues to the genome, for all genes at once.

Exons and tracked intervals are kept as intervals with the running number of what stands before
them; positions find theirs by an equi-join on gene and bin.  Nothing is expanded to bases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Offsets in a bin: an interval is repeated for each bin that it touches, a codon lies in two at most.
BIN = 512


def coding_exons(lines: DataFrame, protein: str = r"protein_id=([^;]+)") -> DataFrame:
    """``protein, chrom, strand, line_no, start, end`` of the coding features among GFF lines (``line_no, line``).

    ``protein`` finds the id in the attributes; comments, other features and lines without an
    id or with bounds that are no numbers drop out.
    """
    p = F.split("line", "\t")
    at = lambda k: F.get(p, F.lit(k))
    rows = lines.where(~F.startswith("line", F.lit("#")) & (at(2) == "CDS")).select(
        F.nullif(F.regexp_extract(at(8), protein, 1), F.lit("")).alias("protein"), at(0).alias("chrom"), at(6).alias("strand"), "line_no",
        at(3).try_cast("long").alias("start"), at(4).try_cast("long").alias("end"))
    return rows.where("protein IS NOT NULL AND start <= end")


def exon_offsets(exons: DataFrame) -> DataFrame:
    """``protein, chrom, strand, first, last, start, end``: the coding offsets, from 0, that each exon holds.

    Exons are read in file order, on the minus strand backwards, as files list them by place.
    A protein's exons on several chromosomes or strands count apart.
    """
    order = F.when(F.col("strand") == "-", -F.col("line_no")).otherwise(F.col("line_no"))
    w = Window.partitionBy("protein", "chrom", "strand").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("end") - F.col("start") + 1
    rows = exons.withColumn("_o", order).withColumn("first", F.coalesce(F.sum(size).over(w), F.lit(0)))
    return rows.select("protein", "chrom", "strand", "first", (F.col("first") + size - 1).alias("last"), "start", "end")


def located(queries: DataFrame, segments: DataFrame, key: str, lo: str, hi: str) -> DataFrame:
    """Rows of ``queries`` with each segment (``first`` to ``last``) of the same key that meets ``lo`` to ``hi``.

    Both sides may have the key under the one name; other names must differ.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BIN), F.floor(F.col(b) / BIN)))
    q = queries.where(F.col(lo) <= F.col(hi)).withColumn("_bin", bins(lo, hi))
    s = segments.where("first <= last").withColumn("_bin", bins("first", "last"))
    once = F.col("_bin") == F.floor(F.greatest(F.col(lo), F.col("first")) / BIN)
    return q.join(s, [key, "_bin"]).where((F.col("first") <= F.col(hi)) & (F.col(lo) <= F.col("last")) & once).drop("_bin")


def codon_places(residues: DataFrame, offsets: DataFrame) -> DataFrame:
    """``protein, residue, chrom, strand, start, end, parts, bases``: where each residue's codon lies.

    ``residues`` is ``protein, residue`` (from 1).  ``start`` and ``end`` are the lowest and
    highest place, ``parts`` the exons it is spread over, ``bases`` fewer than 3 where the
    coding sequence ends inside it.  Residues behind the end drop out.
    """
    q = residues.select("protein", "residue").distinct().where("residue >= 1").withColumns({"lo": 3 * (F.col("residue").cast("long") - 1), "hi": 3 * F.col("residue").cast("long") - 1})
    met = located(q, offsets, "protein", "lo", "hi")
    a, b = F.greatest("lo", "first") - F.col("first"), F.least("hi", "last") - F.col("first")
    minus = F.col("strand") == "-"
    low = F.when(minus, F.col("end") - b).otherwise(F.col("start") + a)
    high = F.when(minus, F.col("end") - a).otherwise(F.col("start") + b)
    return met.withColumns({"low": low, "high": high}).groupBy("protein", "residue", "chrom", "strand").agg(
        F.min("low").alias("start"), F.max("high").alias("end"), F.count(F.lit(1)).alias("parts"), F.sum(F.col("high") - F.col("low") + 1).alias("bases"))


def codon_residues(aligned: DataFrame) -> DataFrame:
    """``gene, codon, residue`` of every aligned codon (from 1) that stands for a residue.

    ``aligned`` is ``gene, seq, n_codons``: an aligned coding sequence and how many codons the
    sequence has in full.  Codons that begin with a gap or hold an N have no residue, nor have
    those after the full sequence's last; where the full sequence goes on behind the
    alignment, the last aligned codon takes the last residue, whatever it holds.
    """
    rows = aligned.select("gene", "n_codons", F.ceil(F.length("seq") / 3).alias("_len"), F.posexplode(F.regexp_extract_all("seq", F.lit("(.{1,3})"), F.lit(1))).alias("_k", "_c"))
    good = ~F.startswith("_c", F.lit("-")) & ~F.contains(F.upper("_c"), F.lit("N"))
    w = Window.partitionBy("gene").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"codon": F.col("_k") + 1, "_good": good}).withColumn("residue", F.sum(F.col("_good").cast("long")).over(w))
    last = (F.col("codon") == F.col("_len")) & (F.col("residue") < F.col("n_codons"))
    return rows.where((F.col("_good") & (F.col("residue") <= F.col("n_codons"))) | (last & (F.col("residue") > 0))).select("gene", F.col("codon").cast("long").alias("codon"), "residue")


def tracked(lines: DataFrame) -> DataFrame:
    """``gene, first, last, start``: the kept intervals of each gene (``gene, line``) with the filtered positions, from 0, that they hold.

    Positions stand as numbers and ``a-b`` ranges on the line with ``selected:``; words that are
    neither are skipped, and ranges that run backwards hold nothing.
    """
    tok = F.posexplode(F.split(F.trim(F.regexp_replace("line", r"^.*?selected:", "")), r"\s+"))
    rows = lines.where(F.contains("line", F.lit("selected:"))).select("gene", tok).where(F.col("col").rlike(r"^\d+(-\d+)?$"))
    lo = F.split_part("col", F.lit("-"), F.lit(1)).cast("long")
    rows = rows.select("gene", "pos", lo.alias("start"), F.coalesce(F.nullif(F.split_part("col", F.lit("-"), F.lit(2)), F.lit("")).cast("long"), lo).alias("end")).where("start <= end")
    w = Window.partitionBy("gene").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(w), F.lit(0))
    return rows.withColumn("first", first).select("gene", "first", (F.col("first") + F.col("end") - F.col("start")).alias("last"), "start")


def protein_positions(sites: DataFrame, tracking: DataFrame, residues: DataFrame) -> DataFrame:
    """``gene, position, codon, residue, query``: filtered positions led back to aligned codons and residues.

    Positions outside the kept ones and codons without a residue drop out; ``query`` is the
    name by which coordinates are asked for.
    """
    q = sites.select("gene", F.col("position").cast("long").alias("position")).distinct()
    met = located(q, tracking, "gene", "position", "position")
    codon = met.select("gene", "position", (F.col("start") + F.col("position") - F.col("first")).alias("codon"))
    return codon.join(residues, ["gene", "codon"]).select("gene", "position", "codon", "residue", F.concat("gene", F.lit(":p."), F.col("residue").cast("string")).alias("query"))


def fasta_lengths(sequences: DataFrame) -> DataFrame:
    """``gene, n_codons`` of full coding sequences (``gene, seq``); a rest of one or two bases is a codon."""
    return sequences.groupBy("gene").agg(F.ceil(F.sum(F.length("seq")) / 3).alias("n_codons"))


def place_text(chrom: str, start: str, end: str) -> Column:
    """``chrom:g.start_end``, or one place where they are the same."""
    one = F.concat(F.col(chrom), F.lit(":g."), F.col(start).cast("string"))
    return F.when(F.col(start) == F.col(end), one).otherwise(F.concat(one, F.lit("_"), F.col(end).cast("string")))
