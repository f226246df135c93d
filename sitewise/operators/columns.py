"""Alignment columns in compact form.

One row per alignment column: ``gene, position, syms, residues``.  ``syms`` names
the species present (one private-use character per species, in index order) and
``residues`` their residues in the same order.  ``translate(group, syms, residues)``
then reads the residues of any species group without exploding or joining cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.schemes import translate

# Species get a character from the private-use area, then from a CJK block that
# no residue alphabet uses.  The species dimension is checked against the sum.
_FIRST_RANGE = (0xE000, 6400)
_SECOND_RANGE = (0x3400, 27000)
MAX_SPECIES = _FIRST_RANGE[1] + _SECOND_RANGE[1]

GAPS = "-XBZJUxbzju"


def species_names(df: DataFrame, col: str = "species") -> list[str]:
    """Distinct names of a species dimension; more than the symbols can hold is an error, never a cut."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_SPECIES + 1).collect()
    if len(rows) > MAX_SPECIES:
        raise ValueError(f"more than {MAX_SPECIES} species")
    return sorted(r[0] for r in rows)


class SpeciesIndex:
    """Bounded, sorted dictionary species -> symbol character."""

    def __init__(self, names: list[str]):
        self.names = sorted(set(names))
        if len(self.names) > MAX_SPECIES:
            raise ValueError(f"{len(self.names)} species exceed the index bound {MAX_SPECIES}")
        self.symbol = {name: self._char(i) for i, name in enumerate(self.names)}

    @staticmethod
    def _char(i: int) -> str:
        if i < _FIRST_RANGE[1]:
            return chr(_FIRST_RANGE[0] + i)
        return chr(_SECOND_RANGE[0] + i - _FIRST_RANGE[1])

    @classmethod
    def of(cls, df: DataFrame, col: str = "species") -> "SpeciesIndex":
        return cls(species_names(df, col))

    def frame(self, spark) -> DataFrame:
        """Two-column dimension, at most ``MAX_SPECIES`` short rows."""
        return spark.createDataFrame([(n, s) for n, s in self.symbol.items()], "species string, sym string")

    def lookup(self) -> Column:
        parts = []
        for name, sym in self.symbol.items():
            parts += [F.lit(name), F.lit(sym)]
        return F.create_map(*parts)

    def attach(self, df: DataFrame) -> DataFrame:
        """Add ``sym``; the dimension is broadcast because its size is bounded above."""
        return df.join(F.broadcast(self.frame(df.sparkSession)), "species")

    def symbols(self, names: list[str]) -> str:
        return "".join(self.symbol[n] for n in names if n in self.symbol)


def settle(df: DataFrame, *names: str) -> DataFrame:
    """Fix computed columns as row values.

    A filter on a computed column is otherwise pushed below its projection with the whole
    expression copied in at every use; behind a generator it reads the value instead.
    """
    keep = [c for c in df.columns if c not in names]
    return df.select(*keep, F.inline(F.array(F.struct(*names))))


def columns_from_cells(cells: DataFrame, index: SpeciesIndex) -> DataFrame:
    """Columns from long cells ``gene, position, species, residue`` (unique per species)."""
    members = F.sort_array(F.collect_list(F.struct("sym", "residue")))
    out = (
        index.attach(cells)
        .groupBy("gene", "position")
        .agg(members.alias("m"))
        .select(
            "gene",
            "position",
            F.array_join(F.transform("m", lambda x: x["sym"]), "").alias("syms"),
            F.array_join(F.transform("m", lambda x: x["residue"]), "").alias("residues"),
        )
    )
    return settle(out, "syms", "residues")


def columns_from_sequences(sequences: DataFrame, index: SpeciesIndex, block: int = 64) -> DataFrame:
    """Columns from aligned sequences ``gene, species, seq``.

    Sequences are cut into blocks before the shuffle, so one residue travels as one
    byte and a very long gene spreads over as many groups as it has blocks; a group
    never holds more than ``species x block`` residues.  Sequences of a gene that differ in
    length are an error.
    """
    last = F.floor((F.length("seq") - 1) / block).cast("int")
    chunks = (
        index.attach(sequences.where(F.length("seq") > 0))
        .select("gene", "sym", F.explode(F.sequence(F.lit(0), last)).alias("blk"), "seq")
        .select("gene", "sym", "blk", F.expr(f"substring(seq, blk * {block} + 1, {block})").alias("chunk"), F.length("seq").alias("n"))
    )
    grouped = chunks.groupBy("gene", "blk").agg(F.sort_array(F.collect_list(F.struct("sym", "chunk"))).alias("m"), F.min("n").alias("short"), F.max("n").alias("long"))
    # The first block holds every sequence, so one that ends early shows there.
    ragged = F.raise_error(F.concat(F.lit("sequences of unequal length in gene "), F.col("gene").cast("string"))).cast("int")
    width = F.when(F.col("short") < F.col("long"), ragged).otherwise(F.array_max(F.transform("m", lambda x: F.length(x["chunk"]))))
    cols = F.transform(
        F.sequence(F.lit(1), width),
        lambda i: F.struct(
            (F.col("blk") * block + i - 1).cast("int").alias("position"),
            F.array_join(F.transform("m", lambda x: F.substr(x["chunk"], i, F.lit(1))), "").alias("residues"),
        ),
    )
    return grouped.select(
        "gene",
        F.array_join(F.transform("m", lambda x: x["sym"]), "").alias("syms"),
        F.inline(cols),
    ).select("gene", "position", "syms", "residues")


def residue_counts(residues: Column) -> Column:
    """Non-gap character frequencies of a column."""
    text = F.replace(residues, F.lit("-"), F.lit(""))
    symbols = F.filter(F.array_distinct(F.split(text, "")), lambda s: s != "")
    return F.transform(symbols, lambda s: F.length(text) - F.length(F.replace(text, s, F.lit(""))))


def column_filter(columns: DataFrame, min_changes: int = 1, max_gaps: float = 0.5) -> DataFrame:
    """Keep columns with an acceptable gap ratio and enough residues besides the most frequent one."""
    ungapped = F.length(F.replace(F.col("residues"), F.lit("-"), F.lit("")))
    gap_ratio = (F.length("residues") - ungapped) / F.length("residues")
    # `gap_ratio` first: it is cheap and shields the per-symbol counting.
    minor = ungapped - F.coalesce(F.array_max(residue_counts(F.col("residues"))), F.lit(0))
    return columns.where((gap_ratio <= max_gaps) & (minor >= min_changes))


def conservation(columns: DataFrame) -> DataFrame:
    """Share of the most frequent residue in percent; 1 when a column has no residue."""
    ungapped = F.length(F.replace(F.col("residues"), F.lit("-"), F.lit("")))
    top = F.array_max(residue_counts(F.col("residues")))
    return columns.withColumn(
        "cons_idx", F.when(ungapped > 0, top / ungapped * 100).otherwise(F.lit(1.0))
    )


def masked(columns: DataFrame, target_syms: str) -> DataFrame:
    """Flag columns in which any target species present in the alignment carries a gap."""
    present = translate(F.col("syms"), translate(F.col("syms"), F.lit(target_syms), F.lit("")), F.lit(""))
    return columns.withColumn(
        "masked", F.contains(translate(present, F.col("syms"), F.col("residues")), F.lit("-"))
    )
