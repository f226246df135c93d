"""Contrast scan over alignment columns: discovery, background and bootstrap."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions import patterns as P
from sitewise.functions.arrays import entries
from sitewise.functions.pvalue import site_pvalue, symbol_counts, total_of
from sitewise.functions.schemes import AMBIGUOUS, RESIDUES, SCHEMES, codes, encode_keep, known_only, scheme_table, translate
from sitewise.operators.columns import GAPS, SpeciesIndex, column_filter, settle
from sitewise.session import checkpoint

MAX_CONFIG_ROWS = 200_000
#: Parts into which the columns are cut where they meet a block of cycles.
SALTS = 64


@dataclass
class Limits:
    """Gap and missing caps; ``None`` switches a cap off."""

    fg_gaps: int | None = None
    bg_gaps: int | None = None
    all_gaps: int | None = None
    fg_miss: int | None = None
    bg_miss: int | None = None
    all_miss: int | None = None
    pair_aware: bool = False
    # When both side caps are off but an overall cap is set, the classical scan
    # still treats the sides as equal; the property scan does not.
    overall_counts_as_equal: bool = True


def fraction_limits(n_pairs: int, gaps: float | None = None, miss: float | None = None) -> Limits:
    """Caps expressed as a fraction of the number of contrast pairs, rounded down."""
    g = None if gaps is None else int(n_pairs * gaps)
    m = None if miss is None else int(n_pairs * miss)
    return Limits(fg_gaps=g, bg_gaps=g, fg_miss=m, bg_miss=m)


def max_conserved_from_fraction(n_pairs: int, min_divergent_fraction: float) -> int:
    return int(n_pairs * (1 - min_divergent_fraction))


@dataclass
class Contrast:
    """One trait: ordered species per side with their pair ids."""

    trait: str
    fg: list[tuple[str, str | None]] = field(default_factory=list)
    bg: list[tuple[str, str | None]] = field(default_factory=list)


def _pair_order(item: tuple[str, str | None]) -> tuple[float, str]:
    species, pair = item
    try:
        return (float(int(pair)), species)
    except (TypeError, ValueError):
        return (float("inf"), species)


def load_contrasts(config: DataFrame) -> list[Contrast]:
    """Trait configuration ``trait, species, grp, pair`` as driver-side contrasts.

    A configuration lists species, never sites; its size is checked before collecting.
    """
    rows = config.select("trait", "species", "grp", "pair").limit(MAX_CONFIG_ROWS + 1).collect()
    if len(rows) > MAX_CONFIG_ROWS:
        raise ValueError("trait configuration is larger than a species table can be")
    out: dict[str, Contrast] = {}
    for r in rows:
        c = out.setdefault(r["trait"], Contrast(r["trait"]))
        (c.fg if int(r["grp"]) == 1 else c.bg).append((r["species"], None if r["pair"] is None else str(r["pair"])))
    for c in out.values():
        c.fg.sort(key=_pair_order)
        c.bg.sort(key=_pair_order)
    return [out[k] for k in sorted(out)]


def contrast_table(contrasts: list[Contrast], index: SpeciesIndex) -> Column:
    """Literal ``array<struct>`` with one entry per trait.

    Configured species absent from the alignment count as missing, so the index has to
    be built over the configuration as well.
    """
    unknown = sorted({s for c in contrasts for s, _ in c.fg + c.bg} - set(index.names))
    if unknown:
        raise ValueError(f"species missing from the index: {', '.join(unknown)}")

    def strings(items):
        return F.array(*[F.lit(x).cast("string") for x in items]) if items else F.array().cast("array<string>")

    return F.array(
        *[
            F.struct(
                F.lit(c.trait).alias("trait"),
                F.lit(index.symbols([s for s, _ in c.fg])).alias("fg_syms"),
                F.lit(index.symbols([s for s, _ in c.bg])).alias("bg_syms"),
                strings([s for s, _ in c.fg]).alias("fg_names"),
                strings([s for s, _ in c.bg]).alias("bg_names"),
                strings([p for _, p in c.fg]).alias("fg_pairs"),
                strings([p for _, p in c.bg]).alias("bg_pairs"),
            )
            for c in contrasts
        ]
    )


def read_sides(df: DataFrame) -> DataFrame:
    """Residues, gaps and missing species of both sides for rows with ``fg_syms``/``bg_syms``."""
    for side in ("fg", "bg"):
        syms = F.col(f"{side}_syms")
        missing = translate(syms, F.col("syms"), F.lit(""))
        df = df.withColumn(f"{side}_missing", missing)
        present = translate(syms, F.col(f"{side}_missing"), F.lit(""))
        df = df.withColumn(f"{side}_seen", translate(present, F.col("syms"), F.col("residues")))
        df = df.withColumn(f"{side}", translate(F.col(f"{side}_seen"), F.lit(GAPS), F.lit("")))
    df = (
        df.withColumn("GFG", F.length("fg_seen") - F.length("fg"))
        .withColumn("GBG", F.length("bg_seen") - F.length("bg"))
        .withColumn("MFG", F.length("fg_missing"))
        .withColumn("MBG", F.length("bg_missing"))
    )
    return settle(df, "fg_missing", "fg_seen", "fg", "bg_missing", "bg_seen", "bg", "GFG", "GBG", "MFG", "MBG")


def _cap(value: Column, cap: int | None) -> Column:
    return F.lit(True) if cap is None else value <= cap


def _equal_caps(fg: int | None, bg: int | None, overall: int | None, overall_equal: bool) -> bool:
    if fg is not None and bg is not None:
        return fg == bg
    return overall_equal and fg is None and bg is None and overall is not None


def testable(limits: Limits) -> Column:
    """Rows whose sides both carry a residue and respect every cap."""
    some = lambda c: F.length(F.replace(F.col(c), F.lit("-"), F.lit(""))) > 0
    ok = some("fg_seen") & some("bg_seen")
    ok = ok & _cap(F.col("GFG"), limits.fg_gaps) & _cap(F.col("GBG"), limits.bg_gaps)
    ok = ok & _cap(F.col("GFG") + F.col("GBG"), limits.all_gaps)
    ok = ok & _cap(F.col("MFG"), limits.fg_miss) & _cap(F.col("MBG"), limits.bg_miss)
    ok = ok & _cap(F.col("MFG") + F.col("MBG"), limits.all_miss)
    if limits.pair_aware:
        if _equal_caps(limits.fg_miss, limits.bg_miss, limits.all_miss, limits.overall_counts_as_equal):
            ok = ok & _same_pairs("miss")
        if _equal_caps(limits.fg_gaps, limits.bg_gaps, limits.all_gaps, limits.overall_counts_as_equal):
            ok = ok & _same_pairs("gap")
    return ok


def _character_kind(side: str, kind: str) -> Column:
    """Pair ids (distinct, sorted) of the side's species that are missing or gapped."""
    full = translate(F.col(f"{side}_syms"), F.col("syms"), F.col("residues"))
    wanted = F.col(f"{side}_missing") if kind == "miss" else F.lit(GAPS)
    hits = F.filter(
        F.transform(
            F.col(f"{side}_pairs"),
            lambda p, i: F.when(F.contains(wanted, F.substr(full, i + 1, F.lit(1))), p),
        ),
        lambda p: p.isNotNull(),
    )
    return F.array_sort(F.array_distinct(hits))


def _same_pairs(kind: str) -> Column:
    fg, bg = _character_kind("fg", kind), _character_kind("bg", kind)
    return (F.size(fg) == 0) | (F.size(bg) == 0) | (fg == bg)


def tested_columns(columns: DataFrame, contrasts: list[Contrast], index: SpeciesIndex, limits: Limits) -> DataFrame:
    """Column x trait rows that pass the gap and missing rules."""
    exploded = columns.select("*", F.inline(contrast_table(contrasts, index)))
    return read_sides(exploded).where(testable(limits))


def background(tested: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """``gene, positions`` (ascending); genes without a tested position get NULL."""
    out = tested.groupBy("gene").agg(F.array_sort(F.collect_set("position")).alias("positions"))
    if genes is not None:
        out = genes.select("gene").distinct().join(out, "gene", "left")
    return out


def _kept_names(side: str) -> Column:
    full = translate(F.col(f"{side}_syms"), F.col("syms"), F.col("residues"))
    bad = F.concat(F.lit(GAPS), F.col(f"{side}_missing"))
    return F.filter(F.col(f"{side}_names"), lambda n, i: ~F.contains(bad, F.substr(full, i + 1, F.lit(1))))


def _kept_pairs(side: str) -> Column:
    full = translate(F.col(f"{side}_syms"), F.col("syms"), F.col("residues"))
    bad = F.concat(F.lit(GAPS), F.col(f"{side}_missing"))
    return F.filter(F.col(f"{side}_pairs"), lambda n, i: ~F.contains(bad, F.substr(full, i + 1, F.lit(1))))


def _missing_names() -> Column:
    def names(side: str) -> Column:
        return F.filter(
            F.col(f"{side}_names"),
            lambda n, i: F.contains(F.col(f"{side}_missing"), F.substr(F.col(f"{side}_syms"), i + 1, F.lit(1))),
        )

    return F.concat(names("fg"), names("bg"))


def _admitted_hit(fg: Column, bg: Column, max_conserved: int, admitted: tuple[str, ...]) -> Column:
    if set(admitted) == {"1", "2", "3"}:
        return P.one_sided_hit(fg, bg, max_conserved)
    return P.diverges(fg, bg, max_conserved) & P.pattern_class(fg, bg).isin(*admitted)


def discover(
    tested: DataFrame,
    mode: str = "CAAP",
    max_conserved: int = 0,
    admitted: tuple[str, ...] = ("1", "2", "3"),
    schemes: list[str] | None = None,
) -> DataFrame:
    """Divergent columns with pattern class, side lists and closed-form p-value.

    ``mode='CAAS'`` tests residues, ``mode='CAAP'`` tests residue classes under every
    scheme.  The p-value is evaluated after the hit filter, so only hits pay for it.
    """
    if mode == "CAAS":
        df = tested.withColumn("CAAP_Group", F.lit("US"))
        df = df.withColumn("fg_test", F.col("fg")).withColumn("bg_test", F.col("bg"))
        population = F.replace(F.col("residues"), F.lit("-"), F.lit(""))
        removed = P.matched_characters(F.col("fg"), F.col("bg"))
    else:
        df = tested.where((F.length("fg") > 0) & (F.length("bg") > 0))
        # Codes are constants inside each entry, so their lookup tables are built once.
        df = df.withColumn("fg_known", known_only(F.col("fg"))).withColumn("bg_known", known_only(F.col("bg")))
        df = df.select("*", F.inline(entries(
            ["CAAP_Group", "codes", "fg_test", "bg_test"],
            *[(s, codes(s), F.translate("fg_known", RESIDUES, codes(s)), F.translate("bg_known", RESIDUES, codes(s))) for s in schemes or SCHEMES])))
        population = encode_keep(F.upper(F.replace(F.col("residues"), F.lit("-"), F.lit(""))), F.col("codes"))
        removed = P.matched_characters(
            encode_keep(F.upper("fg"), F.col("codes")), encode_keep(F.upper("bg"), F.col("codes"))
        )
    fg, bg = F.col("fg_test"), F.col("bg_test")
    hits = df.where(_admitted_hit(fg, bg, max_conserved, admitted)).withColumn("Pattern", P.pattern_class(fg, bg))
    hits = hits.withColumn("population", population)
    hits = hits.withColumn("removed", removed if max_conserved > 0 else F.lit(""))
    dropped = (F.length("removed") / 2).cast("int")
    counts = symbol_counts(F.col("population"), F.col("removed") if max_conserved > 0 else None)
    hits = hits.withColumns({"counts": counts, "n_fg": F.length("fg") - dropped, "n_bg": F.length("bg") - dropped})
    hits = settle(settle(hits, "counts", "n_fg", "n_bg").withColumn("n_all", total_of(F.col("counts"))), "n_all")
    hits = hits.withColumn("Pvalue", site_pvalue(F.col("counts"), F.col("n_fg"), F.col("n_bg"), F.col("n_all")))
    none = F.lit("NA" if mode == "CAAP" else "-")
    ms = F.array_join(_missing_names(), ",")
    out = [
        F.col("gene").alias("Gene"),
        F.lit(mode).alias("Mode"),
        "CAAP_Group",
        F.col("trait").alias("Trait"),
        F.col("position").alias("Position"),
        F.concat_ws("/", "fg", "bg").alias("Substitution"),
        *([F.concat_ws("/", "fg_test", "bg_test").alias("Encoded")] if mode == "CAAP" else []),
        "Pvalue",
        "Pattern",
        F.length("fg").alias("FFGN"),
        F.length("bg").alias("FBGN"),
        "GFG", "GBG", "MFG", "MBG",
        F.array_join(_kept_names("fg"), ",").alias("FFG"),
        F.array_join(_kept_names("bg"), ",").alias("FBG"),
        F.when(F.length(ms) > 0, ms).otherwise(none).alias("MS"),
    ]
    if max_conserved > 0:
        out += [
            (P.overlap(fg, bg) > 0).alias("ConservedPair"),
            P.conserved_pairs(fg, bg, _kept_pairs("fg")).alias("ConservedPairs"),
        ]
    return hits.select(*out)


def scan(
    columns: DataFrame,
    config: DataFrame,
    index: SpeciesIndex,
    limits: Limits | None = None,
    min_changes: int = 1,
    max_gaps: float = 0.5,
    **kwargs,
) -> DataFrame:
    """Column filter, caps and divergence test in one narrow pass over the columns."""
    kept = column_filter(columns, min_changes, max_gaps)
    return discover(tested_columns(kept, load_contrasts(config), index, limits or Limits()), **kwargs)


def discovered_schemes(discovery: DataFrame) -> DataFrame:
    """``gene, position, schemes``: what the bootstrap has to re-test per column.

    A classical hit re-tests every scheme, a property hit only its own.
    """
    every = F.array(*[F.lit(s) for s in SCHEMES])
    wanted = F.when(F.col("Mode") == "CAAS", every).otherwise(F.array("CAAP_Group"))
    return (
        discovery.select(F.col("Gene").alias("gene"), F.col("Position").alias("position"), F.explode(wanted).alias("s"))
        .groupBy("gene", "position")
        .agg(F.array_sort(F.collect_set("s")).alias("schemes"))
    )


def packed_sets(resamples: DataFrame, index: SpeciesIndex) -> DataFrame:
    """Resamples ``cycle, fg[], bg[]`` as symbol strings; equal sets have equal strings."""
    lookup = index.lookup()

    def pack(col: str) -> Column:
        return F.array_join(
            F.filter(F.transform(F.array_sort(col), lambda s: F.try_element_at(lookup, s)), lambda s: s.isNotNull()), ""
        )

    return resamples.select("cycle", pack("fg").alias("fg_syms"), pack("bg").alias("bg_syms"))


def set_blocks(sets: DataFrame, n_blocks: int) -> DataFrame:
    """Distinct sets ``fg_syms, bg_syms, times`` in ``n_blocks`` rows."""
    return sets.withColumn("blk", F.pmod(F.xxhash64("fg_syms", "bg_syms"), F.lit(n_blocks)).cast("int")).groupBy("blk").agg(
        F.collect_list(F.struct("fg_syms", "bg_syms", "times")).alias("sets")
    )


# Markers inside a full-width column string: gap, ambiguous, unmapped, not in the alignment.
GAP, AMBIGUOUS_MARK, UNMAPPED, ABSENT = "-", "~", ".", "!"


def _full_width(index: SpeciesIndex) -> Column:
    """Residues of every indexed species in index order, ``!`` for absent ones."""
    whole = translate(F.lit(index.symbols(index.names)), F.col("syms"), F.col("residues"))
    return F.regexp_replace(whole, "[\ue000-\uf8ff\u3400-\u9fff]", ABSENT)


def _replay(columns: DataFrame, discovery: DataFrame | None, packed: DataFrame, index: SpeciesIndex,
            limits: Limits, max_conserved: int, admitted: tuple[str, ...]) -> DataFrame:
    """Column x scheme x set rows with a ``hit`` flag and the cycles that have the set, ``times``.

    Everything that depends on the column alone (class codes, gap and absence markers)
    is laid out once per column and scheme; a set then costs one lookup per side, however
    many cycles drew it, for equal sets have equal outcomes.  Sets travel in blocks of a few
    hundred: columns are expanded by block number and meet the block by a shuffled equi-join,
    so neither side is collected, cross joined or broadcast.
    """
    if discovery is None:
        sites = columns.withColumn("schemes", F.array(*[F.lit(s) for s in SCHEMES]))
    else:
        sites = columns.join(discovered_schemes(discovery), ["gene", "position"])
    sets = checkpoint(packed.groupBy("fg_syms", "bg_syms").agg(F.count(F.lit(1)).alias("times")))
    n_blocks = max(1, -(-sets.count() // 256))
    blocks = set_blocks(sets, n_blocks)
    by_scheme = F.filter(scheme_table(), lambda x: F.array_contains(F.col("schemes"), x["scheme"]))
    marked = F.translate(F.regexp_replace(F.col("raw"), f"[^{RESIDUES}{AMBIGUOUS}{AMBIGUOUS.lower()}!-]", UNMAPPED),
                         AMBIGUOUS + AMBIGUOUS.lower(), AMBIGUOUS_MARK * (2 * len(AMBIGUOUS)))
    laid = sites.withColumn("raw", _full_width(index)).select(
        "gene", "position", "raw", marked.alias("marked"), F.inline(by_scheme))
    laid = laid.select("gene", "position", "raw", "scheme", encode_keep(F.col("marked"), F.col("codes")).alias("laid"))
    # A few block numbers would be a few hot keys: columns keep a salt, blocks are repeated for each salt.
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    laid = laid.withColumn("salt", F.pmod(F.xxhash64("gene", "position", "scheme"), F.lit(SALTS)).cast("int"))
    laid = laid.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    # Few, small rows that each expand to every set: dealt by their keys' number, not by bytes.
    tasks = min(1024, n_blocks * SALTS)
    rows = (
        laid.repartition(tasks, "blk", "salt")
        .join(salted.repartition(tasks, "blk", "salt").hint("merge"), ["blk", "salt"])
        .select("gene", "position", "raw", "scheme", "laid", F.inline("sets"))
    )
    every = F.lit(index.symbols(index.names))
    for side in ("fg", "bg"):
        rows = rows.withColumn(f"{side}_all", translate(F.col(f"{side}_syms"), every, F.col("laid")))
        rows = rows.withColumn(f"{side}_test", F.translate(f"{side}_all", GAP + AMBIGUOUS_MARK + UNMAPPED + ABSENT, ""))

    def count(side: str, marks: str) -> Column:
        return F.length(f"{side}_all") - F.length(F.translate(f"{side}_all", marks, ""))

    gaps = {s: count(s, GAP + AMBIGUOUS_MARK) for s in ("fg", "bg")}
    miss = {s: count(s, ABSENT) for s in ("fg", "bg")}
    ok = _cap(gaps["fg"], limits.fg_gaps) & _cap(gaps["bg"], limits.bg_gaps) & _cap(gaps["fg"] + gaps["bg"], limits.all_gaps)
    ok = ok & _cap(miss["fg"], limits.fg_miss) & _cap(miss["bg"], limits.bg_miss) & _cap(miss["fg"] + miss["bg"], limits.all_miss)
    return rows.withColumn("hit", _admitted_hit(F.col("fg_test"), F.col("bg_test"), max_conserved, admitted) & ok)


def bootstrap(
    columns: DataFrame,
    discovery: DataFrame | None,
    resamples: DataFrame,
    index: SpeciesIndex,
    limits: Limits | None = None,
    max_conserved: int = 0,
    admitted: tuple[str, ...] = ("1", "2", "3"),
) -> DataFrame:
    """Empirical p per (gene, position, scheme) over all resamples; zero counts are kept."""
    n_cycles = resamples.count()
    rows = _replay(columns, discovery, packed_sets(resamples, index), index, limits or Limits(), max_conserved, admitted)
    return (
        rows.groupBy("gene", "position", F.col("scheme").alias("CAAP_Group"))
        .agg(F.sum(F.col("hit").cast("long") * F.col("times")).alias("Occurrences"))
        .select(
            F.col("gene").alias("Gene"),
            F.col("position").alias("Position"),
            "CAAP_Group",
            "Occurrences",
            F.lit(n_cycles).cast("long").alias("Total"),
            (F.col("Occurrences") / F.lit(n_cycles)).alias("Pvalue_boot"),
        )
    )


def bootstrap_hits(columns, discovery, resamples, index, limits=None, max_conserved=0,
                   admitted=("1", "2", "3")) -> DataFrame:
    """The per-cycle hits themselves (groups and permuted-discovery exports)."""
    packed = checkpoint(packed_sets(resamples, index))
    rows = _replay(columns, discovery, packed, index, limits or Limits(), max_conserved, admitted)
    every = F.lit(index.symbols(index.names))
    rows = settle(rows, "hit", "fg_test", "bg_test").where("hit")
    for side in ("fg", "bg"):
        rows = rows.withColumn(side, F.translate(translate(F.col(f"{side}_syms"), every, F.col("raw")), GAPS + ABSENT, ""))
    return rows.join(packed, ["fg_syms", "bg_syms"]).select(
        "cycle",
        F.col("gene").alias("Gene"),
        F.col("position").alias("Position"),
        F.col("scheme").alias("CAAP_Group"),
        F.concat_ws("/", "fg", "bg").alias("Substitution"),
        F.concat_ws("/", "fg_test", "bg_test").alias("Encoded"),
        P.pattern_class(F.col("fg_test"), F.col("bg_test")).alias("Pattern"),
    )
