"""Scalar labels, parsers and coercions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings accepted as true.
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
# The narrower list used by the score computation.
TRUE_WORDS_SCORE = ["true", "1", "yes"]
# Change labels that count as a substantive change.
SUBSTANTIVE = ["convergent", "divergent", "codivergent"]


def as_bool(c: Column, words: list[str] = TRUE_WORDS) -> Column:
    """Boolean from text; NULL counts as false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*words), F.lit(False))


def significance_class(hyp: Column, perm: Column) -> Column:
    return (
        F.when(hyp & perm, "both").when(hyp, "hyper_only").when(perm, "perm_only").otherwise("none")
    )


def significance_level(hyp: Column, perm: Column) -> Column:
    return (
        F.when(hyp & perm, "Both").when(hyp, "Hypergeometric").when(perm, "Permutation").otherwise("Not Significant")
    )


def normal_parallel(c: Column) -> Column:
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isNull() | text.isin("", "na", "nan", "null"), "none").otherwise(text)


def pattern_parallel(pattern: Column, parallel: Column) -> Column:
    """``pattern / parallel``; only the pattern when there is no parallel label."""
    pat = F.when(pattern.isNull() | (pattern == ""), "unknown").otherwise(pattern)
    par = normal_parallel(parallel)
    return F.when(par == "none", pat).otherwise(F.concat_ws(" / ", pat, par))


def collapse_sides(sides: Column) -> Column:
    """One side label for an array of labels."""
    known = F.filter(F.transform(sides, lambda s: F.lower(s)), lambda s: s.isin("top", "bottom", "both"))
    return (
        F.when(F.size(known) == 0, "none")
        .when(F.array_contains(known, "both"), "both")
        .when(F.array_contains(known, "top") & F.array_contains(known, "bottom"), "both")
        .otherwise(F.try_element_at(known, F.lit(1)))
    )


def change_class(derived: Column) -> Column:
    """Change label of one side from the derived states of its changed pairs."""
    n, k = F.size(derived), F.size(F.array_distinct(derived))
    return (
        F.when(n == 0, "no_change").when(n == 1, "ambiguous").when(k == 1, "convergent")
        .when(k < n, "codivergent").otherwise("divergent")
    )


def parallelism(ancestors: Column) -> Column:
    """'True' identical, 'False' all distinct, 'MIXED' otherwise; NULL below two ancestors."""
    n, k = F.size(ancestors), F.size(F.array_distinct(ancestors))
    return F.when(n < 2, F.lit(None)).when(k == 1, "True").when(k == n, "False").otherwise("MIXED")


def change_side(top: Column, bottom: Column) -> Column:
    t, b = top.isin(*SUBSTANTIVE), bottom.isin(*SUBSTANTIVE)
    return F.when(t & b, "both").when(t, "top").when(b, "bottom").otherwise("none")


def pattern_type(top: Column, bottom: Column) -> Column:
    t, b = top.isin(*SUBSTANTIVE), bottom.isin(*SUBSTANTIVE)
    return (
        F.when(t & b & (top == bottom), F.concat(top, F.lit("_both")))
        .when(t & b, F.concat_ws("_", top, bottom))
        .when(t, F.concat(top, F.lit("_top")))
        .when(b, F.concat(bottom, F.lit("_bottom")))
        .otherwise("no_change")
    )


def parallel_type(top: Column, bottom: Column) -> Column:
    def label(c: Column) -> Column:
        return F.when(c == "True", "parallel").when(c == "False", "nonparallel").when(c == "MIXED", "mixed")

    t, b = label(top), label(bottom)
    return (
        F.when(t == b, F.concat(t, F.lit("_both")))
        .when(t.isNotNull() & b.isNotNull(), F.concat_ws("_", t, b))
        .when(t.isNotNull(), F.concat(t, F.lit("_top")))
        .when(b.isNotNull(), F.concat(b, F.lit("_bottom")))
        .otherwise("none")
    )


def gene_pos_underscore(token: Column) -> tuple[Column, Column]:
    """``GENE_648`` split at the last underscore."""
    gene = F.nullif(F.regexp_extract(token, r"^(.*)_(\d+)$", 1), F.lit(""))
    pos = F.regexp_extract(token, r"^(.*)_(\d+)$", 2).try_cast("int")
    return gene, pos


def gene_pos_at(token: Column) -> tuple[Column, Column]:
    """``GENE@648``."""
    return F.split_part(token, F.lit("@"), F.lit(1)), F.split_part(token, F.lit("@"), F.lit(2)).try_cast("int")


def conserved_pair_ids(raw: Column) -> Column:
    """``2:1,3`` -> ``1,3``; a bare list passes through trimmed."""
    return F.trim(F.regexp_replace(raw, r"^\d+:", ""))


def normal_label(c: Column) -> Column:
    """Strip blanks and quotes, turn inner blanks into underscores."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.trim(c), "^['\"]+|['\"]+$", "")), " ", "_")


def safe_name(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "[^A-Za-z0-9_.-]+", "_")


def combo(flags: dict[str, Column]) -> Column:
    """Names of the true flags joined by ``+``; ``none`` when no flag is set."""
    text = F.concat_ws("+", *[F.when(c, F.lit(n)) for n, c in flags.items()])
    return F.when(text == "", "none").otherwise(text)


def codon_range(coord: Column) -> tuple[Column, Column, Column]:
    """Chromosome, start and end of ``chr17:g.10_12/...`` or ``chr17:g.10/...``; NULLs otherwise."""
    pattern = r"^(chr\w+):g\.(\d+)(?:_(\d+))?(?:[/\s]|$)"
    chrom, start, end = (F.nullif(F.regexp_extract(coord, pattern, i), F.lit("")) for i in (1, 2, 3))
    return chrom, start.cast("long"), F.coalesce(end, start).cast("long")


def protein_ref(coord: Column) -> Column:
    """Reference residue of ``/p.26E``; empty when absent."""
    return F.regexp_extract(coord, r"/p\.\d+([A-Z])", 1)


def chromosome_order(chrom: Column, other: int = 26) -> Column:
    """Numeric chromosomes first, then X, Y, M and the rest."""
    label = F.regexp_replace(chrom, "^chr", "")
    return (
        F.when(label.rlike(r"^\d+$"), label.try_cast("int"))
        .when(label == "X", 23).when(label == "Y", 24).when(label.isin("MT", "M"), 25).otherwise(other)
    )


def side_from_name(name: Column) -> Column:
    """``top`` / ``bottom`` token of a list name, else ``global``."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"_(top|bottom)(?:_|$)", 1), F.lit("")), F.lit("global"))


def transition_status(ancestor: Column, descendant: Column) -> Column:
    empty = ancestor.isNull() | (ancestor == "") | descendant.isNull() | (descendant == "")
    return F.when(empty, "unknown").when(ancestor == descendant, "maintained").otherwise("changed")


def transition_text(ancestor: Column, descendant: Column) -> Column:
    def shown(c: Column) -> Column:
        return F.coalesce(F.nullif(c, F.lit("")), F.lit("?"))

    return F.concat(shown(ancestor), F.lit("->"), shown(descendant), F.lit(" ("), transition_status(ancestor, descendant), F.lit(")"))


def row_mean(*cols: Column) -> Column:
    """Mean over the non-NULL arguments; NULL when all are NULL."""
    n = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    s = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    return F.when(n > 0, s / n)


def bounds_text(c: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", c)


def percent_text(c: Column, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", c * 100), F.lit("%"))
