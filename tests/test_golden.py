"""Hand-derived values of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from sitewise.functions import labels as L
from sitewise.functions import patterns as P
from sitewise.functions.pvalue import site_pvalue, symbol_counts
from sitewise.functions.schemes import PARTITIONS, RESIDUES, codes, encode
from sitewise.operators import scoring
from sitewise.operators.scan import fraction_limits, max_conserved_from_fraction


def one(spark, *cols):
    return spark.range(1).select(*cols).collect()[0]


def test_schemes_cover_every_residue_once():
    for scheme, part in PARTITIONS.items():
        assert sorted("".join(part.values())) == sorted(RESIDUES), scheme
        assert len(codes(scheme)) == 20


@pytest.mark.parametrize("fg,bg,tol,hit,pattern,overlap", [
    ("AA", "SS", 0, True, "1", 0), ("A", "S", 0, False, "1", 0), ("AAA", "ASS", 0, False, "2", 1),
    ("AAA", "ASS", 1, True, "2", 1), ("VM", "VVV", 1, False, "3", 1), ("AST", "VVV", 0, True, "3", 0),
    ("AS", "VM", 0, True, "4", 0), ("", "AA", 0, False, "null", 0),
])
def test_pattern_rules(spark, fg, bg, tol, hit, pattern, overlap):
    a, b = F.lit(fg), F.lit(bg)
    row = one(spark, P.diverges(a, b, tol), P.pattern_class(a, b), P.overlap(a, b), P.one_sided_hit(a, b, tol))
    if fg and bg:
        assert row[0] is hit
    assert row[1] == pattern and row[2] == overlap
    assert row[3] is (hit and pattern in "123")


def test_group_encoding_drops_unknown(spark):
    assert one(spark, encode(F.lit("AAGX-"), F.lit(codes("GS1"))))[0] == "nnn"
    assert one(spark, encode(F.lit("RHK"), F.lit(codes("GS1"))))[0] == "bbb"


@pytest.mark.parametrize("text,fg,bg,expected", [
    ("AAAABBBBBB", 2, 2, 1 / 7), ("AAABBBBCCC", 3, 3, 0.0357142857), ("AAABBBBCCC", 2, 3, 0.1547619048),
    ("AAAA", 2, 2, None), ("AABB", 0, 2, 1.0),
])
def test_site_pvalue(spark, text, fg, bg, expected):
    got = one(spark, site_pvalue(symbol_counts(F.lit(text)), F.lit(fg), F.lit(bg)))[0]
    assert got is None if expected is None else got == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("states,label", [
    ([], "no_change"), (["V"], "ambiguous"), (["V", "V"], "convergent"), (["V", "V", "I"], "codivergent"), (["V", "I"], "divergent")])
def test_change_class(spark, states, label):
    assert one(spark, L.change_class(F.array(*[F.lit(s) for s in states]).cast("array<string>")))[0] == label


@pytest.mark.parametrize("anc,label", [(["A", "A"], "True"), (["A", "T"], "False"), (["A", "A", "T"], "MIXED"), (["A"], None)])
def test_parallelism(spark, anc, label):
    assert one(spark, L.parallelism(F.array(*[F.lit(s) for s in anc])))[0] == label


def test_side_labels(spark):
    a, b = F.lit("convergent"), F.lit("divergent")
    assert list(one(spark, L.change_side(a, b), L.pattern_type(a, b))) == ["both", "convergent_divergent"]
    assert one(spark, L.parallel_type(F.lit("True"), F.lit(None)))[0] == "parallel_top"


def test_scores(spark):
    c = scoring.convergence_score(F.lit("convergent"), F.lit("no_change"))
    assert one(spark, c)[0] == 0.75
    asr = scoring.asr_score(F.lit("TRUE"), F.lit("yes"), F.lit("true"), F.lit("1"), [F.lit(1.0), F.lit(0.5)], F.lit(1.0))
    assert one(spark, asr)[0] == pytest.approx(0.5 + 0.45)


def test_fraction_rules():
    assert max_conserved_from_fraction(3, 0.5) == 1
    assert fraction_limits(5, gaps=0.5).fg_gaps == 2


def test_tokens(spark):
    g, p = L.gene_pos_underscore(F.lit("A_B_64"))
    assert list(one(spark, g, p)) == ["A_B", 64]
    c, a, b = L.codon_range(F.lit("chr17:g.7675087_7675089/c.5/p.26E"))
    assert list(one(spark, c, a, b, L.protein_ref(F.lit("chr17:g.1/c.5/p.26E")))) == ["chr17", 7675087, 7675089, "E"]
