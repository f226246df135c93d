"""Coordinates of all genes against plain loops over bases and codons."""

import random

from sitewise.operators import coordinates as C


def test_codon_places_against_bases(spark, monkeypatch):
    monkeypatch.setattr(C, "BIN", 7)
    rng = random.Random(2)
    exons, want, asked = [], {}, []
    for p in range(30):
        at, strand, parts = 100, rng.choice("+-"), []
        for k in range(rng.randint(1, 9)):
            size = rng.choice([1, 1, 2, 3, 4, 20])
            parts.append((at, at + size - 1))
            at += size + rng.randint(1, 9)
            exons.append((k, f"chr1\ts\tCDS\t{parts[-1][0]}\t{parts[-1][1]}\t.\t{strand}\t0\tID=c;protein_id=p{p};v=1"))
        bases = [b for a, e in parts for b in range(a, e + 1)]
        bases = bases[::-1] if strand == "-" else bases
        for r in range(0, len(bases) // 3 + 3):
            asked.append((f"p{p}", r))
            codon = bases[3 * (r - 1) : 3 * r] if r else []
            if codon:
                n = sum(any(a <= b <= e for b in codon) for a, e in parts)
                want[f"p{p}", r] = ("chr1", strand, min(codon), max(codon), n, len(codon))
    odd = [(0, "# CDS"), (1, "chr1\ts\tCDS\tx\t9\t.\t+\t0\tprotein_id=p0"), (2, "chr1\ts\tCDS\t1\t9\t.\t+\t0\tname=p0"), (3, "short"), (4, "chr1\ts\texon\t1\t9\t.\t+\t0\tprotein_id=p0"), (5, None)]
    lines = spark.createDataFrame(exons + odd, "line_no long, line string")
    got = C.codon_places(spark.createDataFrame(asked + [("none", 1), (None, 1), ("p0", None)], "protein string, residue long"), C.exon_offsets(C.coding_exons(lines)))
    assert {(r.protein, r.residue): (r.chrom, r.strand, r.start, r.end, r.parts, r.bases) for r in got.collect()} == want


def residues(seq, n_codons):
    """Codon by codon, as a reader of both sequences meets them."""
    out, at, k = {}, 0, 0
    codons = [seq[i : i + 3] for i in range(0, len(seq), 3)]
    for _ in range(n_codons):
        while at < len(codons):
            at += 1
            if not codons[at - 1].startswith("-") and "N" not in codons[at - 1].upper():
                k += 1
                break
            out.pop(at, None)
        if k:
            out[at] = k
    return out


def test_residues_and_positions(spark):
    rng = random.Random(3)
    rows = [(f"g{k}", "".join(rng.choice(["---", "ATG", "CCC", "AnG", "A-T"]) for _ in range(rng.randint(0, 12))) + rng.choice(["", "A"]), rng.randint(0, 12)) for k in range(80)] + [("null", None, 3)]
    df = C.codon_residues(spark.createDataFrame(rows, "gene string, seq string, n_codons long"))
    got = {}
    for r in df.collect():
        got.setdefault(r.gene, {})[r.codon] = r.residue
    assert got == {g: w for g, s, n in rows if s and (w := residues(s, n))}
    lines = spark.createDataFrame([("g1", "a b selected: 2-4 9 x 7-5 1-1"), ("g1", "removed: 1"), ("g2", "selected:"), ("g3", None)], "gene string, line string")
    assert sorted(tuple(r) for r in C.tracked(lines).collect()) == [("g1", 0, 2, 2), ("g1", 3, 3, 9), ("g1", 4, 4, 1)]
    sites = spark.createDataFrame([("g1", p) for p in range(7)] + [("g1", None), ("g9", 0)], "gene string, position int")
    back = {r.position: (r.codon, r.residue, r.query) for r in C.protein_positions(sites, C.tracked(lines), spark.createDataFrame([("g1", c, c - 1) for c in (2, 3, 9)], "gene string, codon long, residue long")).collect()}
    assert back == {0: (2, 1, "g1:p.1"), 1: (3, 2, "g1:p.2"), 3: (9, 8, "g1:p.8")}
