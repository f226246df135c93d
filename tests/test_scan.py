"""Scan and bootstrap against a per-column brute force written from the rules."""

import random
from itertools import product
from math import comb

import pytest
from pyspark.sql import functions as F

from sitewise.functions.schemes import PARTITIONS
from sitewise.operators import scan as S
from sitewise.operators.columns import SpeciesIndex, column_filter, columns_from_cells, columns_from_sequences

SPECIES = [f"s{i:02d}" for i in range(12)]
CONFIG = [("t", f"s{i:02d}", i % 2, str(i // 2 + 1)) for i in range(8)] + [("t", "absent", 1, "9")]


def alignment(seed, genes=4, width=70):
    rnd = random.Random(seed)
    rows = []
    for g in range(genes):
        base = [rnd.choice("ACDEGKLV") for _ in range(width)]
        for i, sp in enumerate(SPECIES):
            if rnd.random() < 0.1:
                continue
            seq = []
            for b in base:
                x = rnd.random()
                seq.append("-" if x < 0.05 else "X" if x < 0.08 else rnd.choice("ASTVW") if x < 0.2 else ("R" if i in (1, 3, 5, 7) and ord(b) % 2 else b))
            rows.append((f"g{g}", sp, "".join(seq)))
    return rows


def sides(col, fg_names, bg_names):
    def read(names):
        seen = [(n, col[n]) for n in names if n in col]
        return [(n, r) for n, r in seen if r not in "-XBZJU"], sum(r in "-XBZJU" for _, r in seen), sum(n not in col for n in names), [r for _, r in seen if r != "-"]

    return read(fg_names), read(bg_names)


def test_hit(fg=None, bg=None, tol=0):
    if not fg or not bg:
        return False, "null"
    nf, nb = sum(x not in bg for x in fg), sum(x not in fg for x in bg)
    over = min(len(fg) - nf, len(bg) - nb)
    pat = "1" if len(set(fg)) == len(set(bg)) == 1 else "2" if len(set(fg)) == 1 else "3" if len(set(bg)) == 1 else "4"
    return over <= tol and (nf >= 2 or nb >= 2) and pat in "123", pat


hit_of = test_hit
test_hit.__test__ = False


def pvalue(symbols, f, b):
    if f <= 0 or b <= 0:
        return 1.0
    freq = {s: symbols.count(s) for s in set(symbols)}
    m = len(symbols)

    def pair(x, y):
        return comb(x, f) / comb(m, f) * comb(y, b) / comb(m - f, b)

    p = sum(pair(n, m - n) for n in freq.values())
    if f != b:
        p += sum(pair(m - n, n) for n in freq.values())
        if len(freq) > 2:
            p -= sum(pair(freq[x], freq[y]) for x, y in product(freq, freq) if x != y)
    return p


def code_of(scheme):
    return {aa: c for c, members in PARTITIONS[scheme].items() for aa in members}


def brute(rows, tol=0):
    out = {}
    fg_names = [s for _, s, g, _ in CONFIG if g == 1]
    bg_names = [s for _, s, g, _ in CONFIG if g == 0]
    for gene in {r[0] for r in rows}:
        seqs = {sp: seq for g, sp, seq in rows if g == gene}
        for pos in range(len(next(iter(seqs.values())))):
            col = {sp: s[pos] for sp, s in seqs.items()}
            res = [r for r in col.values() if r != "-"]
            if (len(col) - len(res)) / len(col) > 0.5 or not res or len(res) - max(res.count(x) for x in set(res)) < 1:
                continue
            (fg, gf, mf, sf), (bg, gb, mb, sb) = sides(col, fg_names, bg_names)
            if not sf or not sb or not fg or not bg:
                continue
            for scheme in PARTITIONS:
                code = code_of(scheme)
                f, b = [code[r] for _, r in fg if r in code], [code[r] for _, r in bg if r in code]
                ok, pat = hit_of(f, b, tol)
                if ok:
                    drop = [i for i in range(min(len(fg), len(bg))) if tol and code.get(fg[i][1], fg[i][1]) == code.get(bg[i][1], bg[i][1])]
                    gone = {fg[i][0] for i in drop} | {bg[i][0] for i in drop}
                    pop = [code.get(r, r) for n, r in col.items() if r != "-" and n not in gone]
                    out[gene, pos, scheme] = (pat, round(pvalue(pop, len(fg) - len(drop), len(bg) - len(drop)), 9), gf, gb, mf, mb,
                                              ",".join(n for n, _ in fg), "".join(r for _, r in fg) + "/" + "".join(r for _, r in bg))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = alignment(3)
    seqs = spark.createDataFrame(rows, "gene string, species string, seq string")
    cfg = spark.createDataFrame(CONFIG, "trait string, species string, grp int, pair string")
    index = SpeciesIndex(SPECIES + ["absent"])
    return rows, seqs, cfg, index


def test_block_and_cell_layouts_agree(spark, data):
    rows, seqs, _, index = data
    blocks = columns_from_sequences(seqs, index, block=16)
    cells = seqs.select("gene", "species", F.posexplode(F.filter(F.split("seq", ""), lambda x: x != ""))).select(
        "gene", F.col("pos").alias("position"), "species", F.col("col").alias("residue"))
    a, b = (sorted(map(tuple, d.select("gene", "position", "syms", "residues").collect())) for d in (blocks, columns_from_cells(cells, index)))
    assert a == b and len(a) == 4 * 70


@pytest.mark.parametrize("tol", [0, 1])
def test_discovery_matches_brute_force(data, tol):
    rows, seqs, cfg, index = data
    got = S.scan(columns_from_sequences(seqs, index, block=32), cfg, index, max_conserved=tol).collect()
    found = {(r["Gene"], r["Position"], r["CAAP_Group"]): (r["Pattern"], round(r["Pvalue"], 9), r["GFG"], r["GBG"], r["MFG"], r["MBG"], r["FFG"], r["Substitution"]) for r in got}
    want = brute(rows, tol)
    assert len(want) > 20
    assert found == want


def test_caas_mode_is_the_identity_scheme(data):
    _, seqs, cfg, index = data
    cols = column_filter(columns_from_sequences(seqs, index))
    tested = S.tested_columns(cols, S.load_contrasts(cfg), index, S.Limits())
    a = {(r["Gene"], r["Position"]) for r in S.discover(tested, mode="CAAS").collect()}
    b = {(r["Gene"], r["Position"]) for r in S.discover(tested, schemes=["US"]).collect()}
    assert a == b and a


@pytest.mark.parametrize("tol,limits", [(0, S.Limits()), (1, S.Limits(fg_gaps=0, all_miss=1))])
def test_bootstrap_matches_brute_force(spark, data, tol, limits):
    rows, seqs, cfg, index = data
    rnd = random.Random(5)
    sets = [(f"b_{i}", sorted(x[:4]), sorted(x[4:8])) for i in range(40) for x in [rnd.sample(SPECIES, 8)]]
    res = spark.createDataFrame(sets, "cycle string, fg array<string>, bg array<string>")
    cols = column_filter(columns_from_sequences(seqs, index))
    disc = S.scan(cols, cfg, index)
    got = {(r["Gene"], r["Position"], r["CAAP_Group"]): r["Occurrences"] for r in S.bootstrap(cols, disc, res, index, limits, tol).collect()}
    want = {}
    for gene, pos, scheme in brute(rows):
        col = {sp: s[pos] for g, sp, s in rows if g == gene}
        code, n = code_of(scheme), 0
        for _, f_names, b_names in sets:
            (fg, gf, mf, _), (bg, gb, mb, _) = sides(col, f_names, b_names)
            if (limits.fg_gaps is not None and gf > limits.fg_gaps) or (limits.all_miss is not None and mf + mb > limits.all_miss):
                continue
            n += hit_of([code[r] for _, r in fg if r in code], [code[r] for _, r in bg if r in code], tol)[0]
        want[gene, pos, scheme] = n
    assert got == want and sum(want.values()) > 0
    hits = S.bootstrap_hits(cols, disc, res, index, limits, tol)
    assert hits.count() == sum(want.values())


def test_pair_aware_rule(spark):
    rows = [("g", "a", "A-"), ("g", "b", "AA"), ("g", "c", "S-"), ("g", "d", "SS"), ("g", "e", "AS")]
    seqs = spark.createDataFrame(rows, "gene string, species string, seq string")
    index = SpeciesIndex("abcde")
    for pairs, kept in (({"a": 1, "b": 2, "c": 1, "d": 2}, {0, 1}), ({"a": 1, "b": 2, "c": 2, "d": 1}, {0})):
        cfg = spark.createDataFrame([("t", s, int(s in "ab"), str(p)) for s, p in pairs.items()], "trait string, species string, grp int, pair string")
        lim = S.Limits(all_gaps=2, pair_aware=True)
        got = S.tested_columns(columns_from_sequences(seqs, index), S.load_contrasts(cfg), index, lim)
        assert {r["position"] for r in got.collect()} == kept


def test_unknown_config_species_raises(spark, data):
    _, seqs, cfg, _ = data
    with pytest.raises(ValueError, match="absent"):
        S.scan(columns_from_sequences(seqs, SpeciesIndex(SPECIES)), cfg, SpeciesIndex(SPECIES))
