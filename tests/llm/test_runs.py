import hashlib
import random
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import awkward, table
from sitewise.llm import runs as R


def brute(w, least=6, exponent=4):
    """Every (start, length, period) by comparing words p apart for each p."""
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                out.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def sample(rng):
    kind, n = rng.randrange(6), rng.randrange(0, 60)
    letters = "ab" if kind < 2 else "abcdefgh"
    w = [rng.choice(letters) for _ in range(n)]
    if kind == 3:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 5))]
        w = w[:7] + (unit * rng.randint(2, 12))[: rng.randint(4, 40)] + w[7:20]
    if kind == 4:  # runs inside runs, and periods that are no smallest ones
        unit = ["a"] * rng.randint(3, 8) + ["b"]
        w = unit * rng.randint(1, 7) + w[:3]
    if kind == 5:
        x, y = ["a"], ["a", "b"]
        for _ in range(6):
            x, y = y, y + x
        w = y
    return w


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (3, 1)])
def test_runs_against_brute_force(exponent, least, monkeypatch):
    rng = random.Random(exponent)
    texts = [sample(rng) for _ in range(400)]
    for children in (R.CHILDREN, 7):
        monkeypatch.setattr(R, "CHILDREN", children)
        got = list(R.found_in([[x.encode() for x in w] for w in texts], least, exponent))
        for w, g in zip(texts, got):
            assert g == brute(w, least, exponent), w


def test_long_runs():
    for w in (["a"] * 3000, ["a", "b", "c"] * 1500 + ["d"] + ["c", "b"] * 40, [str(i % 997) for i in range(5000)]):
        assert list(R.found_in([[x.encode() for x in w]], 6, 4)) == [brute(w)]


def expected(doc_id, text):
    """op11's row by the contract, word by word."""
    w = (text or "").encode().split()
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute(w)
    dropped = {i for s, k, p in found for i in range(s + p, s + k)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], sha("".join(f"{s},{k},{p}\n" for s, k, p in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_query_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, t, s, la) for i, t, s, la in awkward() if not t or len(t) < 40_000]
    rows += [(1000 + k, rng.choice([" ", "\n", "\t \x0b"]).join(sample(rng)), None, "x") for k in range(300)]
    rows += [(1400, "ok " * 500, "en", "x"), (1401, "a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb", "en", "x"), (1402, "é é " * 9, "en", "x"), (1400, "ok " * 500, "en", "x")]
    docs = table(spark, rows).withColumn("runs", F.lit(1)).withColumn("h", F.lit("clash")).withColumn("w", F.lit("clash"))
    got = sorted((tuple(r) for r in R.digest(R.with_repeats(docs)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t, _, _ in rows), key=str)


def test_find_and_collapse_keep_other_columns(spark):
    rows = [(1, "a b a b a b a b a b end", "en", "s"), (2, "  no runs\n here ", None, None), (3, None, "en", "s"), (4, "", "en", "s")]
    docs = table(spark, rows).withColumn("runs", F.lit("clash")).withColumn("_collapsed_text", F.lit("keep"))
    found = R.find_runs(docs)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "_collapsed_text", "runs"]
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in found.collect()} == {1: [(0, 10, 2)], 2: [], 3: [], 4: []}
    out = R.collapse(docs)
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect()} == {1: "a b end", 2: "  no runs\n here ", 3: None, 4: ""}
    assert R.digest(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        R.find_runs(docs, least_exponent=1)


def test_long_texts_are_sorted_apart(monkeypatch):
    monkeypatch.setattr(R, "BATCH", 10)
    parts = list(R.batches(["a b c", None, "x " * 50, "d", "e f g h i j"]))
    assert [(first, [len(w) for w in part]) for first, part in parts] == [(0, [3, 0]), (2, [50]), (3, [1, 6])]
    assert pa.types.is_int64(R.DIGESTS["n_runs"])
