import hashlib
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from helpers import DOCS, awkward, prose, table
from sitewise.llm import licenses as L
from sitewise.llm import mixing as M
from sitewise.llm import sketches as K

xxhash = pytest.importorskip("xxhash")


def duck(rows, sql):
    con = duckdb.connect()
    con.sql(f"CREATE TABLE documents ({DOCS.replace('string', 'VARCHAR').replace('long', 'BIGINT')})")
    for i, t, la, s in rows:
        con.execute("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [i, t, la, s, len(t) if t is not None else None])
    rel = con.sql(sql)
    return check.rows(rel.columns, rel.fetchall())


def spark_rows(df):
    return check.rows(df.columns, df.collect())


def mixed(df):
    return M.mix(df.select("doc_id", "source", M.words().alias("size"))).select("doc_id", "size", "source_size", "target", "taken")


def notices(rng):
    out = []
    for k, (t, _) in enumerate(L.TEMPLATES):
        words = t.split()
        out += [(200 + k, f"{prose(rng, 90)} {t.title()}. {prose(rng, 90)}", "en", "a"), (300 + k, prose(rng, 10) + "\n" + " ".join(w for i, w in enumerate(words) if i != 1), "en", "a"),
                (400 + k, " ".join(words[: len(words) // 2]), "en", "b")]
    return out + [(500, "CC-BY-NC cc by nc, CC BY NC", "en", "b"), (501, "under the MIT License under the mit license", "de", None), (502, "ÀPACHE apache license, version 2.0 ünder", "de", None)]


def test_mixing_as_the_oracle(spark):
    rows = [r for r in awkward() if r[0] != 8] + [(8, "same text", "en", "a")]
    got = mixed(table(spark, rows))
    assert spark_rows(got) == duck(rows, M.oracle())
    data = got.collect()
    assert all(r["taken"] <= 3 * r["size"] for r in data)
    assert abs(sum(r["taken"] for r in data) - sum(r["size"] for r in data)) <= 5
    assert sorted(map(tuple, mixed(table(spark, rows)).collect()), key=str) == sorted(map(tuple, data), key=str)


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "a"), (2, "", None, None)], [(k, "a b c d", "en", "one") for k in range(7)]])
def test_mixing_of_little(spark, rows):
    assert spark_rows(mixed(table(spark, rows))) == duck(rows, M.oracle())


def test_clamped_shares(spark):
    sources = spark.createDataFrame([("a", 5, 10), ("b", 2, 1000), ("c", 1, 90)], "name string, weight int, words long")
    got = {r["name"]: r["target"] for r in M.filled(sources).collect()}
    assert got["a"] == 30 and got["b"] + got["c"] == pytest.approx(1070) and got["c"] == 270


def test_repetitions_hold_the_words_taken(spark):
    rows = [(k, prose(random.Random(k), 5 + k % 9), "en", "ab"[k % 7 == 0]) for k in range(60)] + [(90, None, "en", "a")]
    df = table(spark, rows).withColumn("taken", F.lit("clash")).withColumn("size", M.words())
    m = M.mix(df)
    copies = M.repeated(m).groupBy("doc_id").agg(F.sum(M.words()).alias("n"), F.max((F.col("text").isNull()).cast("int")).alias("null"))
    want = {r["doc_id"]: r["taken"] for r in m.collect() if r["taken"]}
    assert {r["doc_id"]: r["n"] for r in copies.collect()} == want
    assert any(r["extra"] not in (0, r["size"]) for r in m.collect())


def test_licenses_as_the_oracle(spark):
    rng = random.Random(8)
    rows = awkward() + notices(rng)
    got = L.licenses(table(spark, rows).withColumn("n_words", F.lit(0)).withColumn("_row", F.lit(0)))
    assert spark_rows(got) == duck(rows, L.oracle())
    labels = {r["doc_id"]: r["labels"] for r in got.collect()}
    for k, (_, label) in enumerate(L.TEMPLATES):
        assert label in labels[200 + k].split(",")
    assert L.licenses(table(spark, [])).count() == 0


def test_filters_lose_no_block(spark):
    rng = random.Random(9)
    vocabulary = sorted({w for t, _ in L.TEMPLATES for w in t.split()}) + ["other", "words"]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 300))), "en", "a") for k in range(120)]
    assert spark_rows(L.licenses(table(spark, rows))) == duck(rows, L.oracle())


def sketch(text):
    w = [x.encode() for x in text.lower().split()]
    out = set()
    for i in range(max(1, len(w) - 4)) if w else []:
        h = 42
        for x in w[i : i + 5]:
            h = xxhash.xxh64_intdigest(x, h)
        h -= (1 << 64) if h >> 63 else 0
        if h < -(1 << 63) + (1 << 64) // K.ONE_IN:
            out.add(h)
    return out


def test_fingerprints_as_brute_force(spark):
    rows = [r for r in awkward() if r[0] is not None and r[0] != 8] + [(8, "same text here again and again", "en", "a"), (70_000, prose(random.Random(1), 90), "en", "a"), (-5, prose(random.Random(2), 90), "en", "a")]
    got = {r["doc_id"]: r for r in K.fingerprints(table(spark, rows)).collect()}
    rows.sort()
    texts = [t or "" for _, t, _, _ in rows]
    assert len(got) == len(rows)
    for k, (i, _, _, _) in enumerate(rows):
        t, after = texts[k], texts[(k + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c, r = sketch(t), sketch(edited), sketch(after), got[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == ",".join(f"{h & (1 << 64) - 1:016x}" for h in sorted(a))
        assert r["edited_fingerprint"] == ",".join(f"{h & (1 << 64) - 1:016x}" for h in sorted(b))
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else float(t == edited))
        assert r["near_next"] == pytest.approx(len(a & c) / len(a | c) if a | c else float(t == after))


def test_fingerprints_of_odd_rows(spark):
    rows = [(None, "a b c d e f g h", "en", "a"), (3, "same", "en", "a"), (3, "same", "en", "a"), (9, None, "en", "a")]
    got = K.fingerprints(table(spark, rows)).collect()
    assert len(got) == 4 and [r["near_next"] for r in got if r["doc_id"] is None] == [None]
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 3}) == 1
    assert K.fingerprints(table(spark, [])).count() == 0
    one = K.fingerprints(table(spark, [(1, "a b c d e f", "en", "a")])).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 11


def test_next_values_over_many_levels(spark):
    values = sorted(random.Random(4).sample(range(-(10**9), 10**12), 300)) + [10**15]
    got = dict(map(tuple, K.next_values(spark.createDataFrame([(v,) for v in values], "v long"), "v").collect()))
    assert got == dict(zip(values, [*values[1:], None]))


def test_merged_sketch_is_the_union(spark):
    df = spark.createDataFrame([(prose(random.Random(1), 80), prose(random.Random(2), 80))], "a string, b string")
    row = df.select(K.sketch(F.col("a")).alias("a"), K.sketch(F.col("b")).alias("b")).select("a", "b", K.merged(F.array("a", "b")).alias("m"), K.containment(F.col("a"), K.merged(F.array("a", "b"))).alias("c")).first()
    assert row["m"] == sorted({*row["a"], *row["b"]}) and row["c"] == 1.0


def test_main_paths_hold_no_python(spark):
    docs = table(spark, awkward())
    for df in (mixed(docs), L.licenses(docs), K.fingerprints(docs)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert Path(M.__file__).read_text().count("udf") == 0
