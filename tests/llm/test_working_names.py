"""Columns of the input that are named like an operator's own working columns stay as they are."""

import random

from pyspark.sql import functions as F

from helpers import prose, table
from sitewise.llm import mixing, simhash, toxicity
from sitewise.llm.common import Recent, hand_back, resident, shielded

import corpus_pipeline


def documents(spark, n=30):
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randint(20, 60)), "en", "ab"[k % 2]) for k in range(n)]
    return table(spark, [*rows, (n, rows[3][1], "en", "a"), (None, rows[4][1], None, None)])


def clashing(df, names):
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")) for c in names})


def kept(out, names):
    for r in out.collect():
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}:{r['doc_id']}") for c in names)


def test_near_copies(spark):
    names = ["_h", "_none", "_first", "_f", "h", "component", "_H_"]
    docs = documents(spark)
    out = simhash.keep_one_copy(clashing(docs, names))
    assert out.columns == docs.columns + names
    kept(out, names)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in simhash.keep_one_copy(docs).collect())


def test_mixing(spark):
    names = ["_bucket", "_salt", "_hash", "_point", "_edge", "_left", "_run", "_name", "_copy", "_source", "before"]
    docs = documents(spark).withColumn("_size", mixing.words())
    plain = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, size="_size").collect()}
    out = mixing.mix(clashing(docs, names), size="_size")
    assert {r["doc_id"]: r["taken"] for r in out.collect()} == plain
    kept(out, names)
    kept(mixing.repeated(out, size="_size"), names)


def test_pipeline_stages(spark):
    names = ["_given", "_l", "lang_pred", "score", "_words", "target", "whole", "extra", "taken", "source_size", "_h", "_bucket"]
    docs = clashing(documents(spark), names)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        kept(out, names)


def test_shielded_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_A int, _a_ int, b int")
    out, moved, back = shielded(df, ["_a"])
    assert out.columns == ["_A__", "_a_", "b"] and moved == {"_A": "_A__"} and back(out).columns == df.columns


def test_a_worker_holds_one_model():
    one = resident(("one",), lambda: Recent(str, 2))
    assert resident(("one",), lambda: None) is one and resident(("two",), lambda: "two") == "two"
    hand_back()
    assert resident(("one",), lambda: None) is None


def test_letters_beyond_latin():
    lexicon = toxicity.Lexicon(frozenset(), frozenset())
    at = {n: k for k, n in enumerate(toxicity.NAMES)}

    def values(text):
        f = toxicity.features(text, lexicon)
        return f[7], f[10], f[11]

    share, questions, marks = values("ПРИВЕТ мирный")
    assert share == 0.5 and questions == 0 and marks == 0
    share, questions, marks = values("ΑΒΓ αβγ? “quoted” — ŁÓDŹ łódź")
    assert share == 7 / 20 and questions == 1 / 5 and marks == 1 / 5
    assert values("日本語 テスト")[0] == 0 and len(at) == len(toxicity.NAMES)
    assert values("Größe ÄÖ")[0] == 3 / 7
