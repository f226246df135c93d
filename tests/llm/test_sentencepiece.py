import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import awkward, table
from sitewise.llm import sentencepiece as S

public = pytest.importorskip("public_tokenizers")
library = pytest.importorskip("sentencepiece")
PATH = public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as f:
        return S.Model(f.read()), library.SentencePieceProcessor(model_file=PATH)


def test_random_texts_as_the_library(both):
    own, lib = both
    rng = random.Random(5)
    parts = ["a", "b", "th", "er", " ", "  ", "\n", "▁", "<s>", "<0x0A>", "é", "日", "😀", "\t", "0", "12", "'", "ing", "́", "​", "A", "\0", "ﬁ", "</s>"]
    for _ in range(1500):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))
        ids = lib.encode(t)
        assert own.encode(t) == ids
        assert own.decode(ids) == lib.decode(ids)


def test_random_ids_as_the_library(both):
    own, lib = both
    rng = random.Random(6)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, 3, 29871, 13, 200, 243, 162, 131, rng.randrange(32000)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == lib.decode(ids)


@pytest.mark.parametrize("text", ["ab" * 30_000, "aGVsbG8Kd29ybGQ" * 3000, "日本語" * 2000, " " * 500 + "x", "é" * 70, "a" * 64, "a" * 65])
def test_long_runs(both, text):
    own, lib = both
    assert own.encode(text) == lib.encode(text)


def test_short_and_long_ways_agree(both):
    own, _ = both
    rng = random.Random(7)
    for _ in range(300):
        part = "▁" + "".join(rng.choice("etaoinshr日é😀1") for _ in range(rng.randint(1, 40)))
        assert own._side_by_side([part]) == [own._long(part)]


def test_memo_is_bounded(both, monkeypatch):
    own, lib = both
    monkeypatch.setattr(S, "KEEP", 50)
    for k in range(40):
        t = " ".join(f"w{k}x{i}" for i in range(20))
        assert own.encode(t) == lib.encode(t)
    assert len(own.memo[0]) + len(own.memo[1]) <= 4 * 50


def test_rows(spark, both):
    _, lib = both
    rows = awkward()
    df = table(spark, rows).withColumn("ids", F.lit("clash"))
    out = S.digest(S.encode(df, PATH), PATH)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect())
    want = []
    for i, t, _, _ in rows:
        ids = lib.encode(t or "")
        want.append((i or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)


def test_empty_table(spark):
    assert S.digest(table(spark, []), PATH).count() == 0
    assert S.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH).select("decoded").collect() == [("",), ("",)]
