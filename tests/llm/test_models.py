import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, prose, table
from sitewise.llm import language as G
from sitewise.llm import quality as Q
from sitewise.llm import secrets as S
from sitewise.llm import toxicity as T
from sitewise.llm.common import Recent, held_out

TONGUES = {"en": ("the", "ing", "tion", "sh", "wh"), "de": ("der", "sch", "ung", "keit", "zu"), "fr": ("eau", "que", "oi", "ment", "le")}


def tongues(n, seed=1, first=1000):
    rng = random.Random(seed)
    return [(first + k, prose(rng, rng.randint(3, 60), TONGUES[la]), la, "s") for k, la in zip(range(n), itertools.cycle(TONGUES))]


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, label int")


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    emission, transition = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    begin, length = np.array([0, 4]), np.array([4, 3])
    marginal, pairs, index = G.forward_backward(emission, begin, length, transition)
    want, together = np.zeros((7, 3)), np.zeros((3, 3))
    for b, n in zip(begin, length):
        total, m, t = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.exp(sum(emission[b + k, y] for k, y in enumerate(path)) + sum(transition[x, y] for x, y in zip(path, path[1:])))
            total += p
            for k, y in enumerate(path):
                m[k, y] += p
            for x, y in zip(path, path[1:]):
                t[x, y] += p
        want[b : b + n], together = m / total, together + t / total
    assert np.allclose(marginal[index >= 0], want) and np.allclose(pairs, together)


def test_code_switched_words():
    field = G.fit([t for _, t, _, _ in tongues(300)], [la for _, _, la, _ in tongues(300)])
    rng = random.Random(7)
    words = [w for la in ("en", "fr", "de") for w in prose(rng, 15, TONGUES[la]).split()]
    emission = field.emissions(words)
    marginal, _, _ = G.forward_backward(emission, np.array([0]), np.array([len(words)]), field.transition)
    found = [field.languages[k] for k in marginal[0].argmax(1)]
    assert sum(a == b for a, b in zip(found, ["en"] * 15 + ["fr"] * 15 + ["de"] * 15)) >= 42


def test_languages_of_rows(spark):
    docs = table(spark, awkward() + tongues(240)).withColumn("score", F.lit("clash"))
    model = G.train(docs.where(~held_out("doc_id", 3, 1)))
    got = G.predict(docs, model).select("doc_id", "text", "lang", "lang_pred", F.col("score").alias("s")).collect()
    assert len(got) == 240 + len(awkward())
    for r in got:
        assert 0 <= r["s"] <= 1
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or "")))
    apart = [r for r in got if (r["doc_id"] or 0) >= 1000]
    assert sum(r["lang"] == r["lang_pred"] for r in apart) >= 0.97 * len(apart)


def test_language_without_labels(spark):
    docs = table(spark, [(1, "some words", None, "a"), (2, None, None, "a")])
    assert G.train(docs) is None
    assert {(r["lang_pred"], r["score"]) for r in G.predict(docs, None).collect()} == {("und", 0.0)}
    assert G.predict(table(spark, []), None).count() == 0
    model = G.train(table(spark, tongues(30)))
    assert G.predict(table(spark, []), model).count() == 0


def test_long_texts_and_small_memo(monkeypatch):
    field = G.fit([t for _, t, _, _ in tongues(60)], [la for _, _, la, _ in tongues(60)])
    lists = [t.split() for _, t, _, _ in tongues(60, seed=3)] + [prose(random.Random(1), 5000).split(), []]
    want = field.label(lists)
    monkeypatch.setattr(G, "KEEP", 100)
    small = G.Field.load(field.dump())
    assert np.allclose(small.label(lists), want, atol=1e-4)
    assert np.allclose(np.concatenate([small.label([x]) for x in lists]), want, atol=1e-4)


def junk(rng, n):
    return " ".join(f"{w}%%%" if rng.random() < 0.7 else f"{w}***" for w in prose(rng, n).split())


def test_quality(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, 60) if k % 3 else junk(rng, 60), "en", "a") for k in range(300)]
    marks = labels(spark, [(k, int(k % 3 > 0)) for k in range(0, 300)] + [(5, None), (None, 1)])
    docs = table(spark, rows + [(1000 + i, t, la, s) for i, (_, t, la, s) in enumerate(awkward())]).withColumn("score", F.lit("clash"))
    model = Q.train(docs, marks.where("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r["score"] for r in Q.score(docs, model).collect()}
    assert len(got) == 300 + len(awkward()) and all(0 <= s <= 1 for s in got.values())
    apart = [k for k in range(0, 300, 5)]
    assert sum((got[k] >= 0.3) == bool(k % 3) for k in apart) >= 0.95 * len(apart)
    assert got[1000] == got[1001] == got[1002]
    assert Q.train(docs, marks.where("false")) is None
    assert {r["score"] for r in Q.score(docs, None).collect()} == {0.5}
    assert Q.score(docs.where("false"), model).count() == 0


def test_slices_count_every_ngram_once(monkeypatch):
    text = prose(random.Random(3), 700) + " !! a a a"
    want = Q.Hasher().counts(text)
    monkeypatch.setattr(Q, "SLICE", 64)
    got = Q.Hasher().counts(text)
    assert np.array_equal(got[0], want[0]) and np.allclose(got[1], want[1])


def test_toxicity(spark):
    rng = random.Random(4)

    def insult(n):
        w = prose(rng, n).split()
        for _ in range(4):
            w.insert(rng.randrange(len(w)), rng.choice(["blockhead", "numbskull", "nitwit"]))
        return " ".join(w)

    rows = [(k, insult(50) if k % 4 == 0 else prose(rng, 50), "en", "a") for k in range(320)]
    docs = table(spark, rows + [(1000 + i, t, la, s) for i, (_, t, la, s) in enumerate(awkward())]).withColumn("score", F.lit("clash"))
    marks = labels(spark, [(k, int(k % 4 == 0)) for k in range(320)] + [(1, None), (None, 0)])
    got = {r["doc_id"]: r["score"] for r in T.scores(docs, marks.where("doc_id % 5 <> 0"), marks.columns[1]).collect()}
    assert len(got) == 320 + len(awkward()) and all(0 <= s <= 1 for s in got.values())
    apart = list(range(0, 320, 5))
    assert sum((got[k] >= 0.5) == (k % 4 == 0) for k in apart) >= 0.93 * len(apart)
    assert all(got[1000 + i] < 0.5 for i in range(len(awkward())))


def test_toxicity_of_one_class(spark):
    docs = table(spark, awkward())
    assert {r["score"] for r in T.scores(docs, labels(spark, []), "label").collect()} == {0.5}
    assert {r["score"] for r in T.scores(docs, labels(spark, [(6, 0), (7, 0)]), "label").collect()} == {0.0}
    assert T.scores(table(spark, []), labels(spark, []), "label").count() == 0


def test_toxic_features_read_signs():
    lexicon = T.Lexicon(frozenset({"idiot", "achl-"}), frozenset())
    f = dict(zip(T.NAMES, T.features("YOU 1D10T! i*d*i*o*t, you achlich", lexicon), strict=True))
    assert f["strong"] == 1 and f["hidden"] == 1 and f["near_you"] == 1 and f["exclaims"] > 0
    assert T.features("you stupid id1ot", lexicon)[T.NAMES.index("hidden")] == 1
    assert T.features(None, lexicon) == T.features("", lexicon) == [0.0] * len(T.NAMES)


def hidden_keys(n):
    rng = random.Random(6)
    rows, keys = [], {}
    for k in range(n):
        t = prose(rng, 30) + " " + "".join(rng.choice(["the", "ing", "shon", "eat"]) for _ in range(7)) + " " + prose(rng, 5)
        if k % 2:
            keys[k] = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            t += f' token = "{keys[k]}" ' + prose(rng, 10)
        rows.append((k, t, "en", "a"))
    return rows, keys


def test_secrets(spark):
    rows, keys = hidden_keys(120)
    more = [(1000 + i, t, la, s) for i, (_, t, la, s) in enumerate(awkward())] + [(2000, "seen deadbeef0123456789abcdef9876543210fedcba here", "en", "a"), (2001, "see https://example.com/some/path/index.html now", "en", "a")]
    docs = table(spark, rows + more).withColumn("start", F.lit("clash"))
    model = S.train(docs)
    found = S.scan(docs.select("doc_id", "text", "start"), model).where("secret").collect()
    assert sorted(r["doc_id"] for r in found if r["doc_id"] < 1000) == sorted(keys)
    assert {r["doc_id"] for r in found if r["doc_id"] >= 1000} <= {2000}
    texts = {i: t for i, t, _, _ in rows}
    for r in found:
        if r["doc_id"] in keys:
            assert texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == keys[r["doc_id"]]
    clean = {r["doc_id"]: r["text"] for r in S.redact(docs, model).collect()}
    for k, key in keys.items():
        assert clean[k] == texts[k].replace(key, S.MASK)
    assert clean[1000] is None and clean[0] == texts[0] and len(clean) == len(rows) + len(more)


def test_secrets_without_findings(spark):
    docs = table(spark, [(1, "few words", "en", "a"), (2, None, "en", "a")])
    model = S.train(docs)
    assert model[1] is None and S.scan(docs, model).count() == 0
    assert [r["text"] for r in S.redact(docs, model).orderBy("doc_id").collect()] == ["few words", None]
    assert S.scan(table(spark, []), S.train(table(spark, []))).count() == 0


def test_forest_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((2000, len(S.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(np.int64)
    forest = S.fit(x[:1500], y[:1500])
    assert ((forest.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.85


def test_memo_keeps_two_generations():
    made = []
    memo = Recent(lambda k: made.append(k) or k * 2, 3)
    assert [memo[k] for k in (1, 2, 3, 1, 4, 1)] == [2, 4, 6, 2, 8, 2]
    assert made == [1, 2, 3, 4] and len(memo.new) + len(memo.old) <= 6


@pytest.mark.parametrize("modulus,remainder", [(5, 0), (3, 1)])
def test_held_out(spark, modulus, remainder):
    import zlib

    got = {r["id"]: r["h"] for r in spark.range(50).select("id", held_out("id", modulus, remainder).alias("h")).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % modulus == remainder for k in range(50)}
