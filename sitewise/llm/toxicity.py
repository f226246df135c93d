"""Toxicity by gradient-boosted trees over a few dense features, calibrated by isotonic regression.

The lexicons are learned: words and word beginnings whose presence in labelled texts speaks for
toxicity, strongly or somewhat.  A text's features are their densities, how near they stand to a second person,
capitals, punctuation, and words that mix letters with digits or signs, as such and where
reading the signs as letters gives a word of the lexicon.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import sampled
from sitewise.session import checkpoint

#: The bound of the training sample; lexicon sizes and least numbers of texts; the trees; words that count as near.
DOCUMENTS, STRONG, SOME, LEAST, TREES, DEPTH, NEAR, KEEP = 12_000, 200, 400, 4, 15, 3, 5, 200_000
#: Lengths of the word beginnings, which are lexicon entries with a dash.
STEMS = (4, 5, 6, 7, 8)
NAMES = ["strong", "strong_words", "strong_share", "some", "some_words", "near_you", "you", "capitals", "shouted", "exclaims", "questions", "marks", "mixed", "hidden", "digits", "length"]
#: Second persons of the languages at hand, and signs that stand for letters.
SECOND = frozenset("you your yours yourself du dich dir dein deine ihr euch tu toi te ton ta tes vous votre vos usted ustedes tú ti tus vosotros".split())
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "*": ""})
STRONGLY, SOMEWHAT, PERSON = 1, 2, 4
_WORD = re.compile(r"[^\W_]+")
_BEYOND = re.compile(r"[^\x00-\x7f]+")
_SIGN = re.compile(r"[0-9@$*](?=[^\W\d_])")
_MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$*]+[^\W\d_]+)+")


def lexicons(rows: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Strong and some words of a bounded sample with ``text`` and ``_label``, by smoothed log-odds of the texts that hold them."""
    n = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return frozenset(), frozenset()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0)))
    stems = F.flatten(F.transform(words, lambda w: F.array_distinct(F.array(w, *[F.when(F.length(w) > k, F.concat(F.left(w, F.lit(k)), F.lit("-"))) for k in STEMS]))))
    held = rows.select("_label", F.explode(F.array_distinct(F.array_compact(stems))).alias("word")).groupBy("word")
    held = held.agg(F.sum("_label").alias("a"), F.sum(1 - F.col("_label")).alias("b")).where(F.col("a") >= LEAST)
    odds = F.log((F.col("a") + 0.5) / (bad + 1)) - F.log((F.col("b") + 0.5) / (good + 1))
    sure = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    top = held.select("word", odds.alias("o"), sure.alias("z")).where("o > 1 AND z > 2.5").orderBy(F.desc("z"), "word").limit(STRONG + SOME).collect()
    strong = [r["word"] for r in top if r["o"] > 3][:STRONG]
    return frozenset(strong), frozenset(r["word"] for r in top) - frozenset(strong)


class Lexicon:
    """Kinds of words by the word or its beginnings, with a bounded memo."""

    def __init__(self, strong: frozenset[str], some: frozenset[str]):
        self.strong, self.some = strong, some
        self.known: dict[str, int] = {}

    def kind(self, word: str) -> int:
        """STRONGLY or SOMEWHAT or neither, and PERSON for a second person."""
        keys = {word, *(f"{word[:k]}-" for k in STEMS if len(word) > k)}
        return (STRONGLY if keys & self.strong else SOMEWHAT if keys & self.some else 0) | (PERSON if word in SECOND else 0)

    def kinds(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KEEP:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = self.kind(w)
        return np.frombuffer(bytes(map(known.__getitem__, words)), np.uint8)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``NAMES``; zeros for an empty text."""
    if not text:
        return [0.0] * len(NAMES)
    low = text.lower()
    words = _WORD.findall(low)
    n = max(1, len(words))
    kinds = lexicon.kinds(words)
    hits, some, you = (np.flatnonzero(kinds & k) for k in (STRONGLY, SOMEWHAT, PERSON))
    near = 0
    if len(hits) and len(you):
        after = np.searchsorted(you, hits)
        left, right = np.abs(hits - you[np.maximum(after - 1, 0)]), np.abs(you[np.minimum(after, len(you) - 1)] - hits)
        near = int((np.minimum(left, right) <= NEAR).sum())
    mixed = _MIXED.findall(low) if _SIGN.search(low) else []
    hidden = sum(lexicon.kind(m.translate(SIGNS)) & STRONGLY > 0 for m in mixed)
    byte = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)  # below 128 the characters themselves
    upper, letters = byte[65:91].sum(), byte[65:91].sum() + byte[97:123].sum()
    if not text.isascii():
        codes, times = np.unique(np.frombuffer("".join(_BEYOND.findall(text)).encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
        for c, k in zip(map(chr, codes.tolist()), times.tolist()):
            upper, letters = upper + k * c.isupper(), letters + k * c.isalpha()
    letters = max(1, letters)
    marks = byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum()
    held = {words[i] for i in hits.tolist()}
    return [float(len(hits)), float(len(held)), len(hits) / n, len(some) / n, float(len({words[i] for i in some.tolist()})), float(near), len(you) / n, upper / letters,
            float(upper / letters > 0.5), byte[33] / n, byte[63] / n, marks / n, len(mixed) / n, float(hidden), byte[48:58].sum() / n, math.log1p(n)]


def with_features(df: DataFrame, words: tuple[frozenset[str], frozenset[str]], text: str = "text") -> DataFrame:
    """Add ``features`` (array<double>) in place of the text."""
    shared = df.sparkSession.sparkContext.broadcast(words)  # a few hundred words

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(*shared.value)
        for texts in batches:
            yield pd.Series([features(t, lexicon) for t in texts])

    return df.withColumn("features", run(F.col(text))).drop(text)


def scores(df: DataFrame, labels: DataFrame, label: str = "label", text: str = "text", key: str = "doc_id", documents: int = DOCUMENTS) -> DataFrame:
    """(key, score) of every row of ``df``, learned from about ``documents`` rows of ``labels``.

    Trees are grown on two thirds of the sample and calibrated on the rest.  Null and empty
    texts have features of zero and a score like any other.  Without two classes among the
    labels the score is the share of label 1, or 0.5 without labels.  Repeated rows are each
    scored, equal texts alike.
    """
    base = df.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    picked = sampled(labels, key, label, documents, "toxicity").withColumnRenamed(key, "_key")
    sample = checkpoint(base.where("text IS NOT NULL").join(F.broadcast(picked), "_key"))
    known = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    if len(known) < 2:
        constant = 0.5 if not known else float(next(iter(known)))
        return base.select(F.col("_key").alias(key), F.lit(constant).alias("score"))
    words = lexicons(sample)
    third = F.pmod(F.xxhash64(F.col("_key").cast("string"), F.lit("fold")), F.lit(3)) == 0
    columns = [F.col("features")[i].alias(c) for i, c in enumerate(NAMES)]
    pack = VectorAssembler(inputCols=NAMES, outputCol="packed")
    rows = checkpoint(with_features(sample, words).select("_label", third.alias("apart"), *columns))
    rows = pack.transform(rows).select("_label", "apart", "packed")
    trees = GBTClassifier(featuresCol="packed", labelCol="_label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, maxBins=64).fit(rows.where("NOT apart"))

    def raw(frame: DataFrame) -> DataFrame:
        return trees.transform(frame).withColumn("raw", vector_to_array("probability")[1])

    calibrated = IsotonicRegression(featuresCol="raw", labelCol="_label", predictionCol="score").fit(raw(rows).where("apart").select("raw", F.col("_label").cast("double")))
    every = pack.transform(with_features(base, words).select("_key", *columns))
    scored = calibrated.transform(raw(every).select("_key", "raw"))
    return scored.select(F.col("_key").alias(key), F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))
