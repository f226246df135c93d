"""Quality by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are runs of word characters and runs of other marks.  Features are single tokens, pairs
of neighbours, and pairs and triples of token shapes (letter case, digits, kind of mark) with a
sign for a token that repeats an earlier one of the n-gram; all are hashed into one space.  A
text's values are square roots of counts, scaled to length one.  Training goes through the
sample once for each epoch and keeps, for each coordinate, the sums that give its weight
directly, with weights below the L1 threshold at zero.  A score is a sparse dot product.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import Recent, sampled

BITS, KEEP, SLICE = 18, 200_000, 200_000
#: The bound of the training sample, and the learner's constants.
DOCUMENTS, EPOCHS, ALPHA, BETA, L1, L2 = 12_000, 4, 0.5, 1.0, 0.2, 1.0
_TOKEN = re.compile(r"\w+|[^\w\s]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: str) -> int:
    if token.isdigit():
        return 1
    if token[0].isalnum() or token[0] == "_":
        if token.islower():
            return 2
        return 3 if token.isupper() and len(token) > 1 else 4 if token.istitle() else 5
    if token in (".", ",", ";", ":", "?", "!", "'", '"', "-"):
        return 6
    return 7 if len(set(token)) == 1 else 8


class Hasher:
    """Hashed features of texts, with a bounded memo of tokens."""

    def __init__(self):
        self.tokens = Recent(lambda t: (zlib.crc32(t.encode("utf-8", "surrogatepass")) | len(t) << 32, _shape(t)), KEEP)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, values); long texts are counted in slices that share no n-gram's start."""
        tokens = _TOKEN.findall(text or "")
        total: dict[int, int] | None = None
        found = []
        memo = self.tokens
        for a in range(0, len(tokens), SLICE):
            part = [memo[t] for t in tokens[a : a + SLICE + 2]]
            n = min(SLICE, len(tokens) - a)
            code = np.array([p[0] for p in part], np.uint64)
            shape = np.array([p[1] for p in part], np.uint64)
            found.append(np.unique(self._hashes(code, shape, n), return_counts=True))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        if len(found) > 1:
            bucket, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            count = np.bincount(back, np.concatenate([f[1] for f in found]))
        else:
            bucket, count = found[0]
        value = np.sqrt(count)
        return bucket.astype(np.int64), value / np.sqrt((value * value).sum())

    @staticmethod
    def _hashes(code: np.ndarray, shape: np.ndarray, n: int) -> np.ndarray:
        one = code[:n]
        with np.errstate(over="ignore"):
            out = [one * MIX + np.uint64(1)]
            if len(code) > 1:
                a, b = code[:-1][:n], code[1:][:n]
                out.append((a * MIX ^ b) * MIX + np.uint64(2))
                same = (a == b).astype(np.uint64)
                pair = (shape[:-1][:n] << np.uint64(4) | shape[1:][:n]) << np.uint64(1) | same
                out.append(pair * MIX + np.uint64(3))
            if len(code) > 2:
                a, b, c = code[:-2][:n], code[1:-1][:n], code[2:][:n]
                same = (a == b).astype(np.uint64) << np.uint64(2) | (b == c).astype(np.uint64) << np.uint64(1) | (a == c).astype(np.uint64)
                three = (shape[:-2][:n] << np.uint64(8) | shape[1:-1][:n] << np.uint64(4) | shape[2:][:n]) << np.uint64(3) | same
                out.append(three * MIX + np.uint64(4))
            mixed = np.concatenate(out)
            mixed ^= mixed >> np.uint64(31)
            return (mixed * MIX) >> np.uint64(64 - BITS)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """(weights, bias) of whole texts; the classes weigh as they come, so scores are probabilities."""
    hasher = Hasher()
    rows = [hasher.counts(t) for t in texts]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = bias = 0.0
    rng = np.random.default_rng(11)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            bucket, value = rows[i]
            w = weights(z[bucket], n[bucket])
            gap = float(sigmoid(w @ value + bias)) - labels[i]
            g = gap * value
            sigma = (np.sqrt(n[bucket] + g * g) - np.sqrt(n[bucket])) / ALPHA
            z[bucket] += g - sigma * w
            n[bucket] += g * g
            sigma = (np.sqrt(nb + gap * gap) - np.sqrt(nb)) / ALPHA
            zb += gap - sigma * bias
            nb += gap * gap
            bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
    return weights(z, n), bias


def train(df: DataFrame, labels: DataFrame, label: str = "label", text: str = "text", key: str = "doc_id", documents: int = DOCUMENTS) -> bytes | None:
    """Fit on about ``documents`` labelled rows, picked by a hash of ``key``; only the weights reach the driver.

    Null texts and labels are left out; None where no row is left.
    """
    picked = F.broadcast(sampled(labels, key, label, documents, "quality"))
    rows = df.select(key, F.col(text).alias("text")).where("text IS NOT NULL").join(picked, key)
    sample = rows.select(F.col(key).cast("string").alias("k"), "text", F.col("_label").alias("label"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = [p for p in parts if len(p)]
        if not some:
            return
        every = pd.concat(some, ignore_index=True)
        every = every.sort_values(["k", "text", "label"], na_position="first")
        w, bias = fit(every["text"].tolist(), every["label"].tolist())
        b = io.BytesIO()
        np.savez_compressed(b, w=w.astype(np.float32), bias=bias)
        yield pd.DataFrame({"model": [b.getvalue()]})

    found = sample.repartition(1).mapInPandas(run, "model binary").collect()  # one model
    return bytes(found[0]["model"]) if found else None


def score(df: DataFrame, model: bytes | None, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1 to every row.

    A null or empty text has no features and gets the bias alone; so do all where no model could
    be learned (0.5).  Equal texts get equal scores.
    """
    df = df.drop(out)
    if model is None:
        return df.withColumn(out, F.lit(0.5))
    blob = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        z = np.load(io.BytesIO(blob.value))
        w, bias, hasher = z["w"].astype(np.float64), float(z["bias"]), Hasher()
        for texts in batches:
            values = []
            for t in texts:
                bucket, value = hasher.counts(t)
                values.append(w[bucket] @ value + bias)
            yield pd.Series(sigmoid(np.array(values, np.float64)))

    return df.withColumn(out, run(F.col(text)))
