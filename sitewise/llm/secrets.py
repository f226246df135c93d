"""Secret scans: candidates by their characters, false positives removed by a random forest.

Candidates are long runs of the characters that keys are written in.  The forest reads their
length, how characters follow each other (against the transitions of common words), how much
of them the dictionary covers, whether they look like paths, and the words and signs around
them.  It is trained from labelled findings: those of all documents, a bounded number of either
label, labelled by fixed rules for assignments to a credential's name and for known key
prefixes.  In half of the training rows what stands around is blanked, so that the characters must tell as well.
"""

from __future__ import annotations

import hashlib
import io
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import hand_back, resident
from sitewise.session import checkpoint

#: The dictionary, the forest, and the bound of the labelled findings, half for either label; hash bins by which they are bounded.
DICTIONARY, TREES, DEPTH, LEAF, ROWS, BINS = 5_000, 25, 8, 3, 40_000, 4096
THRESHOLD, MASK, AROUND = 0.5, "[SECRET]", 48
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Names that credentials are assigned to, and prefixes of known kinds of keys.
NAMED = re.compile(r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|auth|credential)\w*\W{0,8}[=:]\W{0,8}$", re.I)
NEAR = re.compile(r"token|secret|passw(?:or)?d|key|auth|credential", re.I)
PREFIX = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_|xox[abprs]-|sk_live_|glpat-|AIza")
PATH = re.compile(r"https?:|www|[/\\.]$|\.(?:com|org|net|html?|png|jpe?g|js|py)\b", re.I)
FEATURES = ["length", "switches", "digits", "upper", "distinct", "hex", "follows", "covered", "slashes", "path", "assigned", "quoted", "named", "prefix"]
BLANKED = [FEATURES.index(x) for x in ("path", "assigned", "quoted", "named", "prefix")]


class Speech:
    """Common words of the corpus and how likely characters follow each other in them."""

    def __init__(self, words: list[str]):
        self.words = frozenset(words)
        self.longest = max(map(len, words), default=0)
        count = np.full((128, 128), 0.1)
        for w in words:
            if w.isascii():
                for a, b in zip(w, w[1:]):
                    count[ord(a), ord(b)] += 1
        self.log = np.log(count / count.sum(1, keepdims=True))

    def covered(self, text: str) -> float:
        text, i, n = text.lower(), 0, 0
        while i < len(text):
            k = next((k for k in range(min(self.longest, len(text) - i), 2, -1) if text[i : i + k] in self.words), 0)
            n += k
            i += k or 1
        return n / len(text)

    def follows(self, text: str) -> float:
        code = np.frombuffer(text.lower().encode("ascii"), np.uint8)
        return float(self.log[code[:-1], code[1:]].mean())


def findings(text: str | None, speech: Speech) -> Iterator[tuple[int, int, list[float], int]]:
    """(start, end, features, label by rule) of the candidates of a text; places count code points."""
    for m in CANDIDATE.finditer(text or ""):
        s, (a, b) = m[0], m.span()
        before, after = text[max(0, a - AROUND) : a], text[b : b + AROUND]
        digit = [c.isdigit() for c in s]
        named, prefix = bool(NAMED.search(before)), bool(PREFIX.match(s))
        near = before.split()[-3:]
        yield a, b, [
            math.log(len(s)), sum(x != y for x, y in zip(digit, digit[1:])) / (len(s) - 1), sum(digit) / len(s), sum(map(str.isupper, s)) / len(s),
            len(set(s)) / min(len(s), 64), sum(c in "0123456789abcdefABCDEF" for c in s) / len(s), speech.follows(s), speech.covered(s),
            (s.count("/")) / len(s), float(bool(PATH.search(before[-12:]) or PATH.search(after[:6]))), float(bool(re.search(r"[=:]\W{0,3}$", before))),
            float(before[-1:] in "\"'`" and before != ""), float(any(map(NEAR.search, near))), float(prefix),
        ], int(named or prefix)


class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, left, right, value."""

    def __init__(self, trees: list[np.ndarray]):
        self.trees = trees

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = tree[at, 0].astype(np.int64)
                inner = f >= 0
                go = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= tree[at, 1], tree[at, 2], tree[at, 3]).astype(np.int64)
                at = np.where(inner, go, at)
            total += tree[at, 4]
        return total / max(1, len(self.trees))


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One tree by the largest fall of Gini impurity over a random part of the features."""
    nodes: list[list[float]] = []

    def node(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0, 0, 0, float(y[rows].mean())])
        if depth == DEPTH or len(rows) < 2 * LEAF or y[rows].min() == y[rows].max():
            return me
        best = (1e-9, -1, 0.0)
        total, n = y[rows].sum(), len(rows)
        for f in rng.choice(x.shape[1], max(2, int(x.shape[1] ** 0.5) + 1), replace=False):
            order = np.argsort(x[rows, f], kind="stable")
            v, c = x[rows, f][order], np.cumsum(y[rows][order])
            k = np.arange(1, n)
            ok = (v[1:] > v[:-1]) & (k >= LEAF) & (n - k >= LEAF)
            if ok.any():
                left, right = c[:-1], total - c[:-1]
                gain = np.where(ok, left * left / k + (k - left) ** 2 / k + right * right / (n - k) + (n - k - right) ** 2 / (n - k), 0) - (total * total + (n - total) ** 2) / n
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (float(gain[i]), int(f), float((v[i] + v[i + 1]) / 2))
        if best[1] < 0:
            return me
        goes = x[rows, best[1]] <= best[2]
        nodes[me][:2] = best[1], best[2]
        nodes[me][2] = node(rows[goes], depth + 1)
        nodes[me][3] = node(rows[~goes], depth + 1)
        return me

    node(np.arange(len(x)), 0)
    return np.array(nodes)


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """A forest of trees on samples with as many rows of either label."""
    rng = np.random.default_rng(3)
    x = x.copy()
    x[np.ix_(rng.random(len(x)) < 0.5, BLANKED)] = 0
    one, zero = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = max(2 * LEAF, min(len(one), len(zero), ROWS // 2))
    trees = []
    for _ in range(TREES):
        rows = np.concatenate([rng.choice(one, n), rng.choice(zero, n)])
        trees.append(grow(x[rows], y[rows], rng))
    return Forest(trees)


def train(df: DataFrame, text: str = "text", key: str = "doc_id", rows: int = ROWS // 2) -> tuple[list[str], bytes | None]:
    """(dictionary, forest): words counted over all documents, findings of all documents; no text reaches the driver.

    Of either label, about the ``rows`` findings of the smallest hashes train the forest.  It is
    None if the findings don't have both labels.
    """
    docs = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("text"))
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("w")).groupBy("w").count()
    common = [r["w"] for r in words.orderBy(F.desc("count"), "w").limit(DICTIONARY).collect()]

    def extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        speech = Speech(common)
        least: dict[int, list[tuple]] = {0: [], 1: []}  # of each label, those that can be among the smallest of all
        for part in parts:
            for k, t in zip(part["k"], part["text"]):
                for a, b, x, y in findings(t, speech):
                    least[y].append((xxhash.xxh64_intdigest(f"{k}|{a}|{t[a:b]}") >> 1, k, a, x, y))
                    if len(least[y]) >= 2 * rows + 1000:
                        least[y] = sorted(least[y], key=lambda r: r[0])[:rows]
        yield pd.DataFrame([r for y in least for r in sorted(least[y], key=lambda r: r[0])[:rows]], columns=["point", "k", "a", "x", "y"])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = [p for p in parts if len(p)]
        if not some:
            return
        every = pd.concat(some, ignore_index=True)
        if every["y"].nunique() == 2:
            every = every.sort_values(["k", "a", "point"], na_position="first", kind="stable")
            forest = fit(np.stack(every["x"].to_numpy()), every["y"].to_numpy(np.int64))
            b = io.BytesIO()
            np.savez_compressed(b, *forest.trees)
            yield pd.DataFrame({"model": [b.getvalue()]})

    labelled = checkpoint(docs.mapInPandas(extract, "point long, k string, a long, x array<double>, y int"))
    part = F.shiftright("point", 63 - BINS.bit_length() + 1).alias("bin")
    last = {0: -1, 1: -1}
    total = {0: 0, 1: 0}
    for r in labelled.groupBy("y", part).count().orderBy("y", "bin").collect():  # at most BINS of each label
        total[r["y"]] += r["count"]
        if total[r["y"]] <= rows or last[r["y"]] < 0:
            last[r["y"]] = r["bin"]
    kept = labelled.where(part <= F.when(F.col("y") == 1, last[1]).otherwise(last[0]))
    found = kept.repartition(1).mapInPandas(run, "model binary").collect()  # one model
    return common, bytes(found[0]["model"]) if found else None


class Judge:
    """Scores of a text's candidates; by the rule alone where no forest could be trained."""

    def __init__(self, model: tuple[list[str], bytes | None]):
        self.speech = Speech(model[0])
        z = np.load(io.BytesIO(model[1])) if model[1] else None
        self.forest = Forest([z[k] for k in z.files]) if z is not None else None

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, float]]]:
        found = [list(findings(t, self.speech)) for t in texts]
        flat = [f for x in found for f in x]
        if not flat:
            return [[] for _ in texts]
        scores = self.forest.score(np.array([f[2] for f in flat])) if self.forest else np.array([float(f[3]) for f in flat])
        it = iter(scores.tolist())
        return [[(a, b, next(it)) for a, b, _, _ in x] for x in found]


def scan(df: DataFrame, model: tuple[list[str], bytes | None], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each candidate: the other columns of ``df``, ``start``, ``length``, ``sha256``, ``score`` and ``secret``.

    Null and empty texts have none; a repeated row's candidates are repeated.  The candidate
    itself is not returned.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<start:long,length:long,sha256:string,score:double>>"

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        judge = Judge(shared.value)
        for texts in batches:
            yield pd.Series([[{"start": a, "length": b - a, "sha256": hashlib.sha256(t[a:b].encode()).hexdigest(), "score": s} for a, b, s in x] for t, x in zip(texts, judge(texts.tolist()))])

    kept = [c for c in df.columns if c != text and c not in ("start", "length", "sha256", "score", "secret")]
    rows = df.select(*kept, F.explode(run(F.col(text))).alias("_f"))
    return rows.select(*kept, "_f.*").withColumn("secret", F.col("score") >= threshold)


def redact(df: DataFrame, model: tuple[list[str], bytes | None], text: str = "text", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``df`` with every secret of ``text`` replaced by ``mask``; null texts stay null, all rows stay."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        resident(("secrets",), dict)  # what the worker held before goes
        judge = Judge(shared.value)
        for texts in batches:
            out = []
            for t, found in zip(texts, judge(texts.tolist())):
                for a, b, s in reversed(found):
                    if s >= threshold:
                        t = t[:a] + mask + t[b:]
                out.append(t)
            yield pd.Series(out, dtype=object)
        del judge
        hand_back()

    return df.withColumn(text, run(F.col(text)))
