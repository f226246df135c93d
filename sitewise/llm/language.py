"""Language of the words of a text by a linear-chain conditional random field, and of the text by its words.

A word's features are hashed: the word itself (lexicon), n-grams that touch its ends (affixes)
and those inside.  Chains are consecutive runs of at most ``CHAIN`` words.  Training follows
the gradient of the chains' log-likelihood, observed minus expected features and transitions;
the expectations, and at scoring the marginals of every word, come from the forward-backward
recursion, which runs over all chains of a batch at once.
"""

from __future__ import annotations

import hashlib
import io
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import hand_back, resident

CHAIN, BUCKETS, KEEP, WORDS, PART = 64, 1 << 16, 200_000, 200_000, 20_000
#: The bound of the training sample: about so many documents of each language and at most so many chains of each document.
DOCUMENTS, CHAINS, EPOCHS, BATCH, RATE, DECAY = 600, 12, 3, 64, 0.3, 1e-6
MOST_LANGUAGES = 200
_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; runs of word characters that hold no letter don't count."""
    found = _WORD.findall((text or "").lower())
    return [w for w in found if w.isascii() or any(map(str.isalpha, w))]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, begin): hashed features of the words one after the other, and where each word's begin."""
    if len(words) > PART:  # the arrays below hold dozens of bytes for each character
        parts = [features(words[a : a + PART]) for a in range(0, len(words), PART)]
        sizes = np.cumsum([0] + [len(p[0]) for p in parts])
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + n for p, n in zip(parts, sizes)])
    text = "".join(f"\x02{w}\x03" for w in words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    begin = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    prime = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        place = (code + np.uint64(7)) * prime ^ (np.arange(len(code)) - begin[word]).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        place ^= place >> np.uint64(29)
        lexicon = np.add.reduceat(place * prime, begin)
        hashes, owner = [lexicon], [np.arange(len(words))]
        gram = code.copy()
        for n in (2, 3, 4):
            gram = (gram[:-1] * np.uint64(1_000_003) + code[n - 1 :]) & np.uint64(0xFFFFFFFFFFFFFFFF)
            inside = word[: len(gram)] == word[n - 1 :]
            if n == 4:  # of the longest only affixes
                inside &= (code[: len(gram)] == 2) | (code[n - 1 :] == 3)
            hashes.append(gram[inside] * prime + np.uint64(n))
            owner.append(word[: len(gram)][inside])
        every, owners = np.concatenate(hashes), np.concatenate(owner)
        every = (every * prime) >> np.uint64(64 - 16)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return every[order].astype(np.uint16), np.cumsum(counts) - counts


def chains(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, length) of the chains of texts with so many words, which stand one after the other."""
    each = -(-sizes // CHAIN)
    text = np.repeat(np.arange(len(sizes)), each)
    at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return text, np.repeat(np.cumsum(sizes) - sizes, each) + at * CHAIN, np.minimum(CHAIN, sizes[text] - at * CHAIN)


def forward_backward(emission: np.ndarray, begin: np.ndarray, length: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of every word, expected transitions, and the words that chains hold (indices into ``emission``, chain by step)."""
    n, width, languages = len(begin), int(length.max(initial=1)), emission.shape[1]
    step = np.arange(width)
    inside = step[None, :] < length[:, None]
    index = np.where(inside, begin[:, None] + step[None, :], 0)
    psi = np.exp(emission - emission.max(1, keepdims=True))[index]
    move = np.exp(transition - transition.max())
    ahead = np.empty((width, n, languages))
    a = psi[:, 0] / psi[:, 0].sum(1, keepdims=True)
    ahead[0] = a
    for t in range(1, width):
        b = (a @ move) * psi[:, t]
        a = np.where(inside[:, t, None], b / b.sum(1, keepdims=True), a)
        ahead[t] = a
    marginal = np.zeros((n, width, languages))
    pairs = np.zeros((languages, languages))
    back = np.ones((n, languages))
    for t in range(width - 1, -1, -1):
        m = ahead[t] * back
        marginal[:, t] = m / m.sum(1, keepdims=True)
        if t:
            here = inside[:, t]
            right = psi[:, t] * back
            joint = ahead[t - 1][:, :, None] * move[None] * right[:, None, :]
            if here.any():
                pairs += (joint[here] / joint[here].sum((1, 2), keepdims=True)).sum(0)
            b = right @ move.T
            back = np.where(here[:, None], b / b.sum(1, keepdims=True), back)
    return marginal, pairs, np.where(inside, index, -1)


class Field:
    """Weights of hashed features and of transitions, and the languages they stand for."""

    def __init__(self, languages: list[str], weight: np.ndarray, transition: np.ndarray):
        self.languages, self.weight, self.transition = languages, weight, transition
        self.known: dict[str, int] = {}
        self.emission = np.zeros((KEEP, len(languages)))

    def emissions(self, words: list[str]) -> np.ndarray:
        known = self.known
        missing = {w for w in words if w not in known}
        if missing:
            if len(known) + len(missing) > KEEP:
                known.clear()
                missing = set(words)
                if len(missing) > KEEP:  # a batch has at most WORDS words and one text more
                    self.emission = np.zeros((len(missing), len(self.languages)))
            new = list(missing)
            bucket, begin = features(new)
            first = len(known)
            self.emission[first : first + len(new)] = np.add.reduceat(self.weight[bucket], begin)
            known.update(zip(new, range(first, first + len(new)), strict=True))
        return self.emission[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    def label(self, lists: list[list[str]]) -> np.ndarray:
        """Mean marginals of the words of each text; zeros without words."""
        out = np.zeros((len(lists), len(self.languages)))
        sizes = np.array([len(x) for x in lists], np.int64)
        if not sizes.sum():
            return out
        emission = self.emissions([w for x in lists for w in x])
        text, begin, length = chains(sizes)
        for full in (True, False):  # whole chains and the shorter ends go through apart
            mine = (length == CHAIN) == full
            if mine.any():
                marginal, _, index = forward_backward(emission, begin[mine], length[mine], self.transition)
                np.add.at(out, text[mine], np.where((index >= 0)[:, :, None], marginal, 0).sum(1))
        return out / np.maximum(sizes, 1)[:, None]

    def dump(self) -> bytes:
        b = io.BytesIO()
        np.savez(b, languages=np.array(self.languages), weight=self.weight.astype(np.float32), transition=self.transition)
        return b.getvalue()

    @staticmethod
    def load(blob: bytes) -> Field:
        z = np.load(io.BytesIO(blob))
        return Field(z["languages"].tolist(), z["weight"].astype(np.float64), z["transition"])


def fit(texts: list[str], langs: list[str]) -> Field:
    """A field from whole texts whose words all carry the text's language; adaptive gradient steps over batches of chains."""
    languages = sorted(set(langs))
    place = {x: i for i, x in enumerate(languages)}
    number: dict[str, int] = {}
    every, ends = array("q"), [0]
    for t in texts:
        every.extend([number.setdefault(w, len(number)) for w in words_of(t)])
        ends.append(len(every))
    ids = np.array(every, np.int64)
    weight = np.zeros((BUCKETS, len(languages)))
    transition = np.zeros((len(languages), len(languages)))
    if not len(ids):
        return Field(languages, weight, transition)
    bucket, start = features(list(number))
    stop = np.append(start[1:], len(bucket))
    text, begin, length = chains(np.diff(np.array(ends, np.int64)))
    rng = np.random.default_rng(7)
    random = rng.random(len(text))
    order = np.lexsort((random, text))
    nth = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    taken = order[nth < CHAINS]
    label = np.array([place[x] for x in langs])[text]
    seen, moved = np.full_like(weight, 1e-8), np.full_like(transition, 1e-8)
    for _ in range(EPOCHS):
        taken = rng.permutation(taken)
        for a in range(0, len(taken), BATCH):
            some = taken[a : a + BATCH]
            spans = [np.arange(b, b + n) for b, n in zip(begin[some], length[some])]
            flat = np.concatenate(spans)
            own, back = np.unique(ids[flat], return_inverse=True)
            sizes = stop[own] - start[own]
            first = np.cumsum(sizes) - sizes
            used = bucket[np.repeat(start[own] - first, sizes) + np.arange(sizes.sum())]
            emission = np.add.reduceat(weight[used], first)[back]
            at = np.cumsum(length[some]) - length[some]
            marginal, pairs, index = forward_backward(emission, at, length[some], transition)
            gap = np.zeros_like(emission)
            gap[index[index >= 0]] = -marginal[index >= 0]
            gap[np.arange(len(flat)), np.repeat(label[some], length[some])] += 1
            by_word = np.zeros((len(own), len(languages)))
            np.add.at(by_word, back, gap)
            spread = np.repeat(by_word, sizes, axis=0)
            rows, slot = np.unique(used, return_inverse=True)
            grad = np.stack([np.bincount(slot, spread[:, k], len(rows)) for k in range(len(languages))], 1)
            seen[rows] += grad * grad
            weight[rows] += RATE * grad / np.sqrt(seen[rows]) - DECAY * weight[rows]
            observed = np.bincount(label[some], length[some] - 1, len(languages))
            grad = np.diag(observed) - pairs
            moved += grad * grad
            transition += RATE * grad / np.sqrt(moved) * 0.1
    return Field(languages, weight, transition)


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", documents: int = DOCUMENTS) -> bytes | None:
    """Fit on about ``documents`` documents of each language, picked by a hash of ``key``; the weights reach the driver, no text does."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[lang]: r["count"] for r in rows.groupBy(lang).count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, documents / n))])
    point = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("language")), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(point < F.element_at(share, F.col(lang))).select(F.col(key).cast("string").alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resident(("language", "fit"), dict)  # what the worker held before goes
        some = [p for p in parts if len(p)]
        if not some:
            return
        every = pd.concat(some, ignore_index=True)
        every = every.sort_values(["k", "text", "lang"], na_position="first")
        model = fit(every["text"].tolist(), every["lang"].tolist()).dump()
        del every, some
        hand_back()
        yield pd.DataFrame({"model": [model]})

    found = sample.repartition(1).mapInPandas(run, "model binary").collect()  # one model
    return bytes(found[0]["model"]) if found else None


def predict(df: DataFrame, model: bytes | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the mean marginal of that language over the text's words.

    A text that is null or has no letter is ``und`` with score 0; so is any where no model
    could be learned.  Equal texts get equal results, ties go to the first language by name.
    """
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    df = df.select(*kept)
    if model is None:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    blob = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        field = resident(("language", hashlib.sha256(blob.value).digest()), lambda: Field.load(blob.value))
        names = np.array([*field.languages, UNKNOWN], object)
        for texts in batches:
            found, values, waiting, n = [], [], [], 0

            def flush(waiting: list[list[str]]) -> None:
                means = field.label(waiting)
                best = means.argmax(1)
                some = means.sum(1) > 0
                found.append(np.where(some, best, len(field.languages)))
                values.append(np.where(some, means[np.arange(len(best)), best], 0.0))

            for t in texts:
                waiting.append(words_of(t))
                n += len(waiting[-1])
                if n >= WORDS:
                    flush(waiting)
                    waiting, n = [], 0
            if waiting:
                flush(waiting)
            yield pd.DataFrame({"lang_pred": names[np.concatenate(found)] if found else [], "score": np.minimum(1.0, np.concatenate(values)) if values else []})

    return df.withColumn("_l", score(F.col(text))).select(*kept, "_l.lang_pred", "_l.score")
