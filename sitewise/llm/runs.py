"""Periodic runs of words: maximal stretches that repeat with a period, and texts without the repeats.

An enhanced suffix array (suffixes in order, their places, and the common prefixes of
neighbours) of the words of a batch of texts, each text apart, is built by prefix doubling:
suffixes that share a prefix are split by what follows, in rounds that look at the still equal
ones only.  The ranks of every round stay, so that a common stretch of any two places, forwards
or backwards, is found in as many steps as there were rounds.

Every split of a common prefix interval of depth d into two children is then tested from its
smaller child: suffix i begins (or i - d does) a branching square of period d exactly if the
place of the suffix d words on (or back) lies in the other child.  A square is rotated to the
left as far as it goes; stretches found with several periods keep the smallest.  Only places
in arrays are compared; there is no suffix tree.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import WORD

#: Words of texts that are sorted side by side; a longer text is sorted by itself.  Children looked at side by side.
BATCH, CHILDREN = 1 << 18, 1 << 20


class Suffixes:
    """Suffix array of texts side by side, each with an end of its own.

    ``order``: places by text and suffix; ``place``: its inverse; ``common[k]``: words that
    suffixes k - 1 and k of the order share; ``rank[r]``: equal where the first 2**r words are.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n = len(words)
        key = text.astype(np.int64) * (int(words.max(initial=0)) + 2) + words + 1
        self.order = np.argsort(key, kind="stable")
        fresh = np.empty(n, bool)
        fresh[:1], fresh[1:] = True, np.diff(key[self.order]) != 0
        self.place, self.rank = np.empty(n, np.int64), []
        self.place[self.order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        width = 1
        while True:
            starts = np.flatnonzero(fresh)
            size = np.diff(np.append(starts, n))
            wide = size > 1
            at = np.repeat(starts[wide] - np.cumsum(size[wide]) + size[wide], size[wide]) + np.arange(int(size[wide].sum()))
            if not len(at):
                break
            self.rank.append(self.place.astype(np.int32))
            suffix = self.order[at]
            group = self.place[suffix]
            key = group * n + self.place[suffix + width]
            by = np.argsort(key, kind="stable")
            self.order[at], key = suffix[by], key[by]
            split = np.flatnonzero(np.diff(key)) + 1
            fresh[at[split]] = True
            first = np.zeros(len(at), np.int64)
            first[split] = split
            first[np.flatnonzero(np.diff(key // n)) + 1] = np.flatnonzero(np.diff(key // n)) + 1
            self.place[self.order[at]] = at[np.maximum.accumulate(first)]
            width *= 2
        self.common = self._common()

    def _common(self) -> np.ndarray:
        """Words that neighbours of the order share: the widest equal rank, then ever narrower ones behind it."""
        out = np.zeros(len(self.order), np.int64)
        here = np.arange(1, len(self.order))
        sets = []
        for rank in self.rank:
            here = here[rank[self.order[here - 1]] == rank[self.order[here]]]
            sets.append(here)
        for r in reversed(range(len(self.rank))):
            k = sets[r]
            a, b = self.order[k - 1] + out[k], self.order[k] + out[k]
            out[k] += (self.rank[r][a] == self.rank[r][b]).astype(np.int64) << r
        return out

    def back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before places a and b that agree."""
        out = np.zeros(len(a), np.int64)
        for r in reversed(range(len(self.rank))):
            x, y = a - out - (1 << r), b - out - (1 << r)
            fits = (x >= 0) & (y >= 0)
            out += (fits & (self.rank[r][np.maximum(x, 0)] == self.rank[r][np.maximum(y, 0)])).astype(np.int64) << r
        return out


def _bounds(common: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the order in the interval that k splits: the nearest smaller value on either side, an equal one counting on the left."""
    left, right = np.arange(len(common)) - 1, np.arange(len(common)) + 1
    values = np.append(common, -1)  # also what stands at -1
    todo = k
    while len(todo):
        todo = todo[values[left[todo]] > common[todo]]
        left[todo] = left[left[todo]]
    todo = k
    while len(todo):
        todo = todo[values[right[todo]] >= common[todo]]
        right[todo] = right[right[todo]]
    return left[k], right[k] - 1


def squares(s: Suffixes, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of branching squares whose root occurs ``least`` times or more."""
    k = np.flatnonzero(s.common > 0)
    low, high = _bounds(s.common, k)
    keep = high - low + 1 >= least
    k, low, high = k[keep], low[keep], high[keep]
    small_left = k - low <= high - k + 1
    begin, size = np.where(small_left, low, k), np.where(small_left, k - low, high - k + 1)
    other, behind = np.where(small_left, k, low), np.where(small_left, high + 1, k)
    ends = np.cumsum(size)
    done = 0
    while done < len(k):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + CHILDREN, "right")))
        part = slice(done, upto)
        which = np.repeat(np.arange(done, upto), size[part])
        suffix = s.order[begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])]
        depth, lo, hi = s.common[k[which]], other[which], behind[which]
        after = s.place[suffix + depth]
        fits = (after >= lo) & (after < hi)
        yield suffix[fits], depth[fits]
        before = suffix - depth
        after = s.place[np.maximum(before, 0)]
        fits = (before >= 0) & (after >= lo) & (after < hi)
        yield before[fits], depth[fits]
        done = upto


def runs(words: np.ndarray, text: np.ndarray, least_length: int, least_exponent: int) -> np.ndarray:
    """Rows (first place, length, period) in this order; ``words`` holds an end of its own (-1) behind each text."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    s = Suffixes(words, text)
    found = []
    for place, period in squares(s, least_exponent):
        first = place - s.back(place, place + period)
        length = place + 2 * period - first
        keep = length >= np.maximum(least_length, least_exponent * period)
        found.append(np.stack([first[keep], length[keep], period[keep]], 1))
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(rows[:, :2], axis=0) != 0).any(1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def batches(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each row) of texts that are sorted side by side."""
    first, part, size = 0, [], 0
    for row, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").split() if text else []  # splits at the six characters of ASCII white space
        if part and size + len(words) > BATCH:
            yield first, part
            first, part, size = row, [], 0
        part.append(words)
        size += len(words) + 1
    if part:
        yield first, part


def found_in(part: list[list[bytes]], least_length: int, least_exponent: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, words counted from 0."""
    numbers = defaultdict(count().__next__)
    sizes = np.array([len(w) + 1 for w in part])
    ends = np.cumsum(sizes)
    flat = np.full(int(ends[-1]), -1, np.int64)
    for words, end in zip(part, ends):
        flat[end - 1 - len(words) : end - 1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    rows = runs(flat, np.repeat(np.arange(len(part)), sizes), least_length, least_exponent)
    owner = np.searchsorted(ends, rows[:, 0], "right")
    rows[:, 0] -= (ends - sizes)[owner]
    cut = np.searchsorted(owner, np.arange(len(part) + 1))
    for k in range(len(part)):
        yield [tuple(r) for r in rows[cut[k] : cut[k + 1]].tolist()]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        step[start + period] += 1
        step[start + length] -= 1
    kept = np.cumsum(step[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def best(found: list[tuple[int, int, int]]) -> tuple:
    """(start, length, period, exponent_milli) of the run with most periods, the earliest and shortest of ties."""
    if not found:
        return None, None, None, None
    start, length, period = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return start, length, period, 1000 * length // period


def _mapped(df: DataFrame, text: str, names: list[str], types: list[pa.DataType], schema: str, row: Callable, least_length: int, least_exponent: int) -> DataFrame:
    """``df`` with the columns that ``row(words, runs)`` gives for its texts."""

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(text).to_pylist()
            for first, words in batches(texts):
                made = [row(w, f) for w, f in zip(words, found_in(words, least_length, least_exponent))]
                same = part.slice(first, len(words))
                kept = [(n, same.column(n)) for n in same.schema.names if n not in names]
                yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(c, t) for c, t in zip(zip(*made), types)], [n for n, _ in kept] + names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in names)
    return df.mapInArrow(deal, f"{kept}, {schema}" if kept else schema)


def find_runs(df: DataFrame, text: str = "text", least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """``df`` with ``runs``: an array of (start, length, period) of each text's runs, by start, then period.

    A run is a maximal stretch of words of smallest period p that is at least ``least_length``
    and ``least_exponent`` (2 or more) periods long.  Words are what ASCII white space
    separates.  Null, empty and blank texts have none.  A column ``runs`` of the input is
    replaced.  Texts go to memory whole, each in one task, about a hundred bytes a word.
    """
    if least_exponent < 2:
        raise ValueError("a run is two periods or longer")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    row = lambda words, found: ([dict(zip(("start", "length", "period"), r)) for r in found],)
    return _mapped(df, text, ["runs"], [kind], "runs array<struct<start:bigint,length:bigint,period:bigint>>", row, least_length, least_exponent)


def collapse(df: DataFrame, text: str = "text", least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """``df`` with each text that has runs cut to what stands outside them and each run's first period, its words joined by one space.

    Texts without runs stay as they are, nulls too.
    """
    mark = "_collapsed_text"
    while mark in df.columns:
        mark += "_"
    row = lambda words, found: (b" ".join(collapsed(words, found)).decode("utf-8", "replace") if found else None,)
    return _mapped(df, text, [mark], [pa.string()], f"`{mark}` string", row, least_length, least_exponent).withColumn(text, F.coalesce(mark, text)).select(df.columns)


DIGESTS = {"n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}


def digest(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row, repeated ones too."""

    def row(words, found):
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        return (len(found), *best(found), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest())

    plain = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in DIGESTS.items())
    return _mapped(plain, "text", list(DIGESTS), list(DIGESTS.values()), schema, row, least_length, least_exponent).select("doc_id", *DIGESTS)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text), in a tenth of the texts words from some place on repeated with a period: what ``op11_runs`` looks at.

    Which, from where and with what period crc32 of the id decides.  A null id leaves the text as it is.
    """
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    again = F.transform(F.slice("w", F.col("a") + 1, n), lambda x, i: F.element_at("w", F.col("a") + i % F.col("p") + 1))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))
