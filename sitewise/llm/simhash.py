"""Near-duplicates by 64-bit fingerprints and vantage-point trees.

Distinct fingerprints are dealt to the leaves of a vantage-point tree: at every node, those
nearer to the vantage point than the median go left.  By the triangle inequality a neighbour
within ``radius`` of a fingerprint can lie on the other side only if its distance to the
vantage point is within ``radius`` of the median, so a fingerprint is sent as a query to those
leaves and no others.  In each leaf the tree goes on, over arrays, and the last nodes are
compared bit by bit.  A leaf returns one link for each fingerprint to the first of its local
group, not its pairs, so a group of any size costs a row for each member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sitewise.llm.common import hand_back, resident, shielded
from sitewise.llm.components import components
from sitewise.session import checkpoint

SEED, SHINGLE, RADIUS = 42, 3, 3
#: Distinct fingerprints that a leaf should hold, the deepest tree that the driver lays out, and sampled fingerprints for each leaf.
LEAF, DEEPEST, PER_LEAF = 8192, 12, 16
NODE, PAIRS, SLICE = 96, 1 << 22, 1 << 16


def fingerprint(text: str | None) -> int:
    """Majority bits of the shingles' XXH64, repeats included, as a signed 64-bit number; no words: 0."""
    import xxhash

    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    width = len(words) - n + 1
    ends = list(accumulate((len(w) + 1 for w in words)))
    begins = [0, *ends]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        stop = min(n, at + SLICE)
        hashes = np.array([digest(joined[b : e - 1], SEED) for b, e in zip(begins[at:stop], ends[at + width - 1 : stop + width - 1])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array((fingerprint(t.as_py()) for t in texts), pa.int64())


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """Nodes as (vantage point, median, left, right), leaves as numbers; built from a bounded sample."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.leaves = 0
        self.top = self._node(sample, depth)

    def _node(self, points: np.ndarray, depth: int):
        if depth == 0 or len(points) < 4:
            self.leaves += 1
            return self.leaves - 1
        d = distance(points, points[0])
        median = int(np.median(d[1:]))
        if (d > median).all() or (d <= median).all():
            self.leaves += 1
            return self.leaves - 1
        return points[0], median, self._node(points[d <= median], depth - 1), self._node(points[d > median], depth - 1)

    def homes(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, leaf, home): each point at its own leaf, and as a query at the later leaves that its ball meets."""
        own = np.zeros(len(points), np.int64)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []

        def go(node, index, home):
            if not len(index):
                return
            if isinstance(node, int):
                own[index[home]] = node
                found.append((index, node, home))
                return
            point, median, left, right = node
            d = distance(points[index], point).astype(np.int64)
            near, far = d - radius <= median, d + radius > median
            go(left, index[near], (home & (d <= median))[near])
            go(right, index[far], (home & (d > median))[far])

        go(self.top, np.arange(len(points)), np.ones(len(points), bool))
        index = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        leaf = np.concatenate([np.full(len(f[0]), f[1], np.int64) for f in found] or [np.zeros(0, np.int64)])
        home = np.concatenate([f[2] for f in found] or [np.zeros(0, bool)])
        take = home | (leaf > own[index])
        return index[take], leaf[take], home[take]


def close_pairs(points: np.ndarray, n_home: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (query, home point) within ``radius``; the first ``n_home`` points are at home."""
    work = [(np.arange(n_home), np.arange(len(points)))]
    while work:
        mine, asking = work.pop()
        if not len(mine) or not len(asking):
            continue
        if len(mine) > NODE:
            d = distance(points[mine], points[mine[0]]).astype(np.int16)
            median = np.int16(np.median(d))
            if (d > median).any():
                q = distance(points[asking], points[mine[0]]).astype(np.int16)
                left, right = q - radius <= median, q + radius > median
                if not (left.all() and right.all()):
                    work += [(mine[d <= median], asking[left]), (mine[d > median], asking[right])]
                    continue
        step = max(1, PAIRS // len(mine))
        for at in range(0, len(asking), step):
            part = asking[at : at + step]
            i, j = np.nonzero(distance(points[part][:, None], points[mine][None, :]) <= radius)
            other = part[i] != mine[j]
            if other.any():
                yield part[i[other]], mine[j[other]]


def local_groups(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each index reaches, from blocks of pairs."""
    label = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links whose components are those of all pairs of ``classes.fp`` within ``radius``."""
    spark = classes.sparkSession
    n = classes.count()
    depth = min(DEEPEST, max(4, math.ceil(math.log2(max(1, n) / LEAF))))
    sample = classes.orderBy(F.xxhash64("fp"), "fp").limit(PER_LEAF << depth).collect()  # at most PER_LEAF << DEEPEST numbers
    tree = Tree(np.array([r["fp"] for r in sample], np.int64).view(np.uint64), depth)
    shared = spark.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            points = part["fp"].to_numpy(np.int64)
            index, leaf, home = shared.value.homes(points.view(np.uint64), radius)
            yield pd.DataFrame({"leaf": leaf, "fp": points[index], "home": home})

    def leaf_links(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("home", ascending=False, kind="stable")
        fp = part["fp"].to_numpy(np.int64)
        label = local_groups(len(fp), close_pairs(fp.view(np.uint64), int(part["home"].sum()), radius))
        moved = label != np.arange(len(fp))
        return pd.DataFrame({"a": fp[moved], "b": fp[label[moved]]})

    dealt = classes.select("fp").mapInPandas(deal, "leaf long, fp long, home boolean")
    return dealt.groupBy("leaf").applyInPandas(leaf_links, "a long, b long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id: the smallest id reachable over links.

    Null and empty texts, and those of white space, have fingerprint zero and link like any
    other.  Rows with equal fingerprints meet as one class, so thousands of copies cost one
    comparison.  Repeated rows are each returned.  A null id is returned with its group's
    smallest id, null where the group has none.  An empty table gives an empty table.
    """
    prints = checkpoint(df.select(F.col(doc_id).alias("doc_id"), _fingerprints(F.col(text)).alias("fp")))
    classes = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    groups = checkpoint(components(links(classes, radius)))
    label = F.coalesce("component", "fp")
    named = classes.join(groups, F.col("fp") == F.col("node"), "left").select("fp", label.alias("component"), "first_id")
    named = checkpoint(named)
    firsts = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = checkpoint(named.join(checkpoint(firsts), "component").select("fp", "component_id"))
    return prints.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _first_rows(df: DataFrame, groups: DataFrame, doc_id: str, text: str, nulls_apart: bool) -> DataFrame:
    """One row of each group of texts, from (h, component) by ``xxhash64`` of the text: that of the smallest id, then of a hash of the row.

    A null id comes last; with ``nulls_apart`` the rows with a null id are a group of their own.
    """
    df, moved, named_back = shielded(df, ("_h", "_none", "_first", "_f"))
    doc_id, text = moved.get(doc_id, doc_id), moved.get(text, text)
    none = F.col(doc_id).isNull() if nulls_apart else F.lit(False)
    first = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(*df.columns).alias("row"), F.col("_h").alias("h"))
    rows = df.withColumn("_h", F.xxhash64(text)).withColumn("_none", none)
    named = rows.select("_h", "_none", first.alias("_first")).join(groups, F.col("_h") == F.col("h"), "left").withColumn("g", F.coalesce("component", "_h"))
    firsts = named.groupBy("g", "_none").agg(F.min("_first").alias("_f"), F.count(F.lit(1)).alias("n"))
    firsts = checkpoint(firsts.where("n > 1").drop("n"))
    grouped = checkpoint(named.select("g", "_none", "_h").distinct().join(firsts, ["g", "_none"]).select("_h", "_none", "_f"))
    single = rows.join(grouped, ["_h", "_none"], "left_anti")
    best = rows.withColumn("_first", first).join(grouped, ["_h", "_none"]).where("_first <=> _f").dropDuplicates(["_f"])
    return named_back(single.select(df.columns).unionByName(best.select(df.columns)))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` without all but one of each group of near-duplicates.

    The row with the smallest id stays, once if it is repeated, and of the rows with a null id
    one more.  Rows are told apart by id and text, so an id with two texts loses only the copied one.
    """
    found = near_duplicates(df.select(F.xxhash64(text).alias("h"), F.col(text).alias("text")), "h", "text", radius)
    groups = checkpoint(found.select(F.col("doc_id").alias("h"), F.col("component_id").alias("component")).distinct())
    return _first_rows(df, groups, doc_id, text, True)


#: Near copies by their words: shingle width, least Jaccard of the shingle sets, and the widths in bits within which pairs are verified.
#: At Jaccard 0.8 prints of 256 bits differ in 31 to 41 +- 6 and their halves in half of that +- 4, those of four and five shingles in 48 +- 6;
#: unrelated ones in 128 +- 8 and 64 +- 6.  The widths are 6.7 and more deviations off, so what they rule out is unlike.
WIDTH, SIMILAR, HALF_APART, APART = 5, 0.8, 50, 82
#: Size up to which prints scatter more, and the widths there.
TINY, TINY_HALF, TINY_APART = 5, 58, 97
#: Distinct texts at home in a leaf: the least, and the part of all; pairs compared at once.
PART, PARTS, BLOCK = 1024, 48, 1 << 20
#: Texts of a large group that are compared in a task, and of small groups that share one.
MEMBERS, PACK = 256, 1024
#: Texts that are compared two by two, and columns of the incidence matrix of more that are held at once.
FEW, SLAB = 12, 8192
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
BITS = [f"w{k}" for k in range(len(SALTS))]


def shingles(text: str | None) -> set[bytes]:
    """The distinct runs of ``WIDTH`` words; fewer words are one run, no words none."""
    words = (text or "").encode().lower().split()
    return {b" ".join(words[k : k + WIDTH]) for k in range(max(1, len(words) - WIDTH + 1))} if words else set()


def jaccard(a: str | None, b: str | None) -> float:
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def wide_print(text: str | None) -> tuple[int, np.ndarray]:
    """Number of distinct shingles and the majority bits of their hashes, 64 for each salt; no words: zeros."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes = np.unique(np.array([digest(s, SEED) for s in shingles(text)], np.uint64))
    ones = np.zeros(64 * len(SALTS), np.int64)
    for at in range(0, len(hashes), 255):  # sums of bytes
        x = hashes[at : at + 255, None] + SALTS
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return len(hashes), np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")


def apart(one, two):
    """Bits in which the prints of sets of these sizes differ at most at Jaccard ``SIMILAR``."""
    return np.where(np.maximum(one, two) <= TINY, TINY_APART, APART)


def similar_prints(points: np.ndarray, size: np.ndarray, mine: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (asking, mine) whose prints and sizes allow Jaccard ``SIMILAR``; both lists of indices rise with size."""
    own, step = size[mine], max(1, BLOCK // max(1, len(mine)))
    for at in range(0, len(asking), step):
        part = asking[at : at + step]
        low, high = np.searchsorted(own, SIMILAR * size[part[0]] - 1), np.searchsorted(own, size[part[-1]] / SIMILAR + 1)
        some = mine[low:high]
        half = distance(points[part, 0][:, None], points[some, 0]) + distance(points[part, 1][:, None], points[some, 1])
        i, j = np.nonzero(half <= np.where(size[part] <= TINY, TINY_HALF, HALF_APART).astype(half.dtype)[:, None])
        i, j = part[i], some[j]
        d = distance(points[i], points[j]).sum(1, dtype=np.int64)
        ok = (i != j) & (d <= apart(size[i], size[j])) & (np.minimum(size[i], size[j]) >= SIMILAR * np.maximum(size[i], size[j]) - 1e-6)
        if ok.any():
            yield i[ok], j[ok]


def _leaf(part: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    part = part.sort_values(["home", "n", "h"], ascending=[False, True, True], ignore_index=True)
    return part, np.ascontiguousarray(part[BITS].to_numpy(np.int64)).view(np.uint64), part["n"].to_numpy(np.int64)


def _stars(part: pd.DataFrame) -> pd.DataFrame:
    """A pair for each text and the first of its local group."""
    part, points, size = _leaf(part)
    k = int(part["home"].sum())
    runs = [np.arange(k), np.arange(k, len(part))]
    label = local_groups(len(part), (p for run in runs for p in similar_prints(points, size, runs[0], run)))
    moved = label != np.arange(len(part))
    h = part["h"].to_numpy()
    return pd.DataFrame({"a": h[moved], "b": h[label[moved]]})


class _Sets:
    """Sorted hashes of the distinct shingles of texts, made when first asked for."""

    def __init__(self, texts: list[str | None]):
        self.texts, self.made = texts, {}

    def __getitem__(self, k: int) -> np.ndarray:
        import xxhash

        if k not in self.made:
            self.made[k] = np.unique(np.array([xxhash.xxh64_intdigest(x, SEED) for x in shingles(self.texts[k])], np.uint64))
        return self.made[k]

    def alike(self, a: int, b: int) -> bool:
        x, y = self[a], self[b]
        return self.enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))

    @staticmethod
    def enough(both, one, two):
        return both >= SIMILAR * (one + two - both) - 1e-9

    def shared(self, asking: np.ndarray) -> np.ndarray:
        """Common shingles of each row of ``asking`` with every row: products of slabs of the incidence matrix."""
        every = [self[k] for k in range(len(self.texts))]
        owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
        _, at, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
        at = (np.cumsum(times > 1) - 1)[at[(some := times[at] > 1)]]  # what only one text holds is shared by none
        owner = owner[some]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        out = np.zeros((len(asking), len(every)), np.float32)
        for low in range(0, int(at[-1]) + 1 if len(at) else 0, SLAB):
            a, b = np.searchsorted(at, [low, low + SLAB])
            slab = np.zeros((len(every), SLAB), np.float32)
            slab[owner[a:b], at[a:b] - low] = 1
            out += slab[asking] @ slab.T
        return out


def joined(part: pd.DataFrame, asking: np.ndarray) -> np.ndarray:
    """The first of each row's group: rows of ``asking`` are linked with all others that their prints allow and their texts confirm.

    In a few rows each two are compared unless they are in one group already; in many, common
    shingles of all are counted at once.
    """
    points, size, sets = np.ascontiguousarray(part[BITS].to_numpy(np.int64)).view(np.uint64), part["n"].to_numpy(np.int64), _Sets(part["text"].tolist())
    label = np.arange(len(part))
    allowed = lambda a: (np.minimum(size, size[a]) >= SIMILAR * np.maximum(size, size[a]) - 1e-6) & (distance(points, points[a]).sum(1, dtype=np.int64) <= apart(size, size[a]))
    if len(part) > FEW:
        held = np.array([len(sets[k]) for k in range(len(part))])
        links = sets.enough(sets.shared(asking), held[asking][:, None], held[None, :])
        i, j = np.nonzero(np.array([allowed(a) for a in asking.tolist()]) & links)
        return local_groups(len(part), [(asking[i], j)])
    done = np.zeros(len(part), bool)
    for a in asking.tolist():
        done[a] = True
        for k in np.flatnonzero(~done & allowed(a)).tolist():
            if label[k] != label[a] and sets.alike(a, k):
                one, two = sorted((label[a], label[k]))
                label[label == two] = one
    return label


def _within(part: pd.DataFrame) -> pd.DataFrame:
    """Links among the texts of each group of a pack, or of a block of a large group and that group's first text."""
    out = []
    for comp, own in part.groupby("comp", sort=True):
        own = own.sort_values(["h"], ignore_index=True)
        first = np.flatnonzero(own["h"].to_numpy() == comp)
        order = np.concatenate([first, np.setdiff1d(np.arange(len(own)), first)])
        own = own.iloc[order].reset_index(drop=True)
        label = joined(own, np.arange(len(own)))
        h, alone = own["h"].to_numpy(), own["blocks"].to_numpy() == 1
        out.append(pd.DataFrame({"comp": comp, "h": h, "to": h[label], "settled": alone | (label == 0)}))
    got = pd.concat(out, ignore_index=True)
    return got[(got["h"] != got["to"]) | ~got["settled"]]


def _across(part: pd.DataFrame) -> pd.DataFrame:
    """Links of a block's open texts with the texts of another block."""
    part = part.sort_values(["open", "h"], ascending=[False, True], ignore_index=True).drop_duplicates("h", ignore_index=True)
    label = joined(part, np.arange(int(part["open"].sum())))
    h = part["h"].to_numpy()
    moved = label != np.arange(len(h))
    return pd.DataFrame({"a": h[moved], "b": h[label[moved]]})


def near_copies(df: DataFrame, text: str = "text") -> DataFrame:
    """(h, component) of the distinct texts, by ``xxhash64``, that are linked: Jaccard of the five-word sets at least ``SIMILAR``.

    Texts are dealt by the number of their shingles, since sizes more than ``SIMILAR`` apart
    can't be linked; within that prints are compared, as at this radius a vantage point rules
    out none.  Links lie within the groups that prints form, so texts are sent to their group,
    each once, and verified there on the hashes of their shingles; small groups share a task.  A
    large group is cut into blocks of ``MEMBERS`` that each hold its first text too; only
    texts that are not joined with that one then meet the other blocks.  A task returns a row
    for each text, and no link among the candidates is lost.
    """

    @F.pandas_udf("n int, w0 long, w1 long, w2 long, w3 long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        resident(("prints",), dict)  # what the worker held before goes
        for texts in batches:
            yield pd.DataFrame([(n, *w.tolist()) for n, w in map(wide_print, texts)], columns=["n", *BITS])
        hand_back()

    keyed = df.select(F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    one = keyed.select("h", prints("text").alias("p")).groupBy("h").agg(F.min("p").alias("p"))
    size = F.floor(F.log(F.greatest(F.col("p.n"), F.lit(1)).cast("double")) / F.lit(math.log(1 / SIMILAR + 1e-7)))
    classes = checkpoint(one.select("h", "p.*", F.when(F.col("p.n") > 0, size).otherwise(-2).cast("int").alias("band")))
    counts = {r["band"]: r["count"] for r in classes.groupBy("band").count().collect()}  # a row for each band of sizes
    most = max(PART, sum(counts.values()) // PARTS)
    parts = {k: math.ceil(n / most) for k, n in counts.items()}
    if not parts:
        return classes.select("h", F.col("h").alias("component"))
    number = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
    own = F.pmod(F.xxhash64("h"), F.element_at(number, F.col("band"))).cast("int")

    def leaves(first, n, shift: int):
        leaf = lambda k: F.struct((F.col("band") + shift).alias("band"), k.cast("int").alias("part"), (F.lit(shift == 0) & (k == F.col("own"))).alias("home"))
        return F.when(n > first, F.transform(F.sequence(F.lit(first), n - 1), leaf)).otherwise(F.array().cast("array<struct<band:int,part:int,home:boolean>>"))

    above = F.coalesce(F.try_element_at(number, F.col("band") + 1), F.lit(0))
    dealt = classes.withColumn("own", own).withColumn("to", F.explode(F.concat(leaves(0, F.col("own") + 1, 0), leaves(0, above, 1))))
    dealt = dealt.select("to.*", "h", "n", *BITS)
    close = checkpoint(dealt.groupBy("band", "part").applyInPandas(_stars, "a long, b long"))
    groups = components(close).select(F.col("node").alias("h"), F.col("component").alias("comp"))
    groups = checkpoint(groups)
    sizes = groups.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("blocks"))
    packs = max(1, math.ceil(groups.count() / PACK))
    alone = F.col("blocks") == 1
    member = groups.join(sizes, "comp").withColumn("pack", F.when(alone, F.pmod(F.xxhash64("comp"), F.lit(packs))).otherwise(-1 - F.pmod(F.col("comp"), F.lit(1 << 40))))
    member = checkpoint(member.withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")))
    texts = keyed.groupBy("h").agg(F.any_value("text").alias("text"))
    with_texts = lambda ids: ids.join(classes.select("h", "n", *BITS), "h").join(texts, "h")
    blocks = F.when(F.col("h") == F.col("comp"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))  # the first text is in each
    judged = with_texts(member).withColumn("block", F.explode(blocks)).groupBy("pack", "block").applyInPandas(_within, "comp long, h long, to long, settled boolean")
    judged = checkpoint(judged)
    found = judged.where("h <> to").select(F.col("h").alias("a"), F.col("to").alias("b"))
    left = judged.where("NOT settled").select("comp", "h").distinct()
    if not left.isEmpty():
        turns = checkpoint(left.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("turns")))
        # Ids and blocks are laid out by group without the texts, which then meet them by text: no task takes all of a group's texts.
        every = checkpoint(member.join(turns, "comp").drop("pack"))
        asking = every.join(left, ["comp", "h"], "left_semi").withColumns({"turn": F.pmod(F.xxhash64("h", F.lit("turn")), F.col("turns")).cast("int"), "open": F.lit(True)})
        asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        others = every.withColumns({"turn": F.explode(F.sequence(F.lit(0), F.col("turns") - 1)), "open": F.lit(False)})
        met = with_texts(asking.unionByName(others)).groupBy("comp", "turn", "block").applyInPandas(_across, "a long, b long")
        found = found.unionByName(checkpoint(met))
    return components(found).select(F.col("node").alias("h"), "component")


def keep_one_copy(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without all but one of each group of near copies: that of the smallest id, then of a hash of the row.

    A null id comes last; rows are told apart by id and text, so an id with two texts loses only the copied one.
    """
    return _first_rows(df, checkpoint(near_copies(df, text)), doc_id, text, False)
