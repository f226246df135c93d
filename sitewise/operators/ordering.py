"""Exact ranks, quantiles and tiles without a single-task global window.

``cumulative_counts`` is the one primitive: it turns a frame into its distinct
ordered keys with the number of rows before each key.  The keys are range partitioned,
written, and offset by per-partition totals, at any size, so a hot group or value spreads
over many tasks.  Results go back to rows by value; the few values that hold more than a
thousandth of the rows are broadcast, so no task gathers a hot value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.session import checkpoint, kept

#: Rows of a slice of ``bh_adjust``; a value that holds over 1 / HEAVY of all rows is heavy, so there are fewer than HEAVY of them.
SLICE, HEAVY = 100_000, 1000
#: Rows sampled to bracket the ends of tiles, rows between the brackets that are ordered, and distinct values that ranks are broadcast with.
SAMPLE, BETWEEN, BROADCAST = 20_000, 500_000, 500_000


def _ordering(order: list[str]) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


def _names(order: list[str]) -> list[str]:
    return [c.lstrip("-") for c in order]


def cumulative_counts(df: DataFrame, groups: list[str], order: list[str], weight: str | None = None) -> DataFrame:
    """Distinct ``groups + order`` keys with ``cnt``, ``before`` and the group ``total``.

    ``cnt`` is the number of rows, or the sum of ``weight`` when one is named.  Prefix an order column with ``-`` for descending order.  Rows with a NULL order
    value are the caller's business; drop them first when they must not be ranked.
    """
    keys = groups + _names(order)
    counted = df.groupBy(*keys).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("cnt"))
    counted = checkpoint(counted)  # the range bounds are sampled from it before it is dealt
    by_group = Window.partitionBy(*groups)
    ranged = counted.repartitionByRange(*[F.col(g) for g in groups], *_ordering(order))
    parts = checkpoint(ranged.withColumn("part", F.spark_partition_id()))
    # One row per (group, partition) it touches: partitions + groups rows.
    sums = parts.groupBy(*groups, "part").agg(F.sum("cnt").alias("part_cnt"))
    before_part = by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("offset", F.sum("part_cnt").over(before_part) - F.col("part_cnt")).withColumn(
        "total", F.sum("part_cnt").over(by_group)
    )
    inner = Window.partitionBy(*groups, "part").orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        parts.join(sums.drop("part_cnt"), groups + ["part"])
        .withColumn("before", F.sum("cnt").over(inner) - F.col("cnt") + F.col("offset"))
        .drop("part", "offset")
    )


def quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles; one row per group, one column per entry of ``probs``."""
    keys = cumulative_counts(df.where(F.col(value).isNotNull()), groups, [value])
    aggs, outs = [], []
    for name, p in probs.items():
        h = (F.col("total") - 1) * F.lit(float(p))
        for tag, idx in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            inside = (F.col("before") <= idx) & (idx < F.col("before") + F.col("cnt"))
            aggs.append(F.max(F.when(inside, F.col(value))).alias(f"_{name}_{tag}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_{name}_f"))
        lo, hi, f = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_f")
        outs.append((lo + (hi - lo) * f).alias(name))
    agged = keys.groupBy(*groups).agg(*aggs) if groups else keys.agg(*aggs)
    return agged.select(*groups, *outs)


def tile_bounds(df: DataFrame, order: list[str], tiles: int) -> tuple[list[str], list]:
    """Last key of every tile but those that are empty (at most ``tiles`` rows and ``SAMPLE`` sampled ones reach the driver at once); ascending order.

    The end of a tile is bracketed by two keys of a sample; rows below the brackets are counted
    without a shuffle, and a bracket that does not hold its end is taken back.  This is repeated
    until few rows lie between; only those are ordered.
    """
    names = _names(order)
    known = df.where(F.col(names[0]).isNotNull()).select(*names)
    types = {f.name: f.dataType for f in known.schema.fields}
    key = F.struct(*names)
    at = lambda k: F.struct(*[F.lit(v).cast(types[n]).alias(n) for n, v in zip(names, k)])
    total = known.count()
    size, rem = divmod(total, tiles)
    ends = {t: min(t + 1, rem) * (size + 1) + max(0, t + 1 - rem) * size - 1 for t in range(tiles) if size or t < rem}
    if not ends:
        return names, []
    # Of each end: the brackets (exclusive below, inclusive above; None is open), rows before them and rows in them.
    found = {t: (None, None, 0, total) for t in ends}

    def inside(low, high):
        return (F.lit(True) if low is None else key > at(low)) & (F.lit(True) if high is None else key <= at(high))

    for _ in range(8):
        if sum(n for *_, n in dict.fromkeys(found.values())) <= BETWEEN:
            break
        spans = list(dict.fromkeys(f[:2] for f in found.values()))
        some = known.where(reduce(lambda a, b: a | b, [inside(*b) for b in spans]))
        drawn = some.orderBy(F.rand(1)).limit(SAMPLE).orderBy(*names)
        flags = [inside(*b).alias(f"_in{k}") for k, b in enumerate(spans)]
        sample = [(tuple(r[: len(names)]), r[len(names) :]) for r in drawn.select(*names, *flags).collect()]
        narrow = {}
        for t, (low, high, before, n) in found.items():
            keys = [k for k, own in sample if own[spans.index((low, high))]]
            if not keys:
                continue
            share = (ends[t] - before + 0.5) / n
            place, margin = share * len(keys), 4 * (len(keys) * share * (1 - share)) ** 0.5 + 2
            a, b = int(place - margin) - 1, int(place + margin) + 1
            narrow[t] = (keys[a] if a >= 0 else low, keys[b] if b < len(keys) else high)
        counts = [c for t, (low, high) in narrow.items() for c in (F.count_if(~inside(low, None)) if low is not None else F.lit(0), F.count_if(inside(low, high)))]
        got = known.agg(F.count(F.lit(1)), *[c.alias(f"c{k}") for k, c in enumerate(counts)]).first()[1:]
        for k, (t, b) in enumerate(narrow.items()):
            before, n = got[2 * k], got[2 * k + 1]
            if before <= ends[t] < before + n:
                found[t] = (*b, before, n)
    tile = F.array(*[F.when(inside(low, high), F.lit(t)) for t, (low, high, *_) in found.items()])
    rows = known.select(F.explode(F.filter(tile, lambda x: x.isNotNull())).alias("_tile"), *names)
    keys = cumulative_counts(rows, ["_tile"], order)
    place = F.create_map(*[F.lit(x) for t, (_, _, before, _) in found.items() for x in (t, ends[t] - before)])[F.col("_tile")]
    cuts = keys.where((F.col("before") <= place) & (place < F.col("before") + F.col("cnt"))).select(F.col("_tile").alias("tile"), key.alias("k"))
    return names, [(r["tile"], tuple(r["k"])) for r in cuts.orderBy("tile").limit(tiles).collect()]


def ntile(df: DataFrame, order: list[str], tiles: int, out: str) -> DataFrame:
    """Add the 1-based tile of each row under a total ascending order; NULL stays NULL.

    Only the order columns are shuffled.  The rows themselves are labelled by
    comparing with the tile bounds, a narrow expression.
    """
    names, bounds = tile_bounds(df, order, tiles)
    key = F.struct(*names)
    label = F.lit(None).cast("int")
    types = {f.name: f.dataType for f in df.schema.fields}
    for i, (tile, values) in enumerate(bounds):
        bound = F.struct(*[F.lit(v).cast(types[n]).alias(n) for n, v in zip(names, values)])
        last = i == len(bounds) - 1
        cond = F.lit(True) if last else key <= bound
        label = F.when(cond, F.lit(int(tile) + 1)) if i == 0 else label.when(cond, F.lit(int(tile) + 1))
    return df.withColumn(out, F.when(F.col(names[0]).isNull(), F.lit(None)).otherwise(label).cast("int"))


def decile_score(df: DataFrame, order: list[str], out: str, lower_better: bool = True) -> DataFrame:
    """Decile score in [0, 1]: first decile scores 1 when lower is better, 0 otherwise."""
    df = ntile(df, order, 10, "_tile")
    score = (F.col("_tile") - 1) / 9
    return df.withColumn(out, 1 - score if lower_better else score).drop("_tile")


def _attach(df: DataFrame, keys: DataFrame, on: list[str], value: str) -> DataFrame:
    """``df`` (written) left-joined with ``keys`` on ``on``; ``keys`` has ``cnt``, which is dropped.

    Heavy values are joined by broadcast, NULL values not at all, the rest by shuffle.
    """
    keys = checkpoint(keys)
    n = keys.agg(F.sum("cnt")).first()[0] or 0
    heavy = F.broadcast(keys.where(F.col("cnt") * HEAVY > n).drop("cnt"))
    light = keys.where(F.col("cnt") * HEAVY <= n).drop("cnt")
    known = df.where(F.col(value).isNotNull())
    new = [F.lit(None).cast(f.dataType).alias(f.name) for f in light.schema.fields if f.name not in on]
    out = known.join(heavy, on).unionByName(known.join(heavy.select(on), on, "left_anti").join(light, on, "left"))
    return out.unionByName(df.where(F.col(value).isNull()).select("*", *new))


def average_rank(df: DataFrame, value: str, out: str, groups: list[str] | None = None, descending: bool = False) -> DataFrame:
    """Average rank over ties, 1-based; NULL values keep a NULL rank."""
    groups = groups or []
    order = ["-" + value] if descending else [value]
    df = checkpoint(df)
    keys = cumulative_counts(df.where(F.col(value).isNotNull()), groups, order)
    ranks = keys.select(*groups, value, "cnt", (F.col("before") + (F.col("cnt") + 1) / 2).alias(out))
    return _attach(df, ranks, groups + [value], value)


def min_rank(df: DataFrame, value: str, out: str, groups: list[str] | None = None, descending: bool = False) -> DataFrame:
    """Smallest rank over ties plus the group size in ``<out>_n``."""
    groups = groups or []
    order = ["-" + value] if descending else [value]
    df = checkpoint(df)
    keys = cumulative_counts(df.where(F.col(value).isNotNull()), groups, order)
    ranks = keys.select(*groups, value, "cnt", (F.col("before") + 1).alias(out), F.col("total").alias(out + "_n"))
    return _attach(df, ranks, groups + [value], value)


def rank_norm(df: DataFrame, value: str, out: str) -> DataFrame:
    """(average rank - 1) / (largest rank - 1)."""
    ranked = average_rank(df, value, "_r")
    top = ranked.agg(F.max("_r").alias("_top"))
    return ranked.join(F.broadcast(top)).withColumn(out, (F.col("_r") - 1) / (F.col("_top") - 1)).drop("_r", "_top")


def average_ranks(df: DataFrame, cols: list[str], prefix: str = "rank_", descending: bool = False) -> DataFrame:
    """Average ranks of several columns from one shared sort; NULL values keep a NULL rank.

    Values go long once, counted before the shuffle.  Up to ``BROADCAST`` distinct values return to
    rows by broadcast, a column after the other; more meet the rows in one join and one
    aggregation, whatever the number of columns.
    """
    rows = kept(df.withColumn("_id", F.monotonically_increasing_id()))
    cells = F.inline(F.array(*[F.struct(F.lit(k).cast("byte").alias("col"), F.col(c).cast("double").alias("v")) for k, c in enumerate(cols)]))
    long = rows.select("_id", cells).where("v IS NOT NULL")
    keys = cumulative_counts(long, ["col"], ["-v" if descending else "v"])
    ranks = kept(keys.select("col", "v", "cnt", (F.col("before") + (F.col("cnt") + 1) / 2).alias("r")))
    if ranks.count() <= BROADCAST:
        out = rows.drop("_id")
        for k, c in enumerate(cols):
            own = ranks.where(F.col("col") == k).select(F.col("v").alias("_v"), F.col("r").alias(prefix + c))
            out = out.join(F.broadcast(own), F.col(c).cast("double") == F.col("_v"), "left").drop("_v")
        return out
    wide = _attach(long, ranks, ["col", "v"], "v").groupBy("_id").agg(
        *[F.max(F.when(F.col("col") == k, F.col("r"))).alias(prefix + c) for k, c in enumerate(cols)])
    return rows.join(wide, "_id", "left").drop("_id")


def bh_adjust(df: DataFrame, p: str, groups: list[str], out: str = "fdr") -> DataFrame:
    """Benjamini-Hochberg adjustment of ``p`` inside each group.

    ``min over larger p of p * m / rank``.  The running minimum works on distinct
    p-values cut into ordered slices, so no task sees more than one slice.
    """
    df = checkpoint(df)
    keys = cumulative_counts(df.where(F.col(p).isNotNull()), groups, [p])
    keys = keys.withColumn("_q", F.col(p) * F.col("total") / (F.col("before") + F.col("cnt")))
    keys = keys.withColumn("_slice", F.floor(F.col("before") / SLICE))
    later = Window.partitionBy(*groups).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    slices = keys.groupBy(*groups, "_slice").agg(F.min("_q").alias("_m"))
    slices = slices.withColumn("_later", F.min("_m").over(later)).drop("_m")
    inside = Window.partitionBy(*groups, "_slice").orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    adj = keys.join(slices, groups + ["_slice"]).withColumn("_own", F.min("_q").over(inside))
    adj = adj.select(*groups, p, "cnt", F.least(F.col("_own"), F.col("_later"), F.lit(1.0)).alias(out))
    return _attach(df, adj, groups + [p], p)


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row (read once, planned as literals)."""
    row = one_row.limit(1).collect()
    values = row[0].asDict() if row else {}
    types = {f.name: f.dataType for f in one_row.schema.fields}
    return df.select("*", *[F.lit(values.get(n)).cast(t).alias(n) for n, t in types.items()])


def top_share(df: DataFrame, value: str, share: float) -> DataFrame:
    """Rows at or above the ``1 - share`` quantile."""
    df = checkpoint(df)
    thr = quantiles(df, [], value, {"_thr": 1 - share})
    return attach_scalars(df, thr).where(F.col(value) >= F.col("_thr")).drop("_thr")


def top_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows of a total order (take-ordered, no full sort)."""
    return df.orderBy(*_ordering(order)).limit(n)
