"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

Sources share the words of the mix by weight.  Where a share is above the most repetitions of a
source it is clamped there, and what is over goes to the others by weight until none is above.
Every document is then taken as many whole times as its source needs; the rest of the target is
filled in a seeded order with one more repetition of whole documents, and at the end a part of
one.  Expressions only; two numbers for each round of the filling reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.llm.common import WORD, shielded
from sitewise.operators.ordering import cumulative_counts
from sitewise.session import checkpoint

WEIGHTS, MOST, SEED = (5, 2, 1), 3, "mix"
#: Parts into which a source's rows are cut where they meet its target.
SALTS = 64


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def filled(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Add ``target`` to (source, weight, words): the weights' shares of all words, clamped at ``most`` times the source."""
    total = sources.agg(F.sum("words")).first()[0] or 0
    level, before = 0.0, -1
    while True:
        cap = most * F.col("words")
        over = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(F.sum(F.when(over, cap)).alias("c"), F.sum(F.when(~over, F.col("weight"))).alias("w"), F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == before or not row["w"]:
            break
        before, level = row["n"], (total - (row["c"] or 0)) / row["w"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), (most * F.col("words")).cast("double")))


def mix(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED,
        doc_id: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """Add ``source_size``, ``target``, ``whole``, ``extra`` and ``taken`` to every row of ``df``.

    Sources by code point, null last as a source of its own, get the weights in turn.
    ``taken`` = ``whole`` x size + ``extra``; extra is the size for documents early in the
    seeded order, a part of it for one document of a source, else 0.  The words taken from a
    source are its target rounded.  Equal ids are ordered by size, so reruns agree; null ids
    come first.  A null size counts as 0.  Where all sizes are 0 nothing is taken; an empty
    table gives an empty one.  Columns with the added names are replaced.
    """
    added = ["source_size", "target", "whole", "extra", "taken"]
    df, moved, named_back = shielded(df.drop(*(c for c in added if c not in (doc_id, source, size))), ("_size", "_hash", "_point", "_bucket", "_salt", "_edge", "_left", "_run", "_name"))
    doc_id, source, size = (moved.get(c, c) for c in (doc_id, source, size))
    df = df.withColumn("_size", F.coalesce(F.col(size).cast("long"), F.lit(0)))
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    df = df.withColumn("_hash", hashed).withColumn("_point", F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long"))
    thin = checkpoint(df.select(F.col(source).alias("_source"), "_size", "_point"))
    sums = checkpoint(thin.groupBy("_source").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("n")))
    ends = sums.agg(F.max("n").alias("n"), F.count("_source").alias("named")).first()
    buckets = max(1, round((ends["n"] or 0) ** 0.5))  # as many buckets as rows in one
    bucket = F.floor(F.col("_point") * buckets / (1 << 32)).cast("long")
    ranks = cumulative_counts(sums.where("_source IS NOT NULL"), [], ["_source"]).select("_source", "before")
    ranks = ranks.unionByName(sums.where("_source IS NULL").select("_source", F.lit(ends["named"]).cast("long").alias("before")))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    ranked = sums.alias("s").join(ranks.alias("r"), F.col("s._source").eqNullSafe(F.col("r._source")))
    sources = checkpoint(filled(checkpoint(ranked.select("s._source", "words", turn.alias("weight"))), most))
    whole = F.round("target").cast("long")
    sources = sources.select("_source", F.col("words").alias("source_size"), "target",
                             F.when(F.col("words") > 0, F.floor(whole / F.greatest("words", F.lit(1)))).otherwise(0).cast("long").alias("whole"),
                             F.when(F.col("words") > 0, whole % F.greatest("words", F.lit(1))).otherwise(0).alias("_rest"))
    parts = thin.withColumn("_bucket", bucket).groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    running = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_before", F.sum("_sum").over(running) - F.col("_sum"))
    edge = parts.alias("p").join(sources.alias("s"), F.col("p._source").eqNullSafe(F.col("s._source")))
    edge = edge.where("_before <= _rest AND _rest < _before + _sum").select("s._source", F.col("_bucket").alias("_edge"), (F.col("_rest") - F.col("_before")).alias("_left"))
    plan = sources.alias("s").join(edge.alias("e"), F.col("s._source").eqNullSafe(F.col("e._source")), "left")
    plan = plan.select(F.col("s._source").alias("_name"), "source_size", "target", "whole", "_edge", "_left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    plan = checkpoint(plan)
    salted = df.withColumn("_bucket", bucket).withColumn("_salt", F.pmod(F.xxhash64("_hash"), F.lit(SALTS)).cast("int"))
    rows = salted.alias("d").join(plan.alias("p"), F.col(f"d.{source}").eqNullSafe(F.col("p._name")) & (F.col("d._salt") == F.col("p._salt")))
    rows = rows.select(*[F.col(f"d.{c}") for c in df.columns], "_bucket", "source_size", "target", "whole", "_edge", "_left")
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    order = Window.partitionBy(source).orderBy("_hash", doc_id, "_size").rowsBetween(Window.unboundedPreceding, 0)
    part = rows.where(at_edge).withColumn("_run", F.sum("_size").over(order) - F.col("_size"))
    part = part.withColumn("extra", F.greatest(F.lit(0), F.least("_size", F.col("_left") - F.col("_run")))).drop("_run")
    rest = rows.where(~at_edge).withColumn("extra", F.when(F.col("_bucket") < F.col("_edge"), F.col("_size")).otherwise(0))
    both = rest.unionByName(part).withColumn("taken", F.col("whole") * F.col("_size") + F.col("extra"))
    return named_back(both.select(*[c for c in df.columns if c not in ("_size", "_hash", "_point")], *added))


def repeated(mixed: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """One row for each repetition that ``mix`` decided, the last one cut after ``extra`` words where it is a part."""
    mixed, moved, named_back = shielded(mixed, ("_copy",))
    text, size = moved.get(text, text), moved.get(size, size)
    copies = F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)
    rows = mixed.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    cut = (F.col("_copy") > F.col("whole")) & (F.col("extra") < F.col(size))
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("extra").cast("int")), "")
    return named_back(rows.withColumn(text, F.when(cut, head).otherwise(F.col(text))).drop("_copy"))


def oracle(table: str = "documents") -> str:
    """The same in DuckDB's SQL: the level is the first share that its source is not clamped at, sources ordered by what clamps them."""
    turns = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM {table}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {turns} END AS weight FROM s),
r AS (SELECT *, {MOST} * words / weight AS clamp, CAST(sum(words) OVER () AS BIGINT) AS total,
  {MOST} * (sum(words) OVER o - words) AS caps, sum(weight) OVER () - (sum(weight) OVER o - weight) AS weights
  FROM w WINDOW o AS (ORDER BY {MOST} * words / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT coalesce(min_by(CAST(total - caps AS DOUBLE) / CAST(weights AS DOUBLE), clamp) FILTER (WHERE CAST(total - caps AS DOUBLE) / CAST(weights AS DOUBLE) <= clamp), 0) AS level FROM r),
t AS (SELECT source, words, least(weight * level, CAST({MOST} * words AS DOUBLE)) AS target FROM w, l),
c AS (SELECT d.*, words AS source_size, target, CAST(round(target) AS BIGINT) AS goal,
  sum(size) OVER (PARTITION BY d.source ORDER BY md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  goal // source_size * size + greatest(0, least(size, goal % source_size - before)) END AS BIGINT) AS taken FROM c"""
