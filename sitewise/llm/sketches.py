"""Document fingerprints: every shingle hash below a fixed share of the hash range.

The sketch of a text is the set of those hashes, so its size follows the text's, sketches of
parts merge by union, and the share of a small text's sketch that lies in a large one's
estimates containment however unequal the two are.  Expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.session import checkpoint

SHINGLE, ONE_IN = 5, 8
#: Ids that share a block: the width of a window in ascending order.
BITS = 6


def sketch(text: Column, one_in: int = ONE_IN) -> Column:
    """Sorted distinct XXH64 values of 5-word shingles in the lowest 1/``one_in`` of the range; shorter texts are one shingle, none without words."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    top = -(1 << 63) + (1 << 64) // one_in

    def hashes(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.filter(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])), lambda h: h < F.lit(top))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.array(words), hashes))))  # the outer array binds the words once


def merged(sketches: Column) -> Column:
    """Sketch of all texts of an array of sketches."""
    return F.array_sort(F.array_distinct(F.flatten(sketches)))


def as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def containment(a: Column, b: Column) -> Column:
    """Share of ``a`` in ``b``; null if ``a`` is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Resemblance of the shingle sets, 0 to 1; of two empty sketches 1."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1)))


def next_values(values: DataFrame, column: str) -> DataFrame:
    """(column, next) of distinct integers: the next larger one, null for the largest; in blocks of blocks, never one window over all."""
    ends = values.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
    if ends["a"] is None:
        return values.select(column, F.col(column).alias("next"))

    def level(v: DataFrame, a: int, b: int) -> DataFrame:
        last = {a >> BITS, b >> BITS} <= {-1, 0} or a >> BITS == b >> BITS  # at most two blocks are left
        up = v.select("x", (F.lit(0) if last else F.shiftright("x", BITS)).alias("up"))
        inside = up.withColumn("next", F.lead("x").over(Window.partitionBy("up").orderBy("x")))
        if last:
            return inside.select("x", "next")
        firsts = checkpoint(up.groupBy("up").agg(F.min("x").alias("first")))  # a block each, used twice
        after = level(firsts.select(F.col("up").alias("x")), a >> BITS, b >> BITS)
        heads = after.join(firsts, F.col("next") == F.col("up"), "left").select(F.col("x").alias("of"), "first")
        return inside.join(heads, F.col("up") == F.col("of"), "left").select("x", F.coalesce("next", "first").alias("next"))

    return level(values.select(F.col(column).alias("x")), ends["a"], ends["b"]).select(F.col("x").alias(column), "next")


def with_next(df: DataFrame, order: str, carried: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the row with the next larger integer id, after the last the first's.

    The rows are shuffled once, by blocks of 64 ids; only the last row of each block looks
    for the first row of the next, and all three uses below read the same shuffle.  A null id has no next row.  Rows that repeat an id follow
    each other in the order of their values' hashes.
    """
    tied = df.withColumn("_block", F.coalesce(F.shiftright(F.col(order).cast("long"), BITS), F.lit(0))).withColumn("_tie", F.xxhash64(*carried))
    by = Window.partitionBy("_block").orderBy(order, "_tie")
    # Plain columns in every window, so that the shuffle below holds no copies and is the same for each use; sketches come after it.
    placed = tied.where(F.col(order).isNotNull()).withColumns({f"next_{c}": F.lead(c).over(by) for c in carried} | {"_after": F.lead(order).over(by), "_before": F.lag(order).over(by)})
    blocks = next_values(df.where(F.col(order).isNotNull()).select(F.shiftright(F.col(order).cast("long"), BITS).alias("_at")).distinct(), "_at")
    first = blocks.agg(F.min("_at").alias("_first"))
    after = blocks.join(F.broadcast(first)).select("_at", F.coalesce("next", "_first").alias("_to"))  # one row is broadcast
    heads = placed.where("_before IS NULL").select(F.col("_block").alias("_of"), *[F.col(c).alias(f"head_{c}") for c in carried])
    heads = heads.join(after, F.col("_of") == F.col("_to")).select("_at", *[f"head_{c}" for c in carried])
    names = [f"next_{c}" for c in carried]
    inside = placed.where("_after IS NOT NULL").select(*df.columns, *names)
    ends = placed.where("_after IS NULL").select(*df.columns, "_block").join(heads, F.col("_block") == F.col("_at"))
    ends = ends.select(*df.columns, *[F.col(f"head_{c}").alias(f"next_{c}") for c in carried])
    null = df.where(F.col(order).isNull()).withColumns({f"next_{c}": F.lit(None).cast(df.schema[c].dataType) for c in carried})
    return inside.unionByName(ends).unionByName(null.select(*df.columns, *names))


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", one_in: int = ONE_IN) -> DataFrame:
    """Fingerprint of every whole text, of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by the first as many of the
    next document by id (after the last: the first; the only one: itself).  Null texts are
    empty.  Texts whose sketches are both empty have likeness 1 if they are equal and else 0;
    a null id has no next document, so nothing is put in place of its half and its
    ``near_next`` is null.  Repeated rows are each returned.
    """
    own = F.col(doc_id)
    base = df.select(own if doc_id == "doc_id" else own.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = with_next(base, "doc_id", ["text"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left(F.coalesce("next_text", F.lit("")), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), sketch(F.col("text"), one_in).alias("sketch"),
                       F.when(F.col("next_text").isNotNull(), sketch(F.col("next_text"), one_in)).alias("next_sketch"), (edited == F.col("text")).alias("same"), (F.col("next_text") == F.col("text")).alias("same_next"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), one_in))

    def near(other: str, same: str) -> Column:
        return F.when(F.size("sketch") + F.size(other) == 0, F.col(same).cast("double")).otherwise(likeness(F.col("sketch"), F.col(other)))

    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        near("edited_sketch", "same").alias("near_edited"), near("next_sketch", "same_next").alias("near_next"),
        F.size("sketch").alias("n_hashes"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("in_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("in_next"),
    )
