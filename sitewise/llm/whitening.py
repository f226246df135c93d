"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred table.

With X the centred rows, each step applies X to the newest right vector and its transpose to
the newest left vector, and makes both orthogonal to all earlier ones, twice.  Left vectors
are as long as the table; they are not stored but kept as the combination of X's columns
that makes them (u = X c), so that one pass over the rows gives both products: a row's entry of
u and its share of X'u are added up in the task that holds the row.  The tasks' sums meet in a
grouped sum by column; a vector as long as a row reaches the driver in each step, nothing else
does.  X V = U B then holds with a small bidiagonal B, whose singular value decomposition
gives the components and their deviations.  All columns are gone through, so nothing is left to
converge and equal deviations are told apart; where a step ends in an invariant subspace the
next starts from a seeded random vector outside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.session import checkpoint

SEED = 20240229
#: Bytes of centred rows that one stored block holds, and blocks' bytes in a partition.
BLOCK, PARTITION = 4 << 20, 32 << 20
#: Below this share of the first one a deviation is rounding.
RANK = 1e-12


@dataclass
class Whitening:
    """``sums``: exact, by column; ``components``: rows, by falling ``variances`` (of the whole, divisor n)."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, x): long entries floor(scale * c) + shift of the usable vectors of the most frequent length (of ties the longest).

    Dropped: null vectors, those with a null or non-finite entry or one beyond 2**52 / scale,
    which has no exact place, those of other lengths, empty ones.
    """
    rows = df.where(usable(vector) & (F.size(vector) > 0)).select(F.col(vec_id).alias("vec_id"), F.transform(vector, lambda c: c.cast("double") * scale).alias("c"))
    exact = F.transform("c", lambda c: F.when(F.abs(c) <= float(1 << 52), F.floor(c).cast("long") + F.lit(shift).cast("long")))
    rows = rows.select("vec_id", exact.alias("x")).where(~F.exists("x", lambda x: x.isNull()))
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    return rows.where(F.size("x") == dim)


def sums(rows: DataFrame, vector: str = "x") -> tuple[int, list[int]]:
    """Number of rows and exact sums by column."""
    found = rows.select(F.posexplode(vector).alias("k", "v")).groupBy("k").agg(F.count("v").alias("n"), F.sum("v").cast("string").alias("s")).collect()
    found.sort(key=lambda r: r["k"])
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found]


def _blocks(rows: DataFrame, n: int, total: list[int]) -> DataFrame:
    """(x): centred rows, many to a block of bytes, written for the passes over them."""
    dim, most = len(total), max(1, BLOCK // (8 * len(total)))
    mean = centre(n, total)

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["x"])

        for part in parts:
            x = mean(part.column("x"), dim)
            for k in range(0, len(x), most):
                held.append(x[k : k + most])
                if sum(map(len, held)) >= most:
                    yield out()
                    held = []
        if held:
            yield out()

    spread = max(1, -(-8 * n * dim // PARTITION))
    return checkpoint(rows.select("x").coalesce(spread).mapInArrow(pack, "x binary"))


def centre(n: int, total: list[int]):
    """x - S / n, from whole numbers where they fit: what is large in both goes before anything is rounded."""
    whole = np.array([s // n for s in total], np.int64)
    part = np.array([s % n for s in total], np.float64) / n

    def centred(column: pa.Array, dim: int) -> np.ndarray:
        return (column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) - whole).astype(np.float64) - part

    return centred


def _reduced(blocks: DataFrame, of, size: int) -> np.ndarray:
    """Sum over the blocks of ``of(block)``, an array of ``size`` numbers."""

    def part(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for p in parts:
            for b in p["x"]:
                total += of(np.frombuffer(b, np.float64))
        yield pd.DataFrame({"k": np.arange(size), "v": total})

    found = blocks.mapInPandas(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["k"]] = r["v"]
    return out


def _apart(v: np.ndarray, others: np.ndarray) -> np.ndarray:
    """v without its parts along the rows of ``others``, taken off twice."""
    for _ in range(2):
        v = v - others.T @ (others @ v)
    return v


def bidiagonal(product, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): rows of V are right vectors, X V' = U B for some U with orthonormal columns.

    ``product(c)`` is X'X c.  C holds the combinations c of the left vectors X c, G their X'X c.
    """
    rng = np.random.default_rng(SEED)
    right, left, gone = np.zeros((0, dim)), np.zeros((0, dim)), np.zeros((0, dim))
    b = np.zeros((dim, dim))
    scale, new = 0.0, None
    for j in range(dim):
        if new is None:
            new = _apart(rng.normal(size=dim), right)
            new /= np.linalg.norm(new)
            new = _apart(new, right)
        v = new / np.linalg.norm(new)
        right = np.vstack([right, v])
        c, g = v, product(v)
        first = np.sqrt(max(0.0, c @ g))
        scale = max(scale, first)
        for _ in range(2):  # X c without its parts along the left vectors
            along = gone @ c
            b[: len(left), j] += along
            c, g = c - left.T @ along, g - gone.T @ along
        alpha = np.sqrt(max(0.0, c @ g))
        if alpha <= RANK * scale or alpha == 0:  # X v lies among the left vectors
            new = None
            continue
        k = len(left)
        b[k, j] = alpha
        left, gone = np.vstack([left, c / alpha]), np.vstack([gone, g / alpha])
        new = _apart(gone[k], right)
        if np.linalg.norm(new) <= RANK * scale:
            new = None
    return right, b[: len(left)]


def fit(rows: DataFrame, n: int, total: list[int], vector: str = "x", most: int = 32) -> tuple[Whitening, DataFrame]:
    """The model of at most ``most`` components, and the centred blocks that later passes read.

    Components whose variance is nothing but rounding are left out: rows that do not differ
    have none.
    """
    dim = len(total)
    blocks = _blocks(rows.select(F.col(vector).alias("x")), n, total)

    def product(c: np.ndarray) -> np.ndarray:
        def of(b):
            x = b.reshape(-1, dim)
            return (x @ c) @ x

        return _reduced(blocks, of, dim)

    right, b = bidiagonal(product, dim)
    _, deviations, turned = np.linalg.svd(b, full_matrices=False) if len(b) else (None, np.zeros(0), np.zeros((0, dim)))
    trace = float((deviations**2).sum()) / n
    kept = min(most, int((deviations > RANK * dim * max(deviations, default=0)).sum()))
    components = turned[:kept] @ right
    return Whitening(n, total, components / np.linalg.norm(components, axis=1, keepdims=True), deviations[:kept] ** 2 / n, trace), blocks


def identity_error(model: Whitening, blocks: DataFrame) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    k = len(model.variances)
    if not k:
        return 0.0
    turn = (model.components / np.sqrt(model.variances)[:, None]).T

    def of(b):
        w = b.reshape(-1, len(turn)) @ turn
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    found = _reduced(blocks, of, k * k + k) / model.n
    return float(np.abs(found[: k * k].reshape(k, k) - np.outer(found[k * k :], found[k * k :]) - np.eye(k)).max())


def whitened(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "x") -> DataFrame:
    """(vec_id, whitened): an array of a number for each component, of every row, repeated ones too."""
    dim, turn = len(model.sums), (model.components / np.sqrt(model.variances)[:, None]).T
    kind = dict(rows.dtypes)[vec_id]
    mean = centre(model.n, model.sums)

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            w = mean(part.column("x"), dim) @ turn
            at = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.ListArray.from_arrays(at, pa.array(w.ravel()))], ["vec_id", "whitened"])

    return rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("x")).mapInArrow(apply, f"vec_id {kind}, whitened array<double>")


def deviation(n: int, total: list[int], vector: str = "x") -> Column:
    """Sum over the columns of (n * x - S)^2, exact; null where it is no long."""
    s = F.array(*[F.lit(str(t)).cast("decimal(38,0)") for t in total])
    wide = F.zip_with(vector, s, lambda x, t: x.cast("decimal(38,0)") * F.lit(n).cast("decimal(19,0)") - t)
    return F.aggregate(F.transform(wide, lambda d: d.cast("decimal(19,0)") * d.cast("decimal(19,0)")), F.lit(0).cast("decimal(38,0)"), lambda a, d: (a + d).cast("decimal(38,0)")).try_cast("long")


def table(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector and component.

    Vectors are quantised first (``quantised`` says which are dropped).  Repeated rows, equal
    vectors and null ids are rows like others.  No rows, or rows that do not differ, give none.
    ``deviation`` is null where it exceeds a long.
    """
    rows = quantised(df, vec_id, vector)
    n, total = sums(rows)
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    model, blocks = fit(rows, n, total, most=most)
    if not len(model.variances):
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(model, blocks)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.variances])
    given = rows.select(F.struct("vec_id", deviation(n, total).alias("deviation")).alias("vec_id"), "x")
    out = whitened(given, model).select("vec_id", F.posexplode("whitened").alias("k", "w"))
    return out.select("vec_id.vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "vec_id.deviation", F.col("w").alias("whitened"),
                      F.element_at(share, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))
