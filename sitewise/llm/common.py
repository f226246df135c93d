"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One run of characters that are no ASCII white space, as Spark's and DuckDB's engines read it.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def sampled(labels: DataFrame, key: str, label: str, rows: int, salt: str) -> DataFrame:
    """(key, label) of about ``rows`` labelled rows, picked by a hash of the key: small enough to broadcast at any size of input.

    Rows with a null key or label are left out.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).cast("int").alias("_label"))
    share = min(1.0, rows / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(salt)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


_RESIDENT: dict = {}


def resident(key: tuple, make: Callable):
    """``make()``, kept for the next tasks of this Python worker; another key lets go of it, so a worker holds one model."""
    if key not in _RESIDENT:
        if _RESIDENT:
            _RESIDENT.clear()
            hand_back()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def hand_back() -> None:
    """Give memory that nothing holds any more back to the system: cycles, Arrow's pool, free pages of the C library where it can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shielded(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``df`` without columns of the given working names, their new names, and what names them back in a result."""
    own, taken = {n.lower() for n in names}, {c.lower() for c in df.columns}
    moved: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in own:
            new = f"{c}_"
            while new.lower() in own | taken:
                new += "_"
            taken.add(new.lower())
            moved[c] = new
    back = {v: k for k, v in moved.items()}
    return df.withColumnsRenamed(moved), moved, lambda out: out.withColumnsRenamed(back)


class Recent:
    """A bounded memo for ``make(key)``: two generations of at most ``size`` entries each."""

    def __init__(self, make: Callable, size: int):
        self.make, self.size, self.new, self.old = make, size, {}, {}

    def __getitem__(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(self.new) >= self.size:
                self.old, self.new = self.new, {}
            self.new[key] = value
        return value
