"""Literal row sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entries(names: list[str], *rows: tuple) -> Column:
    """``array<struct<names>>`` from tuples of columns or plain values, for ``inline``."""
    def col(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return F.array(*[F.struct(*[col(v).alias(n) for n, v in zip(names, row)]) for row in rows])
