"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c: ColumnOrName, default: int = 0) -> Column:
    """to_numeric(errors='coerce').fillna(default).astype(int).

    Goes through DOUBLE because ``try_cast('5.7' as int)`` is NULL, while pandas
    truncates it to 5.
    """
    return F.coalesce(_col(c).try_cast("double"), F.lit(float(default))).cast("bigint")


def clamp_zero(c: ColumnOrName) -> Column:
    """max(x, 0); NULL stays NULL (``greatest`` would skip it)."""
    col = _col(c)
    return F.when(col < 0, F.lit(0).cast("bigint")).otherwise(col)
