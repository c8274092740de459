"""Operators shared by several reports: first row per key (A9), preview (O2),
null profile (A25), value counts (A13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep one row per key — the first by a *total* ``order``.

    ``order`` holds plain value columns compared ascending, left to right
    (NULL sorts first; put ``col.isNull()`` ahead of a column to sort its NULLs
    last).

    Written as an aggregate (``min_by`` over a struct of the row) rather than
    ``row_number()`` over a window: the aggregate combines map-side, so one
    hot key never lands whole in a single task.
    """
    value_cols = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in value_cols]), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in value_cols])


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """O2: the first ``n`` rows under a *total* order (``head()`` of a frame
    whose row order pandas keeps implicitly). Spark plans it as a top-k:
    each task keeps its own n best rows before one small merge."""
    return df.orderBy(*order).limit(n)


def value_counts(df: DataFrame, cols: list[str], name: str = "n") -> DataFrame:
    """Row count per value (combination), largest first."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), *[F.asc_nulls_last(c) for c in cols])


def null_profile(df: DataFrame) -> DataFrame:
    """Per column its type and NULL count, one pass, long form."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stacked = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(c).alias("null_count"))
                    for c in df.columns
                ]
            )
        )
    )
    return stacked.select("column_name", "data_type", F.col("null_count").cast("bigint"))
