"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` plus, where the
result is SQL-expressible, the equivalent DuckDB SQL over the same tables.

Money and other floating results are rounded at the edge, on both sides, so
the order of floating additions cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name`` with its optional oracle SQL."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from custlens.plans import (  # noqa: F401
        q_churn,
        q_cohort,
        q_kpi,
        q_quality,
        q_quantiles,
        q_segments,
        q_text,
    )


def edge(df: DataFrame, doubles: tuple[str, ...] = ()) -> DataFrame:
    """Normalise a query result for cross-engine comparison.

    DATE columns are reported as midnight TIMESTAMP_NTZ (DuckDB hands DATE to
    pandas as a timestamp) and integer columns that can hold NULL are reported
    as DOUBLE (pandas has no NULL-able int64 for Spark's result). The oracle SQL
    casts the same columns to DOUBLE.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType

    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in doubles:
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)
