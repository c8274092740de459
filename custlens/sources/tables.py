"""Parquet table access (S1 in its lake form) and the JDBC reader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<base_dir>/<name>.parquet``; selecting ``columns`` early keeps the
    scan's ReadSchema narrow even before Catalyst prunes."""
    df = spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def jdbc_options(
    url: str,
    query_or_table: str,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """The options of ``read_jdbc``. A query goes in as a subquery: Spark refuses
    its ``query`` option together with a partition column."""
    text = query_or_table.strip().rstrip(";")
    is_query = text.split(None, 1)[0].lower() in ("select", "with") if text else False
    options = {"url": url, "dbtable": f"({text}) q" if is_query else text, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partitioned JDBC reads need lower_bound and upper_bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        }
    return options | (properties or {})


def read_jdbc(spark: SparkSession, url: str, query_or_table: str, **settings) -> DataFrame:
    """Read a database table or query in parallel (replaces fetch-all-rows).

    With ``partition_column`` and bounds (numbers, dates or timestamps) the read
    is split into ``num_partitions`` range queries, one per task; without them a
    single task reads everything, which is only acceptable for small lookups.
    See ``jdbc_options``.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, query_or_table, **settings)).load()


def name_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Assign column names by position (a query result has no names)."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; refuse if two names collide."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"lower-casing makes duplicate column names: {df.columns}")
    return df.toDF(*lowered)
