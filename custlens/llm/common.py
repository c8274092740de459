"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.session import scratch_path

# The six white-space characters that separate words.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files), and Spark's planner then
    knows the table's size, so that its own threshold decides on broadcasts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_at = path
    return found


def unstage(*tables: DataFrame) -> None:
    """Delete tables of ``stage`` whose last reader has written its own result."""
    for t in tables:
        spark = t.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(t.staged_at)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Catalyst copies an expression into each place that uses it, also into a
    lambda that runs per array element; a lambda variable is evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The maximal runs of other than the six white-space characters, in order."""
    spaced = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE_SPACE[1:]:  # a split at a plain blank needs no pattern matcher
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")
