"""A corpus pipeline of the operators in ``custlens.llm``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes what a stage
returns as Parquet to the shared folder and gives the reread table to the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from custlens.llm import decontamination, mixing, ngram_join, quality, sharding
from custlens.llm.common import stage, table
from custlens.llm.queries import importable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id."""
    importable(spark)
    return ngram_join.one_of_each(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    importable(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    importable(spark)
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard."""
    return sharding.place(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Random rounding and component search have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
