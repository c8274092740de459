"""The operators of this subpackage over the driver's tables."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.llm import (
    alignment,
    bpe,
    decontamination,
    fm_dedup,
    mixing,
    ngram_join,
    quality,
    secret_scan,
    sharding,
    suffix_dedup,
    token_counts,
    vector_codes,
    warc,
)
from custlens.llm.common import table
from custlens.llm.oracles import ORACLE  # noqa: F401  read by the entry point

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def importable(spark: SparkSession) -> None:
    """Settings of the session that the queries run in.

    Python workers on this machine import the package from any working folder; on a
    cluster it is submitted with the job, as any Python dependency.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    # Whole texts are long rows: this bounds the Arrow batches on both sides.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("mix_id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken")


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.report(table(spark, sf_dir, "documents"))
    rounded = {c: F.round(c, 6) for c in ("class_distance", "word_distance")}
    return found.withColumns(rounded)


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"))


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


@query
def op10_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))
