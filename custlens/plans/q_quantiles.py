"""Registered queries of the order statistics on continuous columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.operators.quantiles import box_summary, continuous_summary, exact_quantiles, group_summary
from custlens.plans.registry import query
from custlens.sources.tables import read_table


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(
    "price_summary",
    """
WITH v AS (SELECT 'l_extendedprice' AS column_name, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem
           UNION ALL SELECT 'l_quantity', CAST(l_quantity AS DOUBLE) FROM lineitem),
c AS (SELECT column_name, x, count(*) AS n FROM v WHERE x IS NOT NULL GROUP BY ALL),
m AS (SELECT column_name, arg_min(x, {'n': -n, 'x': x}) AS mode FROM c GROUP BY column_name)
SELECT column_name, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median, any_value(mode) AS mode,
       min(x) AS min, max(x) AS max
FROM v JOIN m USING (column_name) GROUP BY column_name""",
)
def q_price_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A10 over a continuous and a whole-number column of all lines, by distributed selection."""
    lines = read_table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    return _rounded(continuous_summary(lines, ["l_extendedprice", "l_quantity"]), "mean", "median")


@query(
    "price_stats",
    """
SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 6) AS mean, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
       min(l_extendedprice) AS min, max(l_extendedprice) AS max
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY ALL""",
)
def q_price_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A6 / A11 of a continuous column: exact median price per return flag and line status."""
    lines = read_table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return _rounded(group_summary(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice"), "mean", "median")


@query(
    "price_box",
    """
WITH q AS (
  SELECT l_linestatus, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_linestatus),
b AS (SELECT *, q3 - q1 AS iqr FROM q)
SELECT b.l_linestatus, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr) AS whisker_low,
       max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr) AS whisker_high,
       count(*) FILTER (WHERE l_extendedprice NOT BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr) AS outliers,
       round(any_value(iqr), 6) AS iqr
FROM lineitem l JOIN b ON l.l_linestatus IS NOT DISTINCT FROM b.l_linestatus
WHERE l_extendedprice IS NOT NULL GROUP BY b.l_linestatus""",
)
def q_price_box(spark: SparkSession, sf: str) -> DataFrame:
    """A23 of a continuous column: box-plot numbers of the price per line status."""
    lines = read_table(spark, sf, "lineitem").select("l_linestatus", "l_extendedprice")
    return _rounded(box_summary(lines, ["l_linestatus"], "l_extendedprice"), "q1", "median", "q3", "iqr")


@query(
    "price_percentiles",
    """
SELECT l_suppkey, count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01,
       round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_suppkey""",
)
def q_price_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact tail percentiles of many groups in the same rounds: prices per supplier."""
    lines = read_table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    found = exact_quantiles(lines, ["l_extendedprice"], [0.01, 0.9, 0.99], ["l_suppkey"])
    q = F.col("quantiles")
    return found.select("l_suppkey", "n", *[F.round(q[i], 6).alias(c) for i, c in enumerate(("p01", "p90", "p99"))])
