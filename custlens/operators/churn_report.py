"""The churn report set (C15): counts, shares, cross-tabs, value, money,
boxes, and the interval statistics behind the notebook's charts
(A10–A17, A20–A25).

Every statistic is an aggregate with map-side combine. Exact median, mode and
quartiles use Spark's counting aggregates (``median``, ``percentile``,
``mode``), whose state is one counter per *distinct value* rather than one
entry per row; day counts have few distinct values, so a product holding a
third of all rows costs no more memory than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.operators.churn import LABELS
from custlens.operators.common import value_counts
from custlens.session import staged


def restrict_products(labelled: DataFrame, products: list[str] | None, product_col: str = "product") -> DataFrame:
    """Keep the listed products (all when None)."""
    return labelled if products is None else labelled.filter(F.col(product_col).isin(list(products)))


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows per label, largest first."""
    return value_counts(labelled, ["churn"], "n")


def label_counts_by_product(labelled: DataFrame, product_col: str = "product") -> DataFrame:
    """Rows per (product, label), long form."""
    return labelled.groupBy(product_col, "churn").agg(F.count(F.lit(1)).alias("n"))


def label_share(labelled: DataFrame, product_col: str = "product") -> DataFrame:
    """Percentage of each label within its product; absent labels are
    absent rows."""
    counts = label_counts_by_product(labelled, product_col)
    total = F.sum("n").over(Window.partitionBy(product_col))
    return counts.withColumn("percentage", F.col("n") / total * 100)


def label_crosstab(labelled: DataFrame, product_col: str = "product") -> DataFrame:
    """Product × label counts, 0-filled. The label list is fixed, so the
    pivot needs no extra job to discover its columns."""
    return labelled.groupBy(product_col).pivot("churn", list(LABELS)).count().fillna(0, subset=list(LABELS))


def label_share_dense(labelled: DataFrame, product_col: str = "product") -> DataFrame:
    """Row-normalised cross-tab back in long form, zeros kept."""
    wide = label_crosstab(labelled, product_col)
    total = sum((F.col(x) for x in LABELS), F.lit(0))
    long = wide.select(
        product_col,
        total.alias("_total"),
        F.inline(F.array(*[F.struct(F.lit(x).alias("churn"), F.col(x).alias("n")) for x in LABELS])),
    )
    return long.select(product_col, "churn", (F.col("n") / F.col("_total") * 100).alias("percentage"))


def label_value(labelled: DataFrame, prices: DataFrame, product_col: str = "product") -> DataFrame:
    """Label count × unit price (J8; unknown price → NULL total)."""
    counts = label_counts_by_product(labelled, product_col)
    price = prices.select(F.col("product_name").alias(product_col), "price")
    out = counts.join(staged(price, "prices"), on=product_col, how="left")
    return out.withColumn("total", F.col("n") * F.col("price"))


def label_sum(labelled: DataFrame, value_col: str, product_col: str = "product") -> DataFrame:
    """Sum of a measure per (product, label); all-NULL sums are 0
    as in pandas."""
    return labelled.groupBy(product_col, "churn").agg(F.coalesce(F.sum(value_col), F.lit(0)).alias(f"sum_{value_col}"))


def column_summary(labelled: DataFrame, cols: str | list[str]) -> DataFrame:
    """A10: whole-table mean (truncated to an integer), exact median, mode
    (smallest on ties), min and max of each column in ``cols``; NULLs are
    skipped. All columns are summarised in one aggregate pass and stacked
    into one row per column."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [
            F.avg(x).cast("bigint").alias(f"{c}__mean"),
            F.median(x).alias(f"{c}__median"),
            F.mode(x, deterministic=True).alias(f"{c}__mode"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = labelled.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"{c}__{m}").alias(m) for m in ("mean", "median", "mode", "min", "max")],
        )
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows)))


def valid_intervals(labelled: DataFrame, invalid_as_zero: bool = True) -> DataFrame:
    """Q14: the notebook turns Invalid intervals into 0 before its statistics
    (``invalid_as_zero=True``, as observed); False drops them instead."""
    if invalid_as_zero:
        return labelled.withColumn("interval", F.coalesce(F.col("interval"), F.lit(0)).cast("bigint"))
    return labelled.filter(F.col("interval").isNotNull())


def interval_stats(labelled: DataFrame, product_col: str = "product", invalid_as_zero: bool = True) -> DataFrame:
    """Mean, exact median, min, max of the interval per product."""
    v = valid_intervals(labelled, invalid_as_zero)
    return v.groupBy(product_col).agg(
        F.avg("interval").alias("mean"),
        F.median("interval").alias("median"),
        F.min("interval").alias("min"),
        F.max("interval").alias("max"),
    )


def interval_modes(labelled: DataFrame, product_col: str = "product", invalid_as_zero: bool = True) -> DataFrame:
    """*all* modes of the interval per product, as a sorted array.

    Counts per (product, value) combine map-side; the tie test is a window
    over those counts (distinct values per product, not rows).
    """
    v = valid_intervals(labelled, invalid_as_zero)
    counts = v.groupBy(product_col, "interval").agg(F.count(F.lit(1)).alias("_n"))
    top = counts.withColumn("_max", F.max("_n").over(Window.partitionBy(product_col)))
    modes = top.filter(F.col("_n") == F.col("_max"))
    return modes.groupBy(product_col).agg(F.sort_array(F.collect_list("interval")).alias("modes"))


def interval_stats_modes(labelled: DataFrame, product_col: str = "product", invalid_as_zero: bool = True) -> DataFrame:
    """The statistics of each product joined to its modes."""
    stats = interval_stats(labelled, product_col, invalid_as_zero)
    return stats.join(interval_modes(labelled, product_col, invalid_as_zero), on=product_col, how="inner")


def interval_box(labelled: DataFrame, product_col: str = "product", invalid_as_zero: bool = True) -> DataFrame:
    """Box-plot numbers per product — exact interpolated quartiles,
    Tukey fences at 1.5·IQR, whiskers at the most extreme values inside the
    fences, and the number of points outside them.

    Everything comes from one per-(product, value) histogram, read once: the
    quartiles are ``percentile`` weighted by the counts (exact, the same as
    over the rows) evaluated as a window over each product's histogram rows
    (distinct values, not rows), then one aggregate gives the whiskers.
    """
    v = valid_intervals(labelled, invalid_as_zero)
    hist = v.groupBy(product_col, "interval").agg(F.count(F.lit(1)).alias("_n"))
    quart = F.percentile("interval", [0.25, 0.5, 0.75], F.col("_n")).over(Window.partitionBy(product_col))
    h = hist.withColumn("_q", quart).select(
        product_col,
        "interval",
        "_n",
        F.col("_q")[0].alias("q1"),
        F.col("_q")[1].alias("median"),
        F.col("_q")[2].alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    x = F.col("interval")
    inside = (x >= F.col("q1") - 1.5 * iqr) & (x <= F.col("q3") + 1.5 * iqr)
    return h.groupBy(product_col, "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))


def interval_histogram(
    labelled: DataFrame, width: int = 90, product_col: str = "product", invalid_as_zero: bool = True
) -> DataFrame:
    """The scatter plot as a distributed 2-D histogram — points per
    (product, interval bin of ``width`` days)."""
    v = valid_intervals(labelled, invalid_as_zero)
    b = F.floor(F.col("interval") / F.lit(width)).cast("bigint")
    return v.groupBy(product_col, b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "bin_start", F.col("bin") * width
    )
