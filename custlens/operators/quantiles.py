"""Exact order statistics of continuous columns.

``median`` and ``percentile`` keep a counter per distinct value, which for prices or
amounts is a counter per row. Here a rank is found by distributed selection: for every
(group, column) a histogram of at most ``bins`` buckets over the range that holds the
rank, then the same within the bucket that the rank falls in, until a bucket holds one
value. All groups, columns and ranks go through the same rounds.

* A bucket carries its own least and greatest value, which are the next range: the range
  shrinks to the data, and each round splits it strictly, so the search ends.
* Even rounds cut a range into equal widths, odd rounds into equal ratios: values spread
  over many magnitudes don't pile up in one bucket round after round.
* The histogram combines map-side. No buffer is larger than a histogram, whatever the
  group. After the first round only the rows of the buckets still open are read.
* Ranges of a group are equal or disjoint, so a row is in one of them at most.

The driver gets one number a round, that of the ranks still open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from custlens.session import staged

BINS = 1024
INF = float("inf")


def _stacked(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """(_g, x): a row per value, NULLs left out. ``_g`` is a struct, so that NULL keys are a group."""
    keys = [F.col(c) for c in by]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in cols]))
    long = df.select(*keys, each.alias("_v")).where("_v.x IS NOT NULL")
    return long.select(F.struct(*keys, F.col("_v.c").alias("column_name")).alias("_g"), F.col("_v.x").alias("x"))


def _place(x: Column, lo: Column, hi: Column, bins: int, by_ratio: bool) -> Column:
    """The bucket of ``x`` in [lo, hi]: monotone in x, 0 for lo, the last for hi."""
    if by_ratio:
        # Above ln of the least positive double, so that the order of signs holds.
        t = lambda v: F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log(F.abs(v)) + F.lit(746.0)))
    else:
        t = lambda v: v / 2  # noqa: E731  the range of all doubles doesn't overflow
    share = F.coalesce(F.try_divide(t(x) - t(lo), t(hi) - t(lo)), F.lit(0.0))
    inner = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(share * bins).cast("int")))
    return F.when(x <= lo, 0).when(x >= hi, bins - 1).otherwise(inner)


def _counted(values: DataFrame) -> DataFrame:
    """Per group: numbers of -inf, finite, +inf and NaN values, and the finite range."""
    x = F.col("x")
    finite = ~F.isnan(x) & (F.abs(x) != INF)
    return values.groupBy("_g").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(x == -INF).alias("n_low"),
        F.count_if(finite).alias("n_finite"),
        F.count_if(x == INF).alias("n_high"),
        F.min(F.when(finite, x)).alias("lo"),
        F.max(F.when(finite, x)).alias("hi"),
    )


def select_ranks(values: DataFrame, ranks: DataFrame, bins: int = BINS) -> DataFrame:
    """(_g, rank, value): the value at each 0-based ``rank`` of (_g, rank) among the group's
    rows of the staged table ``values`` (_g, x). Order: -inf, numbers, +inf, NaN."""
    counted = staged(_counted(values), "quantile-counts")
    r = F.col("rank") - F.col("n_low")
    special = (
        F.when(r < 0, -INF).when(r < F.col("n_finite"), None).when(r < F.col("n_finite") + F.col("n_high"), INF).otherwise(float("nan"))
    )
    placed = ranks.join(counted, "_g").where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    state = staged(placed.select("_g", "rank", r.alias("r"), "lo", "hi", special.alias("value")), "quantile-state")
    rounds, done = 0, []
    while True:
        found = F.coalesce("value", F.when(F.col("lo") == F.col("hi"), F.col("lo")))
        done.append(state.select("_g", "rank", found.alias("value")).where("value IS NOT NULL"))
        open_ = state.where(F.col("value").isNull() & (F.col("lo") < F.col("hi")))
        if open_.isEmpty():
            return staged(reduce(DataFrame.unionByName, done), "quantile-values")
        ranges = staged(open_.groupBy("_g").agg(F.collect_set(F.struct("lo", "hi")).alias("_r")), "quantile-ranges")
        own = F.filter("_r", lambda g: (F.col("x") >= g["lo"]) & (F.col("x") <= g["hi"]) & ~F.isnan(F.col("x")))
        hits = values.join(ranges, "_g").select("_g", "x", F.explode(own).alias("_h")).select("_g", "x", "_h.lo", "_h.hi")
        if rounds:
            # The rows still in question are few now: write them, and read only them from here on.
            hits = staged(hits, "quantile-rows")
            values = hits.select("_g", "x")
        bucket = _place(F.col("x"), F.col("lo"), F.col("hi"), bins, rounds % 2 == 1)
        histogram = hits.groupBy("_g", "lo", "hi", bucket.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("x_lo"), F.max("x").alias("x_hi")
        )
        before = F.coalesce(F.sum("n").over(Window.partitionBy("_g", "lo", "hi").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cumulated = histogram.withColumn("before", before)
        within = (F.col("r") >= F.col("before")) & (F.col("r") < F.col("before") + F.col("n"))
        state = open_.join(cumulated, ["_g", "lo", "hi"]).where(within).select(
            "_g", "rank", (F.col("r") - F.col("before")).alias("r"), F.col("x_lo").alias("lo"), F.col("x_hi").alias("hi"), "value"
        )
        state = staged(state, "quantile-state")
        rounds += 1


def exact_quantiles(
    df: DataFrame, cols: list[str], fractions: list[float], by: list[str] | None = None, bins: int = BINS
) -> DataFrame:
    """(*by, column_name, n, quantiles): per group and column the number of values and the
    interpolated quantiles at ``fractions`` (position f * (n - 1), as ``percentile``).

    NULLs don't count; a column without values has no row. NaN is above all numbers. Integers beyond
    2^53 and decimals are compared as doubles.
    """
    if bins < 2 or not all(0 <= f <= 1 for f in fractions):
        raise ValueError("needs two bins and fractions from 0 to 1")
    by = by or []
    values = staged(_stacked(df, by, cols), "quantile-input")
    sizes = staged(values.groupBy("_g").agg(F.count(F.lit(1)).alias("n")), "quantile-sizes")
    at = [F.lit(float(f)) * (F.col("n") - 1) for f in fractions]
    wanted = F.array_distinct(F.array(*[e.cast("long") for p in at for e in (F.floor(p), F.ceil(p))]))
    found = select_ranks(values, sizes.select("_g", F.explode(wanted).alias("rank")), bins)
    of_group = found.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("v"))

    def between(p: Column) -> Column:
        low, high = F.col("v")[F.floor(p).cast("long")], F.col("v")[F.ceil(p).cast("long")]
        return F.when(low == high, low).otherwise(low + (high - low) * (p - F.floor(p)))

    out = sizes.join(of_group, "_g").select("_g", "n", F.array(*[between(p) for p in at]).alias("quantiles"))
    return out.select("_g.*", "n", "quantiles")


def _named(c: str, name: str) -> str:
    return f"{c}_{name}" if c else name


def continuous_summary(df: DataFrame, cols: list[str], bins: int = BINS) -> DataFrame:
    """A10 for columns of any number of distinct values: mean, exact median, mode (the
    smallest on ties), min and max, a row per column. The mode comes from counts per
    value, which are rows of a shuffle, not entries of a buffer."""
    values = staged(_stacked(df, [], cols), "summary-input")
    medians = exact_quantiles(df, cols, [0.5], bins=bins).select("column_name", F.col("quantiles")[0].alias("median"))
    plain = values.groupBy("_g").agg(F.avg("x").alias("mean"), F.min("x").alias("min"), F.max("x").alias("max"))
    counts = values.groupBy("_g", "x").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("_g").agg(F.min_by("x", F.struct((-F.col("n")).alias("n"), "x")).alias("mode"))
    out = plain.join(modes, "_g").select("_g.column_name", "mean", "mode", "min", "max").join(medians, "column_name")
    return out.select("column_name", "mean", "median", "mode", "min", "max")


def group_summary(df: DataFrame, by: list[str], col: str, bins: int = BINS) -> DataFrame:
    """Mean, exact median, min and max of ``col`` per group; groups without a value are left out."""
    medians = exact_quantiles(df, [col], [0.5], by, bins)
    plain = _stacked(df, by, [col]).groupBy("_g").agg(F.avg("x").alias("mean"), F.min("x").alias("min"), F.max("x").alias("max"))
    medians = medians.select(F.struct(*by, "column_name").alias("_g"), F.col("quantiles")[0].alias("median"))
    return plain.join(medians, "_g").select(*[F.col(f"_g.{c}").alias(c) for c in by], "mean", "median", "min", "max")


def box_summary(df: DataFrame, by: list[str], col: str, bins: int = BINS) -> DataFrame:
    """Box-plot numbers per group: exact interpolated quartiles, whiskers at the most
    extreme values within 1.5 interquartile ranges of them, and the number of values outside."""
    quartiles = exact_quantiles(df, [col], [0.25, 0.5, 0.75], by, bins)
    q = F.col("quantiles")
    quartiles = staged(
        quartiles.select(F.struct(*by, "column_name").alias("_g"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")), "quartiles"
    )
    x, iqr = F.col("x"), F.col("q3") - F.col("q1")
    inside = (x >= F.col("q1") - 1.5 * iqr) & (x <= F.col("q3") + 1.5 * iqr)
    out = _stacked(df, by, [col]).join(quartiles, "_g").groupBy("_g", "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return out.select(
        *[F.col(f"_g.{c}").alias(c) for c in by], "q1", "median", "q3", "whisker_low", "whisker_high", "outliers", iqr.alias("iqr")
    )
