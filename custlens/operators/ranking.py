"""Order over tables that no task could sort: row caps (O3) and dense ranks.

Rows are dealt to tasks by range, counted per task, and the counts are summed up along
the ranges. After that each task knows where its rows begin, and only neighbouring
rows ever meet. The ranges are staged, so a task that runs again sees the same cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from custlens.session import staged

# Up to so many rows each task keeps its own first rows, and one task merges them.
SMALL = 10_000


def by_range(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``_part``, the number of the range that a row falls in: rows of a lower
    part come before rows of a higher one. Staged."""
    return staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)


def first_rows(df: DataFrame, order_by: list[str], n: int, small: int = SMALL) -> DataFrame:
    """O3: the first ``n`` rows by a *total* order, NULLs first, for any ``n``.

    Whole ranges before the cut are kept unsorted; only the range that holds the cut is
    sorted. The driver gets a count per range. Ties that ``order_by`` leaves open at the cut are broken
    arbitrarily, as by ``limit``.
    """
    if n <= small:
        return df.orderBy(*order_by).limit(n)
    order = [F.col(c).asc_nulls_first() for c in order_by]
    ranged = by_range(df, order, "row-cap")
    left, cut = n, None
    for r in sorted(ranged.groupBy("_part").count().collect()):
        if r["count"] > left:
            cut = r["_part"]
            break
        left -= r["count"]
    if cut is None:
        return ranged.drop("_part")
    last = ranged.where(F.col("_part") == cut).orderBy(*order).limit(left) if left else ranged.limit(0)
    return ranged.where(F.col("_part") < cut).unionByName(last).drop("_part")


def dense_ranks(df: DataFrame, by: list[str], value: str, name: str = "rank") -> DataFrame:
    """(*by, value, rank): the dense rank of each different value within its group, the
    greatest first. A group of any size is dealt over as many ranges as it fills.

    A value's rank is its place within its range plus the group's different values in the
    ranges before; that sum runs over a row per range and group. NULL keys are a
    group, a NULL value ranks last.
    """
    different = df.select(*by, value).distinct()
    order = [*[F.col(c).asc_nulls_first() for c in by], F.col(value).desc_nulls_last()]
    ranged = by_range(different, order, "ranks")
    sizes = ranged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = staged(sizes.select(*by, "_part", F.coalesce(earlier, F.lit(0)).alias("_before")), "ranks-before")
    place = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(F.col(value).desc_nulls_last()))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*by, "_part")]
    joined = ranged.withColumn("_place", place).alias("r").join(before.alias("b"), same)
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in (*by, value)], (F.col("_place") + F.col("_before")).cast("int").alias(name))
