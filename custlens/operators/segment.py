"""Customer segmentation per product.

* M1 — z-scores per product: one aggregate gives mean, population deviation,
  least and greatest value of every feature; the table has a row per product,
  is staged and joined back by broadcast. The rows themselves never move.
* M2b — nearest centroid: the k centroids of each product travel as one array
  per product, and the choice is ``array_min`` over (distance, cluster)
  structs — one projection, no row explosion.
* M2 — K-Means for all products at once, by several k-means|| starts and the
  grid seeds, of which each product keeps the best (``kmeans``).
* M3 — cluster names from the exact median frequency per (product, cluster).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.operators import kmeans
from custlens.operators.kmeans import NotConverged  # noqa: F401  raised by the fits below
from custlens.session import staged

FEATURES = ("recency", "frequency", "monetary")

# Segment names and their median-frequency thresholds.
CHAMPION, LOYAL, POTENTIAL, AT_RISK, HIBERNATE = "Champion", "Loyal", "Potential Loyal", "At Risk", "Hibernate"
CHAMPION_MEDIAN, LOYAL_MEDIAN = 6, 2
CHAMPION_FREQUENCY = 5
# The defaults of the reference's K-Means.
MAX_ROUNDS, TOLERANCE = 300, 1e-4


def _z(f: str) -> str:
    return f"z_{f}"


def _scaled(value: Column, f: str) -> Column:
    s = F.col(f"_s_{f}")
    return F.when(s.isNull() | (s == 0), F.lit(0.0)).otherwise((value - F.col(f"_m_{f}")) / s)


def group_statistics(rfm: DataFrame, group_col: str = "product_name", features=FEATURES) -> DataFrame:
    """Mean, population deviation, minimum and maximum of each feature by group."""
    aggs = []
    for f in features:
        aggs += [
            F.avg(f).alias(f"_m_{f}"),
            F.stddev_pop(f).alias(f"_s_{f}"),
            F.min(f).alias(f"_lo_{f}"),
            F.max(f).alias(f"_hi_{f}"),
        ]
    return staged(rfm.groupBy(group_col).agg(*aggs), "segment-statistics")


def scale_features(
    rfm: DataFrame, group_col: str = "product_name", features=FEATURES, stats: DataFrame | None = None
) -> DataFrame:
    """M1: (x − mean) / population std per group; a zero (or undefined)
    deviation gives 0, as StandardScaler does."""
    stats = group_statistics(rfm, group_col, features) if stats is None else stats
    return rfm.join(stats, on=group_col, how="left").select(
        *rfm.columns, *[_scaled(F.col(f), f).alias(_z(f)) for f in features]
    )


def grid_centroids(stats: DataFrame, k: int, group_col: str = "product_name", features=FEATURES) -> DataFrame:
    """Deterministic seeds from ``group_statistics``: k points evenly spaced on
    the diagonal of each group's bounding box, centroid j at
    min + (j + ½)/k · (max − min) of the scaled values."""
    frac = (F.col("cluster") + F.lit(0.5)) / F.lit(k)
    cols = []
    for f in features:
        lo, hi = _scaled(F.col(f"_lo_{f}"), f), _scaled(F.col(f"_hi_{f}"), f)
        cols.append((lo + frac * (hi - lo)).alias(_z(f)))
    each = stats.withColumn("cluster", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return each.select(group_col, "cluster", *cols)


def _distance(centre: Column, features=FEATURES) -> Column:
    return reduce(lambda a, b: a + b, [(centre[_z(f)] - F.col(_z(f))) * (centre[_z(f)] - F.col(_z(f))) for f in features])


def assign_nearest(
    scaled: DataFrame, centroids: DataFrame, group_col: str = "product_name", features=FEATURES
) -> DataFrame:
    """Each row's nearest centroid of its own group (squared Euclidean
    distance; the lower cluster id wins a tie). Adds ``cluster`` and
    ``distance``. The centres, k per group, are staged: the planner broadcasts
    them by their size in bytes."""
    centre = F.struct(F.col("cluster").cast("int").alias("cluster"), *[F.col(_z(f)) for f in features])
    packed = staged(centroids.groupBy(group_col).agg(F.collect_list(centre).alias("_centres")), "segment-centres")
    best = F.array_min(
        F.transform("_centres", lambda c: F.struct(_distance(c, features).alias("d"), c["cluster"].alias("cluster")))
    )
    out = scaled.join(packed, on=group_col, how="left").withColumn("_best", best)
    return out.select(*scaled.columns, F.col("_best.cluster").alias("cluster"), F.col("_best.d").alias("distance"))


def kmeans_centroids(
    scaled: DataFrame,
    seeds: DataFrame,
    group_col: str = "product_name",
    features=FEATURES,
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """K-Means of every group in the same distributed rounds, from given ``seeds``.

    Coordinates are whole millionths (see ``kmeans``). A cluster that lost all its points
    keeps its centre. A group's rounds end when its centres' squared shifts add up
    to no more than ``tolerance``; if that isn't reached in ``max_rounds`` the job fails.
    """
    zs = [_z(f) for f in features]
    points = kmeans.blocks(kmeans.fixed_point(scaled, zs).select(group_col, *zs), group_col, zs)
    start = seeds.select(group_col, F.lit(0).alias("start"), F.col("cluster").cast("int").alias("cluster"), *zs)
    centres = kmeans.lloyd(points, kmeans.fixed_point(start, zs), group_col, zs, max_rounds, tolerance)
    return centres.select(group_col, "cluster", *[(F.col(z) / kmeans.UNIT).alias(z) for z in zs])


def kmeans_fit(
    scaled: DataFrame,
    stats: DataFrame,
    k: int,
    key_cols: list[str] | None = None,
    group_col: str = "product_name",
    features=FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """M2: ``scaled`` in whole millionths, and the centres of each group in the same unit: the best of several
    k-means|| starts and of the grid seeds. ``key_cols`` tell the rows of a group apart."""
    zs = [_z(f) for f in features]
    fixed = kmeans.fixed_point(scaled, zs)
    grid = kmeans.fixed_point(grid_centroids(stats, k, group_col, features), zs)
    keys = [*(key_cols or ["customer_id"]), group_col]
    return fixed, kmeans.fit(fixed, grid, k, keys, group_col, zs, MAX_ROUNDS, TOLERANCE)


def cluster_medians(assigned: DataFrame, group_col: str = "product_name") -> DataFrame:
    """Median frequency of each (group, cluster) and its name —
    ≥ 6 Champion, 2–6 Loyal, < 2 Potential Loyal, otherwise (NULL) At Risk."""
    medians = assigned.groupBy(group_col, "cluster").agg(F.median("frequency").alias("median_frequency"))
    m = F.col("median_frequency")
    name = (
        F.when(m >= CHAMPION_MEDIAN, F.lit(CHAMPION))
        .when(m >= LOYAL_MEDIAN, F.lit(LOYAL))
        .when(m < LOYAL_MEDIAN, F.lit(POTENTIAL))
        .otherwise(F.lit(AT_RISK))
    )
    return medians.withColumn("cluster_name", name)


def name_clusters(assigned: DataFrame, group_col: str = "product_name") -> DataFrame:
    """M3 + C3: the cluster's name, but a frequency above 5 makes the row a
    Champion regardless. Replaces ``cluster`` with the name; keeps the id as
    ``cluster_id``."""
    named = staged(cluster_medians(assigned, group_col).drop("median_frequency"), "segment-names")
    out = assigned.join(named, on=[group_col, "cluster"], how="left")
    name = F.when(F.col("frequency") > CHAMPION_FREQUENCY, F.lit(CHAMPION)).otherwise(F.col("cluster_name"))
    return out.withColumnRenamed("cluster", "cluster_id").withColumn("cluster", name).drop("cluster_name")


def hibernate(df: DataFrame) -> DataFrame:
    """A Potential Loyal customer whose funnel is Cold becomes Hibernate."""
    c = F.col("cluster")
    return df.withColumn("cluster", F.when((c == POTENTIAL) & (F.col("funnel") == "Cold"), F.lit(HIBERNATE)).otherwise(c))


def segment(rfm: DataFrame, k: int = 5, method: str = "kmeans", group_col: str = "product_name") -> DataFrame:
    """M1 → centres → M2b → M3 on an RFM table.

    ``method``: ``'kmeans'`` fits K-Means (M2); ``'grid'`` takes the deterministic
    seeds as they are."""
    if method not in ("kmeans", "grid"):
        raise ValueError(f"unknown method {method}")
    stats = group_statistics(rfm, group_col)
    scaled = scale_features(rfm, group_col, stats=stats)
    if method == "kmeans":
        scaled, centres = kmeans_fit(scaled, stats, k, group_col=group_col)
    else:
        centres = grid_centroids(stats, k, group_col)
    return name_clusters(assign_nearest(scaled, centres, group_col), group_col)
