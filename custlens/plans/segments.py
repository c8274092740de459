"""The final customer-segment table of the segmentation ETL.

One lineage from the sales rows to the 9-column result:

    sales ─ F3/F4/F13 (prepare)
          ─ level-1 aggregate, C1 on it (anti-join of high-return pairs)
          ─ two-level aggregate per (customer, product[, day])   ← RFM + funnel inputs
          ─ funnel (two-pack table where configured, else one pack)
          ─ M1 → centroids → M2b → M3 (segment names)
          ─ C6, J4 (province and product id lookups), C7
          ─ select

The reference joins segments to funnels on (customer, last shipment) per
product (J3, Q12); here both come from the same aggregate row, so that join is
the identity and disappears. Rows never pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.operators.funnel import funnel_stage, pack_depletion_days
from custlens.operators.rfm import (
    day_rows,
    drop_high_return_days,
    pack_names,
    prepare_sales,
    repeat_order_score,
    rfm_from_summary,
    summary_from_days,
)
from custlens.operators.segment import hibernate, segment
from custlens.session import staged

OUTPUT = (
    "customer_id",
    "cluster",
    "funnel",
    "product_name",
    "product_id",
    "last_shipment_date",
    "product_qty",
    "repeat_order",
    "province_id",
)


def kept_days(
    sales: DataFrame,
    pack_days: DataFrame | None = None,
    extra_keys: tuple[str, ...] = (),
    packs: list[str] | None = None,
) -> DataFrame:
    """Level-1 rows (customer, raw product, day, *extra_keys) of the pairs C1
    keeps, from *raw* sales in one scan (see ``rfm.day_rows``)."""
    packs = pack_names(pack_days) if packs is None else packs
    return drop_high_return_days(day_rows(prepare_sales(sales), packs, extra_keys=extra_keys))


def scored_from_days(
    days: DataFrame,
    as_of: Column,
    unit_days: DataFrame,
    pack_days: DataFrame | None = None,
    canonical_rules: list[tuple[str, str]] | None = None,
    packs: list[str] | None = None,
) -> DataFrame:
    """RFM per (customer, product) plus its funnel stage from kept level-1
    rows. Products listed in ``pack_days`` use the two-pack estimate (C5),
    all others the single-pack one (C4) with ``unit_days``."""
    packs = pack_names(pack_days) if packs is None else packs
    summary = summary_from_days(days, packs, canonical_rules)
    if packs:
        summary = pack_depletion_days(summary, pack_days, packs)
    else:
        summary = summary.withColumn("pack_days_total", F.lit(None).cast("int"))
    days_cfg = staged(unit_days.select("product_name", "days_per_unit"), "unit-days")
    summary = summary.join(days_cfg, on="product_name", how="left")
    depletion_days = F.coalesce(F.col("pack_days_total"), F.col("product_qty") * F.col("days_per_unit"))
    depletion = F.col("last_shipment_date") + F.make_dt_interval(depletion_days.cast("int"))
    return rfm_from_summary(summary, as_of, extra=[funnel_stage(depletion, as_of).alias("funnel")])


def scored_pairs(
    sales: DataFrame,
    as_of: Column,
    unit_days: DataFrame,
    pack_days: DataFrame | None = None,
    canonical_rules: list[tuple[str, str]] | None = None,
    extra_keys: tuple[str, ...] = (),
    packs: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scored pairs and the kept level-1 rows."""
    days = kept_days(sales, pack_days, extra_keys, packs)
    return scored_from_days(days, as_of, unit_days, pack_days, canonical_rules, packs), days


def rfm_with_funnel(
    sales: DataFrame,
    as_of: Column,
    unit_days: DataFrame,
    pack_days: DataFrame | None = None,
    canonical_rules: list[tuple[str, str]] | None = None,
    packs: list[str] | None = None,
) -> DataFrame:
    """C1 → C2 → C4/C5 from raw sales (see ``scored_pairs``)."""
    return scored_pairs(sales, as_of, unit_days, pack_days, canonical_rules, packs=packs)[0]


def customer_segments(
    sales: DataFrame,
    as_of: Column,
    unit_days: DataFrame,
    pack_days: DataFrame | None = None,
    k: int = 5,
    method: str = "kmeans",
    canonical_rules: list[tuple[str, str]] | None = None,
    packs: list[str] | None = None,
) -> DataFrame:
    """C8 end to end from raw sales; ``method='kmeans'`` fits K-Means per product
    (M2), ``'grid'`` assigns to deterministic seeds (M2b)."""
    # The level-1 rows and the scored pairs feed several branches (statistics, assignment,
    # cluster medians, the output and the two lookups). Staged once, one scan of
    # the sales is enough, a lost executor re-reads files, and the planner
    # knows their sizes.
    days = kept_days(sales, pack_days, ("province_id", "product_id"), packs)
    scored = staged(scored_from_days(days, as_of, unit_days, pack_days, canonical_rules, packs), "segment-scored")
    seg = segment(scored, k=k, method=method)
    seg = seg.withColumn("repeat_order", repeat_order_score("frequency"))
    # Enrichment from distinct pairs of the kept rows (taken from the kept
    # level-1 aggregate, not a second scan); fans out when a key has two
    # values, exactly like the reference's left merge (Q11).
    provinces = days.select("customer_id", "province_id").distinct()
    products = staged(days.select("product_name", "product_id").distinct(), "segment-products")
    out = seg.join(products, on="product_name", how="left").join(provinces, on="customer_id", how="left")
    return hibernate(out).select(*OUTPUT)
