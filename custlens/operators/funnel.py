"""Hot / Warm / Cold funnel from estimated product depletion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.dates import months_before
from custlens.operators.rfm import (
    _pack_col,
    day_rows,
    drop_high_return_days,
    pack_names,
    pair_summary,
    prepare_sales,
    summary_from_days,
)
from custlens.session import staged

# Funnel labels and the Warm look-back window.
HOT, WARM, COLD = "Hot", "Warm", "Cold"
WARM_MONTHS = 3


def funnel_stage(depletion: Column, as_of: Column, warm_months: int = WARM_MONTHS) -> Column:
    """Depletion on/after ``as_of`` → Hot; on/after as_of − 3 months → Warm;
    else (including an unknown date) → Cold."""
    return (
        F.when(depletion >= as_of, F.lit(HOT))
        .when(depletion >= months_before(as_of, warm_months), F.lit(WARM))
        .otherwise(F.lit(COLD))
    )


def _plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def funnel_single_pack(rfm: DataFrame, unit_days: DataFrame, as_of: Column) -> DataFrame:
    """C4: depletion = last shipment + last quantity × days per unit.

    ``unit_days`` (product_name, days_per_unit) is staged, so that the planner
    broadcasts it by its size in bytes. A product without configured days gets a NULL
    depletion date and is Cold (Q22).
    """
    days = staged(unit_days.select("product_name", "days_per_unit"), "unit-days")
    out = rfm.join(days, on="product_name", how="left")
    depletion = _plus_days(F.col("last_shipment_date"), F.col("product_qty") * F.col("days_per_unit"))
    return out.withColumn("depletion_date", depletion).withColumn("funnel", funnel_stage(F.col("depletion_date"), as_of))


def pack_depletion_days(summary: DataFrame, pack_days: DataFrame, packs: list[str]) -> DataFrame:
    """Adds ``pack_days_total``: Σ over packs of (largest quantity of that pack
    on the latest shipment × its days per unit); an absent pack, or one with a
    NULL quantity, adds 0 (Q25). Products missing from ``pack_days`` get NULL."""
    wide = pack_days.groupBy("product_name").agg(
        *[F.max(F.when(F.col("pack") == p, F.col("days_per_unit"))).alias(f"_d_{p}") for p in packs],
        F.lit(True).alias("_has_packs"),
    )
    out = summary.join(staged(wide, "pack-days"), on="product_name", how="left")
    total = F.lit(0)
    for p in packs:
        total = total + F.coalesce(F.col(_pack_col(p)) * F.col(f"_d_{p}"), F.lit(0))
    out = out.withColumn("pack_days_total", F.when(F.col("_has_packs"), total))
    return out.drop("_has_packs", *[f"_d_{p}" for p in packs])


def funnel_two_pack(
    sales: DataFrame,
    pack_days: DataFrame,
    as_of: Column,
    canonical_rules=None,
    exclude_returns: bool = False,
    packs: list[str] | None = None,
) -> DataFrame:
    """On each (customer, product)'s latest shipment day take the largest
    quantity per pack size, add quantity × days for every pack present, and
    grade the resulting depletion date.

    Output per (customer, product): last_shipment_date, one quantity column
    per pack (``qty_<pack>``), depletion_date, funnel. ``exclude_returns``
    applies C1 inside the same aggregate (pass raw sales then). ``packs``
    lists the pack sizes when the caller knows them; else they are read from
    ``pack_days``, by a job of its own.
    """
    packs = pack_names(pack_days) if packs is None else packs
    if exclude_returns:
        # C1 decided on the level-1 aggregate: one scan of the sales rows.
        days = drop_high_return_days(day_rows(prepare_sales(sales), packs))
        summary = summary_from_days(days, packs, canonical_rules)
    else:
        summary = pair_summary(prepare_sales(sales, canonical_rules), packs)
    out = pack_depletion_days(summary, pack_days, packs)
    out = out.withColumn("depletion_date", _plus_days(F.col("last_shipment_date"), F.col("pack_days_total")))
    return out.select(
        "customer_id",
        "product_name",
        "last_shipment_date",
        *[F.col(_pack_col(p)).alias(f"qty_{p}") for p in packs],
        "depletion_date",
        funnel_stage(F.col("depletion_date"), as_of).alias("funnel"),
    )
