"""Recency–frequency–monetary metrics (C2), the repeat-order score (C6) and
the shared per-(customer, product) summary the funnel reuses.

Plan shape: two hash aggregates, both with map-side partial aggregation.

* level 1 — one row per (customer, product, shipment instant): row count,
  sales sum, largest quantity, largest quantity per pack size;
* level 2 — one row per (customer, product): frequency, monetary, latest
  shipment, and the level-1 values *at* the latest shipment via ``max_by``.

Because level 1 already reduced ties on the latest instant to their largest
quantity, ``max_by(q, ship)`` is deterministic and all buffers are fixed-width
(no sort-based fallback). A customer holding a third of all rows shrinks to
one partial row per (task, day) before the first shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.dates import elapsed_days, fill_missing_shipment, safe_timestamp
from custlens.functions.numeric import clamp_zero
from custlens.functions.text import canonical_name
from custlens.operators.returns import FILTER_ABOVE, high_return_pairs, without_pairs
from custlens.session import staged

KEYS = ("customer_id", "product_name")


def prepare_sales(
    sales: DataFrame,
    canonical_rules: list[tuple[str, str]] | None = None,
    fill_days: int = 5,
) -> DataFrame:
    """F3 + F4 + F13, applied once before RFM and funnel (Q7): parse the
    invoice date safely, fill a missing shipment with invoice + 5 days, and
    add the canonical product name used for grouping."""
    inv = safe_timestamp("invoice_date")
    ship = fill_missing_shipment(safe_timestamp("last_shipment_date"), inv, fill_days)
    given = canonical_name("product_name", canonical_rules or [])
    return (
        sales.withColumn("invoice_date", inv)
        .withColumn("last_shipment_date", ship)
        .withColumn("given_product_name", given)
    )


def pack_names(pack_days: DataFrame | None) -> list[str]:
    """The pack sizes of the configuration; each becomes a column."""
    if pack_days is None:
        return []
    return [r["pack"] for r in pack_days.select("pack").distinct().orderBy("pack").collect()]


def _pack_col(pack: str) -> str:
    return f"_q_{pack}"


def pair_summary(prepared: DataFrame, packs: list[str] | None = None) -> DataFrame:
    """Levels 1 and 2 described in the module docstring.

    Output: customer_id, product_name (canonical), frequency, monetary,
    last_shipment_date, product_qty (quantity on the latest shipment, largest
    on ties) and one ``_q_<pack>`` column per pack: the largest quantity of
    that pack on the latest shipment (NULL when the pack is absent there).
    Rows with a NULL customer or product are dropped, as pandas ``groupby``
    drops NULL keys.
    """
    packs = packs or []
    rows = prepared.filter(F.col("customer_id").isNotNull() & F.col("given_product_name").isNotNull())
    day = rows.groupBy("customer_id", "given_product_name", "last_shipment_date").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("product_sales_total").alias("_sales"),
        F.max("product_qty").alias("_qty"),
        *[F.max(F.when(F.col("pack") == p, F.col("product_qty"))).alias(_pack_col(p)) for p in packs],
    )
    ship = F.col("last_shipment_date")
    pair = day.groupBy("customer_id", "given_product_name").agg(
        F.sum("_n").alias("frequency"),
        F.coalesce(F.sum("_sales"), F.lit(0.0)).alias("monetary"),
        F.max(ship).alias("last_shipment_date"),
        F.max_by("_qty", ship).alias("product_qty"),
        *[F.max_by(_pack_col(p), ship).alias(_pack_col(p)) for p in packs],
    )
    return pair.withColumnRenamed("given_product_name", "product_name")


def day_rows(
    prepared: DataFrame,
    packs: list[str] | None = None,
    status_col: str | None = "sale_status",
    return_status: int = 3,
    extra_keys: tuple[str, ...] = (),
) -> DataFrame:
    """Level 1: one row per (customer, raw product, shipment instant,
    *extra_keys) with row count, return count, sales sum, largest quantity
    and largest quantity per pack. The canonical name is derived later from
    the raw one (``summary_from_days``).

    NULL keys are kept here (they survive C1 and can still feed lookups such
    as provinces); level 2 drops them.
    """
    packs = packs or []
    returns = F.count_if(F.col(status_col) == return_status) if status_col else F.lit(0).cast("bigint")
    return prepared.groupBy("customer_id", "product_name", "last_shipment_date", *extra_keys).agg(
        F.count(F.lit(1)).alias("_n"),
        returns.alias("_r"),
        F.sum("product_sales_total").alias("_sales"),
        F.max("product_qty").alias("_qty"),
        *[F.max(F.when(F.col("pack") == p, F.col("product_qty"))).alias(_pack_col(p)) for p in packs],
    )


def drop_high_return_days(
    days: DataFrame, min_rows: int = 3, max_return_pct: int = 50, filter_above: int = FILTER_ABOVE
) -> DataFrame:
    """C1 on level-1 rows, by the operators that ``exclude_high_return`` uses: the bad pairs
    are an aggregate of the counts, and whole pairs are dropped by an anti-join. Pairs with
    a NULL key always survive (Q6). The level-1 rows are staged, so the sales are read once."""
    days = staged(days, "sale-days")
    bad = high_return_pairs(days, KEYS, F.col("_n"), F.col("_r"), min_rows=min_rows, max_return_pct=max_return_pct)
    # The return count has done its job; later levels never read it.
    return without_pairs(days, bad, KEYS, filter_above).drop("_r")


def summary_from_days(
    days: DataFrame, packs: list[str] | None = None, canonical_rules: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Levels 2 and 3: collapse the extra keys and raw names to (customer,
    canonical product, day), then to (customer, canonical product) with the
    values at the latest day (``max_by``); NULL keys are dropped here."""
    packs = packs or []
    named = days.withColumn("given_product_name", canonical_name("product_name", canonical_rules or []))
    kept = named.filter(F.col("customer_id").isNotNull() & F.col("given_product_name").isNotNull())
    day = kept.groupBy("customer_id", "given_product_name", "last_shipment_date").agg(
        F.sum("_n").alias("_n"),
        F.sum("_sales").alias("_sales"),
        F.max("_qty").alias("_qty"),
        *[F.max(_pack_col(p)).alias(_pack_col(p)) for p in packs],
    )
    ship = F.col("last_shipment_date")
    pair = day.groupBy("customer_id", "given_product_name").agg(
        F.sum("_n").alias("frequency"),
        F.coalesce(F.sum("_sales"), F.lit(0.0)).alias("monetary"),
        F.max(ship).alias("last_shipment_date"),
        F.max_by("_qty", ship).alias("product_qty"),
        *[F.max_by(_pack_col(p), ship).alias(_pack_col(p)) for p in packs],
    )
    return pair.withColumnRenamed("given_product_name", "product_name")


def rfm_from_summary(summary: DataFrame, as_of: Column, extra: list[Column] | None = None) -> DataFrame:
    """C2 columns from the summary: recency = floored days to ``as_of``,
    clamped at 0 (F6, F7); ``extra`` columns ride along."""
    return summary.select(
        *KEYS,
        "last_shipment_date",
        clamp_zero(elapsed_days("last_shipment_date", as_of)).alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        "monetary",
        "product_qty",
        *(extra or []),
    )


def calculate_rfm(
    sales: DataFrame, as_of: Column, canonical_rules: list[tuple[str, str]] | None = None
) -> DataFrame:
    """RFM per (customer, canonical product) from return-filtered sales."""
    return rfm_from_summary(pair_summary(prepare_sales(sales, canonical_rules)), as_of)


def rfm_excluding_returns(
    sales: DataFrame,
    as_of: Column,
    canonical_rules: list[tuple[str, str]] | None = None,
    min_rows: int = 3,
    max_return_pct: int = 50,
) -> DataFrame:
    """C1 → C2 in one scan: the return rule is decided on level-1 aggregates
    instead of by a second pass over the sales rows (see ``day_rows``)."""
    days = drop_high_return_days(day_rows(prepare_sales(sales)), min_rows, max_return_pct)
    return rfm_from_summary(summary_from_days(days, canonical_rules=canonical_rules), as_of)


def repeat_order_score(frequency: str | Column = "frequency") -> Column:
    """1→0, 2→1, 3→2, 4→3, 5→4, anything else → 5."""
    f = F.col(frequency) if isinstance(frequency, str) else frequency
    return F.when(f.isin(1, 2, 3, 4, 5), (f - 1).cast("int")).otherwise(F.lit(5))
