"""Delivery- and depletion-based churn labels.

Per-row work only: one anti-join against the return list (shuffle on the
tracking code unless AQE finds the list small) and two lookups (regions,
products) that are staged first, so that the planner broadcasts them by their
size in bytes and the rows stay where they are. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.dates import add_days_checked, elapsed_days
from custlens.functions.numeric import safe_int
from custlens.functions.text import clean_region
from custlens.operators.common import first_per_key
from custlens.operators.returns import exclude_returned_tracking
from custlens.session import staged

# Churn labels ("Tidak" = no, "Ya" = yes) and the ETA default.
INVALID, NO, YES = "Invalid", "Tidak", "Ya"
LABELS = (INVALID, NO, YES)
DEFAULT_ETA_DAYS = 5
ZERO_DATE = "0000-00-00"


def first_eta_per_region(eta: DataFrame, region_col: str = "region", eta_col: str = "eta_days") -> DataFrame:
    """The lookup reduced to its first row (by ``priority``) per
    lower-cased region, so the join below cannot fan out."""
    keyed = eta.select(
        F.lower(F.col(region_col)).alias("_region_key"),
        F.col(eta_col).alias("eta_days"),
        F.col("priority"),
    )
    first = first_per_key(
        keyed, ["_region_key"], [F.col("priority").isNull(), F.col("priority"), F.col("eta_days")]
    )
    return first.select("_region_key", "eta_days", F.lit(True).alias("_eta_matched"))


def receipt_dates(
    customers: DataFrame,
    eta: DataFrame,
    date_col: str = "invoice_date",
    only_missing: bool = False,
    existing_col: str = "receipt_date",
) -> DataFrame:
    """Clean the region (F14), look up its ETA (J6; 5 days when the region
    is unknown), and add it to the invoice date (F5). A region whose ETA is
    NULL or not a number gives an Invalid (NULL) receipt date.

    The reference overwrites every receipt date although its heading says
    "replace missing" (Q4); that is the default. ``only_missing=True`` keeps a
    receipt date already present in ``existing_col``."""
    lookup = staged(first_eta_per_region(eta), "eta")
    df = customers.withColumn("region", clean_region("region"))
    df = df.join(lookup, df.region == lookup._region_key, "left")
    eta_value = F.when(F.col("_eta_matched"), F.col("eta_days").cast("string")).otherwise(F.lit(str(DEFAULT_ETA_DAYS)))
    estimate = add_days_checked(F.col(date_col), eta_value)
    if only_missing and existing_col in customers.columns:
        estimate = F.coalesce(F.to_date(F.col(existing_col)), estimate)
    df = df.withColumn("receipt_date", estimate)
    # 'Est. Time Arrival' after to_numeric(errors='coerce')
    df = df.withColumn("eta_days", eta_value.try_cast("double"))
    return df.drop("_region_key", "_eta_matched")


def depletion(df: DataFrame, unit_days: DataFrame, product_col: str = "product", qty_col: str = "quantity") -> DataFrame:
    """Days per unit by product (J8, missing → 0 via F2), estimated days
    = quantity × days (F17, F2), depletion date = receipt + days (F5)."""
    days = unit_days.select(F.col("product_name").alias("_p"), F.col("days_per_unit").alias("_days"))
    df = df.join(staged(days, "unit-days"), F.col(product_col) == F.col("_p"), "left")
    df = df.withColumn("depletion_days", safe_int(F.col(qty_col) * F.col("_days")))
    df = df.withColumn("days_per_unit", safe_int(F.col("_days")))
    df = df.withColumn("depletion_date", add_days_checked(F.col("receipt_date"), F.col("depletion_days"), date_is_text=False))
    return df.drop("_p", "_days")


def churn_label(interval: Column, depletion_days: Column) -> Column:
    """C14: NULL interval → Invalid; negative → Tidak; still stocked → Tidak;
    else Ya."""
    return (
        F.when(interval.isNull(), F.lit(INVALID))
        .when(interval < 0, F.lit(NO))
        .when(depletion_days >= interval, F.lit(NO))
        .otherwise(F.lit(YES))
    )


def churn_labels(
    customers: DataFrame,
    returns: DataFrame,
    eta: DataFrame,
    unit_days: DataFrame,
    as_of: Column,
    returns_col: str = "return_code",
) -> DataFrame:
    """C12 → C14 end to end.

    Steps: drop returned tracking codes (J5, compared as text), drop the
    ``0000-00-00`` sentinel (P6, NULL kept), receipt date, depletion, interval
    = floored days from the **receipt** date to ``as_of`` (Q16; NULL when the
    depletion date is Invalid), label.
    """
    df = exclude_returned_tracking(customers, returns, "tracking_code", returns_col)
    df = df.filter(~F.col("invoice_date").eqNullSafe(ZERO_DATE))
    df = receipt_dates(df, eta)
    df = depletion(df, unit_days)
    interval = F.when(
        F.col("depletion_date").isNotNull(), elapsed_days(F.col("receipt_date").cast("timestamp_ntz"), as_of)
    )
    df = df.withColumn("interval", interval)
    return df.withColumn("churn", churn_label(F.col("interval"), F.col("depletion_days")))


def churn_flag(label: Column) -> Column:
    """'Ya' → 0, anything else → 1 (the plots' recoding, Q15)."""
    return F.when(label == YES, F.lit(0)).otherwise(F.lit(1))
