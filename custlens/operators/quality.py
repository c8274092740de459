"""Order-validation checks named (without code) by the reference: duplicate
orders, customers, invoices, shipping labels, and returns without a sale
(D1–D5). The rules are ours.

Each check is a grouped count with a HAVING filter (map-side combine, so a
hot key costs one partial row per task) or an anti-join; none pairs rows
with each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.functions.text import normalise_person_name

# Fixed value: a well-formed shipping label (digits only, 1 to 20 of them).
LABEL_PATTERN = r"^[0-9]{1,20}$"


def duplicate_orders(orders: DataFrame, customer: str = "o_custkey", ts: str = "o_orderdate") -> DataFrame:
    """Customers with more than one order on the same calendar day."""
    return (
        orders.groupBy(F.col(customer).alias("customer_id"), F.to_date(ts).alias("order_day"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .filter(F.col("n_orders") > 1)
    )


def duplicate_customers(customers: DataFrame, name: str = "c_name", key: str = "c_custkey") -> DataFrame:
    """Normalised names shared by more than one customer id."""
    return (
        customers.groupBy(F.lower(normalise_person_name(name)).alias("name_key"))
        .agg(F.count_distinct(key).alias("n_customers"))
        .filter(F.col("n_customers") > 1)
    )


def duplicate_invoices(lines: DataFrame, keys: tuple[str, ...] = ("l_orderkey", "l_linenumber")) -> DataFrame:
    """D3: invoice lines whose (order, line number) occurs more than once."""
    return lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def bad_labels(orders: DataFrame, label: F.Column, key: str = "o_orderkey") -> DataFrame:
    """Shipping labels that are malformed or used by more than one order."""
    labelled = orders.select(label.alias("label"), F.col(key).alias("order_key"))
    per = labelled.groupBy("label").agg(F.count_distinct("order_key").alias("n_orders"))
    malformed = F.col("label").isNull() | ~F.col("label").rlike(LABEL_PATTERN)
    return per.filter(malformed | (F.col("n_orders") > 1)).withColumn(
        "problem", F.when(malformed, F.lit("malformed")).otherwise(F.lit("duplicate"))
    )


def orphan_returns(returns: DataFrame, sales: DataFrame, returns_col: str = "AWB", sales_col: str = "tracking_number") -> DataFrame:
    """Return codes with no sale carrying that tracking number."""
    codes = sales.select(F.col(sales_col).cast("string").alias("_code"))
    return returns.join(codes, F.col(returns_col).cast("string") == F.col("_code"), "left_anti")
