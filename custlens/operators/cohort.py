"""Monthly revenue cohorts (C9), retention ratio (C10) and the matrix form
(A18, A19).

Plan shape: the rows are first summed per (customer, product, month) — a hash
aggregate with map-side combine, so a customer holding a third of all rows
shrinks to one row per month before anything is shuffled. The first month
per customer (W1) is then a window over those few monthly rows, and the
cohort cells are a second small aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.dates import month_index, month_start, safe_timestamp

# Fixed value: the invalid-date sentinel of the source database.
ZERO_DATE = "0000-00-00"


def cohort_rows(
    sales: DataFrame,
    products: list[str] | None = None,
    customer_col: str = "id",
    date_col: str = "invoice_date",
    amount_col: str = "product_sales_total",
) -> DataFrame:
    """P6 + F3 + P5 + F8: drop the sentinel *before* parsing, parse safely,
    keep the chosen products (all when ``products`` is None), add the month.

    Rows whose customer or month is NULL are dropped, as pandas ``groupby``
    drops NULL keys.
    """
    df = sales.filter(~F.col(date_col).eqNullSafe(ZERO_DATE))
    if products is not None:
        df = df.filter(F.col("product_name").isin(list(products)))
    month = month_start(safe_timestamp(date_col))
    return df.select(
        F.col(customer_col).alias("customer"),
        "product_name",
        month.alias("invoice_month"),
        F.col(amount_col).alias("amount"),
    ).filter(F.col("customer").isNotNull() & F.col("invoice_month").isNotNull())


def cohort_revenue(
    sales: DataFrame,
    products: list[str] | None = None,
    customer_col: str = "id",
    date_col: str = "invoice_date",
    amount_col: str = "product_sales_total",
) -> DataFrame:
    """C9 long form: revenue per (product, cohort_month, cohort_index).

    The reference runs one product at a time; here every product is a group
    of the same job (``products`` restricts it like the reference's filter).
    """
    rows = cohort_rows(sales, products, customer_col, date_col, amount_col)
    monthly = rows.groupBy("customer", "product_name", "invoice_month").agg(F.sum("amount").alias("amount"))
    first = F.min("invoice_month").over(Window.partitionBy("customer", "product_name"))
    indexed = monthly.withColumn("cohort_month", first).withColumn(
        "cohort_index", month_index("invoice_month", "cohort_month")
    )
    return indexed.groupBy("product_name", "cohort_month", "cohort_index").agg(
        F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("customers")
    )


def cohort_retention(revenue: DataFrame) -> DataFrame:
    """Each cell divided by its cohort's index-1 revenue; NULL when
    that revenue is 0 or missing (pandas would give inf)."""
    w = Window.partitionBy("product_name", "cohort_month")
    base = F.max(F.when(F.col("cohort_index") == 1, F.col("revenue"))).over(w)
    return revenue.withColumn("retention", F.try_divide(F.col("revenue"), base))


def cohort_matrix(revenue: DataFrame, horizon: int, value_col: str = "revenue") -> DataFrame:
    """Wide matrix, one row per (product, cohort month), one column per
    cohort index from 1 to ``horizon``. A cell beyond the horizon fails the job:
    it has no column, and leaving it out would be silent loss."""
    index = F.col("cohort_index")
    checked = F.when(index.between(1, horizon), index).otherwise(
        F.raise_error(F.concat(F.lit("cohort index outside of the horizon: "), F.coalesce(index.cast("string"), F.lit("NULL")))).cast("int")
    )
    cells = revenue.select("product_name", "cohort_month", checked.alias("cohort_index"), value_col)
    return cells.groupBy("product_name", "cohort_month").agg(
        *[F.max(F.when(F.col("cohort_index") == n, F.col(value_col))).alias(str(n)) for n in range(1, horizon + 1)]
    )
