"""Registered queries for the cohort notebook: C9, C10, C11, A18, A19."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.operators import cohort_state
from custlens.operators.cohort import cohort_matrix, cohort_retention, cohort_revenue
from custlens.operators.returns import exclude_returned_tracking
from custlens.plans.registry import edge, query
from custlens.session import scratch_path, staged
from custlens.sources import fixtures as fx

# Fixed value: the months that the orders span, 1995-01 to 2001-08.
HORIZON = 80
PRODUCTS = ["Brand#11", "Brand#23", "Brand#45"]

_ROWS_SQL = """
rows_ AS (
  SELECT id AS customer, product_name,
         CAST(date_trunc('month', TRY_CAST(invoice_date AS TIMESTAMP)) AS DATE) AS invoice_month,
         product_sales_total AS amount
  FROM {src}
  WHERE invoice_date IS DISTINCT FROM '0000-00-00'),
monthly AS (
  SELECT customer, product_name, invoice_month, sum(amount) AS amount FROM rows_
  WHERE customer IS NOT NULL AND invoice_month IS NOT NULL
  GROUP BY ALL),
indexed AS (
  SELECT *, min(invoice_month) OVER (PARTITION BY customer, product_name) AS cohort_month FROM monthly),
cells AS (
  SELECT product_name, cohort_month,
         CAST((year(invoice_month) - year(cohort_month)) * 12 + month(invoice_month) - month(cohort_month) + 1 AS INTEGER) AS cohort_index,
         sum(amount) AS revenue, count(*) AS customers
  FROM indexed GROUP BY ALL)"""


def _cells_sql(src: str = "cohort_sales", extra: str = "") -> str:
    return ",\n" + extra + _ROWS_SQL.format(src=src).strip()


_KEPT_SQL = """kept AS (
  SELECT * FROM cohort_sales s
  WHERE NOT EXISTS (SELECT 1 FROM returns r WHERE r.AWB = CAST(s.tracking_number AS VARCHAR))),
"""


def _revenue(spark: SparkSession, sf: str, exclude_returns: bool = False) -> DataFrame:
    sales = fx.cohort_sales(spark, sf)
    if exclude_returns:
        sales = exclude_returned_tracking(sales, fx.returns(spark, sf), "tracking_number", "AWB")
    return cohort_revenue(sales)


def _report(df: DataFrame) -> DataFrame:
    return edge(df.withColumn("revenue", F.round("revenue", 2)))


@query(
    "cohort_revenue",
    fx.with_fixtures(
        _cells_sql()
        + "\nSELECT product_name, cohort_month, cohort_index, round(revenue, 2) AS revenue, customers FROM cells",
        "cohort_sales",
    ),
)
def q_cohort_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """C9 as observed (Q1: returns are not excluded): P6, F3, F8–F10, W1, A4."""
    return _report(_revenue(spark, sf))


@query(
    "cohort_revenue_products",
    fx.with_fixtures(
        _cells_sql()
        + "\nSELECT product_name, cohort_month, cohort_index, round(revenue, 2) AS revenue, customers FROM cells "
        + "WHERE product_name IN (" + ", ".join(f"'{p}'" for p in PRODUCTS) + ")",
        "cohort_sales",
    ),
)
def q_cohort_revenue_products(spark: SparkSession, sf: str) -> DataFrame:
    """P5: C9 for a list of products."""
    return _report(cohort_revenue(fx.cohort_sales(spark, sf), PRODUCTS))


@query(
    "cohort_revenue_ex_returns",
    fx.with_fixtures(
        _cells_sql("kept", _KEPT_SQL)
        + "\nSELECT product_name, cohort_month, cohort_index, round(revenue, 2) AS revenue, customers FROM cells",
        "cohort_sales",
        "returns",
    ),
)
def q_cohort_revenue_ex_returns(spark: SparkSession, sf: str) -> DataFrame:
    """C9 with C11 applied (J5 on the tracking number, F1 cast to text)."""
    return _report(_revenue(spark, sf, exclude_returns=True))


@query(
    "cohort_retention",
    fx.with_fixtures(
        _cells_sql()
        + """
SELECT product_name, cohort_month, cohort_index,
       round(revenue / nullif(max(CASE WHEN cohort_index = 1 THEN revenue END)
                              OVER (PARTITION BY product_name, cohort_month), 0), 6) AS retention
FROM cells""",
        "cohort_sales",
    ),
)
def q_cohort_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Ratio to the cohort's first-month revenue."""
    ret = cohort_retention(_revenue(spark, sf))
    return edge(ret.select("product_name", "cohort_month", "cohort_index", F.round("retention", 6).alias("retention")))


@query(
    "cohort_matrix",
    fx.with_fixtures(
        _cells_sql()
        + "\nSELECT product_name, cohort_month, "
        + ", ".join(f'max(round(revenue, 2)) FILTER (WHERE cohort_index = {n}) AS "{n}"' for n in range(1, HORIZON + 1))
        + " FROM cells GROUP BY product_name, cohort_month",
        "cohort_sales",
    ),
)
def q_cohort_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The wide cohort_month × cohort_index matrix (S5 writes it as CSV)."""
    rev = _revenue(spark, sf).withColumn("revenue", F.round("revenue", 2))
    return edge(cohort_matrix(rev, HORIZON))


@query(
    "cohort_preview",
    fx.with_fixtures(
        _cells_sql()
        + """
SELECT product_name, cohort_month, cohort_index, round(revenue, 2) AS revenue, customers FROM cells
ORDER BY product_name, cohort_month, cohort_index LIMIT 5""",
        "cohort_sales",
    ),
)
def q_cohort_preview(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the notebook's ``head()`` of the cohort table, under a total order."""
    from custlens.operators.common import preview

    return preview(_report(_revenue(spark, sf)), ["product_name", "cohort_month", "cohort_index"])


@query(
    "cohort_incremental",
    fx.with_fixtures(
        _cells_sql()
        + "\nSELECT product_name, cohort_month, cohort_index, round(revenue, 2) AS revenue, customers FROM cells",
        "cohort_sales",
    ),
)
def q_cohort_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """C9 / W1 brought forward by three batches, equal to one full run. Batches go by the year
    of arrival; every third order arrives two years late, so first months move back."""
    sales = fx.cohort_sales(spark, sf)
    late = F.when(F.col("tracking_number").cast("long") % 3 == 0, 2).otherwise(0)
    year = F.substring("invoice_date", 1, 4).cast("int") + late
    batch = F.when(year >= 2000, 3).when(year >= 1998, 2).otherwise(1)
    # Staged once: each batch reads its rows without joining lines and orders anew.
    arrivals = staged(sales.select("id", "invoice_date", "product_name", "product_sales_total", batch.alias("batch")), "cohort-arrivals")
    path = scratch_path(spark, f"cohort-state-{uuid.uuid4().hex}")
    for n in (1, 2, 3):
        cohort_state.add_batch(arrivals.where(F.col("batch") == n), path, str(n), merge_after=1)
    cells = cohort_state.cohort_cells(spark, path)
    return edge(cells.withColumn("revenue", F.round("revenue", 2)))
