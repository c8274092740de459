"""Registered queries for the optional order-validation checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.operators import quality as dq
from custlens.plans.registry import edge, query
from custlens.session import scratch_path
from custlens.sources import fixtures as fx
from custlens.sources.files import read_csv, read_csv_folder, write_csv
from custlens.sources.tables import name_columns, read_table


@query(
    "dup_orders",
    """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_day, count(*) AS n_orders
FROM orders GROUP BY ALL HAVING count(*) > 1""",
)
def q_dup_orders(spark: SparkSession, sf: str) -> DataFrame:
    """D1."""
    return edge(dq.duplicate_orders(read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"])))


@query(
    "dup_customers",
    fx.with_fixtures(
        """SELECT lower(array_to_string(list_transform(string_split(lower(trim(regexp_replace(c_name, '\\s+', ' ', 'g'))), ' '),
                  lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')) AS name_key,
       count(DISTINCT c_custkey) AS n_customers
FROM customers_named GROUP BY ALL HAVING count(DISTINCT c_custkey) > 1""",
        "customers_named",
    ),
)
def q_dup_customers(spark: SparkSession, sf: str) -> DataFrame:
    """D2."""
    return dq.duplicate_customers(fx.customers_named(spark, sf))


@query(
    "dup_invoices",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def q_dup_invoices(spark: SparkSession, sf: str) -> DataFrame:
    """D3."""
    return dq.duplicate_invoices(read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"]))


@query(
    "bad_labels",
    fx.with_fixtures(
        """SELECT label, n_orders, CASE WHEN label IS NULL OR NOT regexp_matches(label, '^[0-9]{1,20}$')
                                THEN 'malformed' ELSE 'duplicate' END AS problem
FROM (SELECT label, count(DISTINCT o_orderkey) AS n_orders FROM order_labels GROUP BY ALL)
WHERE label IS NULL OR NOT regexp_matches(label, '^[0-9]{1,20}$') OR n_orders > 1""",
        "order_labels",
    ),
)
def q_bad_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Shipping labels malformed or reused."""
    return dq.bad_labels(fx.order_labels(spark, sf), F.col("label"))


@query(
    "orphan_returns",
    fx.with_fixtures(
        "SELECT * FROM returns r WHERE NOT EXISTS (SELECT 1 FROM cohort_sales s WHERE s.tracking_number = r.AWB)",
        "returns",
        "cohort_sales",
    ),
)
def q_orphan_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Returns without a matching sale."""
    return dq.orphan_returns(fx.returns(spark, sf), fx.cohort_sales(spark, sf))


@query("returns_files", fx.with_fixtures("SELECT AWB, left(AWB, 1) AS reason FROM returns", "returns"))
def q_returns_files(spark: SparkSession, sf: str) -> DataFrame:
    """S5, then S2 / U2: the return list written as CSV files under three
    headers, with the columns in different order, and read back as one."""
    codes = fx.returns(spark, sf).withColumn("reason", F.left("AWB", F.lit(1)))
    folder = scratch_path(spark, f"returns-{uuid.uuid4().hex}")
    part = F.pmod(F.xxhash64("AWB"), F.lit(3))
    for n, columns in enumerate((["AWB", "reason"], ["reason", "AWB#"], ["Tracking Id", "reason"])):
        layout = [F.col("reason") if c == "reason" else F.col("AWB").alias(c) for c in columns]
        write_csv(codes.filter(part == n).select(*layout), f"{folder}/{n}")
    return read_csv_folder(spark, folder, ["AWB", "AWB#", "Tracking Id"], "AWB", recursive=True).select("AWB", "reason")


@query("eta_file", fx.with_fixtures("SELECT region, eta_days, priority FROM eta", "eta"))
def q_eta_file(spark: SparkSession, sf: str) -> DataFrame:
    """The delivery times as a CSV file, read with a schema and named by position."""
    path = scratch_path(spark, f"eta-{uuid.uuid4().hex}")
    write_csv(fx.eta(spark, sf), path)
    read = read_csv(spark, path, "r string, e int, p int")
    return edge(name_columns(read, ["region", "eta_days", "priority"]))
