"""Every registered query with oracle SQL must equal DuckDB on sf0.001, and
every rows-only query must run (the driver repeats this at sf0.01)."""

import os
import re
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import digest  # noqa: E402

from custlens.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
# The training-data operators have their own tests, in tests/llm.
ORACLE, QUERIES = (
    {n: q for n, q in found.items() if n != "pipeline" and not re.match(r"op\d+_", n)}
    for found in (entry.oracle_sql(), entry.queries())
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_is_registered_with_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 55


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, duck, name):
    got = digest(QUERIES[name](spark, SF).toPandas())
    want = digest(duck.execute(ORACLE[name]).df())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "customer_id", "cluster", "funnel", "product_name", "product_id",
        "last_shipment_date", "product_qty", "repeat_order", "province_id",
    ]
    assert df.count() > 0
