"""The queries that SQL can express must equal DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from oracle_check import digest  # noqa: E402

from custlens.llm.oracles import ORACLE  # noqa: E402
from custlens.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(con.execute(ORACLE[name]).df())
