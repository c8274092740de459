"""Small helpers: JDBC options, shared folder, staged lookups, first-per-key,
null profile, value counts."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from custlens.operators.common import first_per_key, null_profile, value_counts
from custlens.session import checkpoint_dir, staged
from custlens.sources.tables import jdbc_options


def test_partitioned_jdbc_read_needs_bounds():
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://unused/db", "sales", partition_column="id")


def test_jdbc_query_goes_in_as_a_subquery():
    for query in ("SELECT a FROM t;", " with x as (select 1) select * from x"):
        options = jdbc_options("u", query, "d", "2024-01-01", "2024-02-01", 8, properties={"user": "x"})
        assert options["dbtable"] == f"({query.strip().rstrip(';')}) q" and "query" not in options
        assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("2024-01-01", "2024-02-01", "8")
        assert options["user"] == "x"
    assert jdbc_options("u", "sales")["dbtable"] == "sales"


def test_shared_folder_is_required_on_a_cluster():
    context = SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(get=lambda *_: None), getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        checkpoint_dir(session)


def test_staged_tables_have_a_known_size(spark):
    small = staged(spark.range(5).withColumnRenamed("id", "k"), "small")
    plan = spark.range(1000).withColumnRenamed("id", "k").join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_first_per_key_takes_total_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 3, "w")], "k string, p int, v string")
    got = {r["k"]: r["v"] for r in first_per_key(df, ["k"], [F.col("p").isNull(), F.col("p")]).collect()}
    assert got == {"a": "y", "b": "w"}


def test_null_profile_and_value_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "x")], "a int, b string")
    prof = {r["column_name"]: (r["data_type"], r["null_count"]) for r in null_profile(df).collect()}
    assert prof == {"a": ("int", 1), "b": ("string", 1)}
    vc = [(r["b"], r["n"]) for r in value_counts(df, ["b"]).collect()]
    assert vc == [("x", 2), (None, 1)]
