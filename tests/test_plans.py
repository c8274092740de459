"""Plan-shape checks: the properties the design relies on at scale."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from custlens.operators import returns, rfm

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> Counter:
    return Counter(re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet", plan))


@pytest.fixture()
def staged_plans(monkeypatch):
    """The plans of all tables that the RFM operators stage, by name."""
    plans, stage = [], rfm.staged

    def noted(df, name):
        plans.append((name, _plan(df)))
        return stage(df, name)

    for module in (rfm, returns):
        monkeypatch.setattr(module, "staged", noted)
    return plans


@pytest.mark.parametrize("name", ["rfm", "repeat_order", "last_quantity", "funnel_two_pack", "cohort_revenue"])
def test_single_scan_of_the_fact_table(spark, staged_plans, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert sum(_scans(p)["lineitem"] for p in [plan, *[p for _, p in staged_plans]]) == 1


def test_rfm_shuffles_aggregates_only(spark, staged_plans):
    """Level 1 is one exchange of the sales; the return rule sums its rows and moves none of
    them; the two levels after it are one exchange each."""
    plan = _plan(entry.queries()["rfm"](spark, SF))
    staged = dict(staged_plans)
    assert staged.keys() == {"sale-days", "dropped-pairs"}
    for p in (plan, *staged.values()):
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and "Window" not in p
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2 and "SortMergeJoin" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", staged["sale-days"])) == 1
    assert len(re.findall(r"Exchange hashpartitioning", staged["dropped-pairs"])) == 1


def test_scan_is_pruned_and_filters_pushed(spark, staged_plans):
    entry.queries()["rfm"](spark, SF)
    plan = dict(staged_plans)["sale-days"]
    li = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet[^\n]*", plan)
    assert li is not None
    cols = li.group(1).split(",")
    assert len(cols) <= 8 and not any(c.startswith("l_comment") for c in cols)
    assert "PushedFilters: [IsNotNull(l_orderkey)" in li.group(0)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)))
def test_no_cross_join_or_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_segment_table_reads_sales_once(spark):
    # The flagship materialises its shared inputs; its final plan reads the
    # checkpoints only, never the sales tables again.
    plan = _plan(entry.queries()["customer_segments"](spark, SF))
    assert _scans(plan)["lineitem"] == 0


def test_pair_table_is_not_shuffled_by_product(spark):
    # Statistics, centres, names and product ids are staged tables of a row per
    # product, so that the pairs meet them by broadcast.
    plan = _plan(entry.queries()["customer_segments"](spark, SF))
    assert not re.search(r"hashpartitioning\(product_name", plan) and plan.count("BroadcastHashJoin") >= 4


@pytest.mark.parametrize("name", ["op_day_hour_leads", "conversion", "product_contribution", "points", "completion", "daily_achievement", "leaderboard"])
def test_kpis_do_not_read_the_directory(spark, name):
    assert _scans(_plan(entry.queries()[name](spark, SF)))["customer"] == 0


@pytest.mark.parametrize("name", ["funnel_single", "depletion", "churn_labels"])
def test_lookups_do_not_shuffle_rows_by_product(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = _plan(entry.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"hashpartitioning\((product|product_name|region)#", plan)
