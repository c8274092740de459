"""Properties from the test strategy on sf0.001."""

from pyspark.sql import functions as F

from custlens.functions.dates import ts_literal
from custlens.operators import churn_report as rep
from custlens.operators import kpi
from custlens.operators.cohort import cohort_retention, cohort_revenue
from custlens.operators.returns import exclude_high_return
from custlens.operators.rfm import calculate_rfm, repeat_order_score
from custlens.plans.q_churn import _labelled
from custlens.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_return_exclusion_is_idempotent(spark):
    sales = fx.sales(spark, SF)
    once = exclude_high_return(sales)
    again = exclude_high_return(once.withColumn("sale_status", F.lit(1)))
    assert once.count() == again.count()


def test_shares_sum_to_100(spark):
    share = rep.label_share(_labelled(spark, SF))
    sums = share.groupBy("product").agg(F.sum("percentage").alias("s")).collect()
    assert sums and all(abs(r["s"] - 100.0) < 1e-9 for r in sums)


def test_retention_at_index_one_is_one(spark):
    ret = cohort_retention(cohort_revenue(fx.cohort_sales(spark, SF)))
    firsts = ret.filter("cohort_index = 1").select("retention").collect()
    assert firsts and all(r[0] is None or abs(r[0] - 1.0) < 1e-12 for r in firsts)
    assert ret.filter("cohort_index < 1").count() == 0


def test_repeat_order_in_range(spark):
    rfm = calculate_rfm(exclude_high_return(fx.sales(spark, SF)), ts_literal(fx.SEGMENT_AS_OF))
    vals = {r[0] for r in rfm.select(repeat_order_score("frequency")).distinct().collect()}
    assert vals <= set(range(6))


def test_valid_plus_rejects_is_input(spark):
    act = fx.staff_activity(spark, SF)
    valid, rejects = kpi.split_valid(act)
    assert valid.count() + rejects.count() == act.count()


def test_operational_day_never_after_calendar_day(spark):
    ev = kpi.restructure(fx.staff_activity(spark, SF))
    assert ev.filter(F.col("op_day") > F.to_date("ts")).count() == 0
