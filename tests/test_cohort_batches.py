"""Cohort batches: one shuffle of the state's months per batch, whatever their size."""

import random

import pytest
from pyspark.sql import functions as F

from custlens.operators import cohort, cohort_state
from custlens.sources import versions

SALES = "id long, invoice_date string, product_name string, product_sales_total double"


def rows(n, seed):
    rng = random.Random(seed)
    day = lambda: f"{rng.choice((2019, 2020))}-{rng.randint(1, 12):02d}-1{rng.randint(0, 9)}"
    return [(rng.choice([1, 1, 2, 3, None]), day(), rng.choice(["A", None]), rng.choice([None, 0.1, -2.5, 7.25])) for _ in range(n)]


def cells(df):
    found = df.withColumn("revenue", F.round("revenue", 6)).select("product_name", "cohort_month", "cohort_index", "revenue", "customers")
    return sorted(map(tuple, found.collect()), key=str)


def test_months_of_state_and_batch_are_shuffled_once(spark):
    months = spark.createDataFrame([(1, "A", "2020-01-01", 1, 1)], "customer long, product_name string, m string, a int, priced long").select(
        "customer", "product_name", F.col("m").cast("date").alias("invoice_month"), F.col("a").cast(cohort_state.AMOUNT).alias("amount"), "priced"
    )
    each = cohort_state._changes(cohort_state._with_old(months.where("priced > 1"), months))
    plan = each._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("few", [-1, 100])
@pytest.mark.parametrize("merge_after", [1, 9])
def test_large_and_small_batches_equal_one_run(spark, tmp_path, monkeypatch, few, merge_after):
    monkeypatch.setattr(cohort_state, "FEW", few)
    path, data = str(tmp_path / "state"), rows(120, merge_after)
    for i in range(3):
        cohort_state.add_batch(spark.createDataFrame(data[i * 40 : i * 40 + 40], SALES), path, str(i), merge_after=merge_after)
    everything = spark.createDataFrame(data, SALES)
    assert cells(cohort_state.cohort_cells(spark, path)) == cells(cohort.cohort_revenue(everything))
    logs = versions.versions(spark, path)[3]["note"]["logs"]
    assert len(logs) == min(3, merge_after)
    # Other columns of a merged log don't disturb: the next batch reads its sums.
    months = cohort_state._log(spark, path, logs, "months", cohort_state.month_sums(everything))
    per = lambda df: sorted(map(tuple, cohort_state._summed(df).collect()), key=str)
    assert per(months) == per(cohort_state.month_sums(everything))


def test_the_query_joins_lines_and_orders_once(spark, tmp_path, monkeypatch):
    from custlens.plans import q_cohort

    read = []
    sales = spark.createDataFrame([(*r, str(i)) for i, r in enumerate(rows(60, 4))], SALES + ", tracking_number string")
    count = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: count.add(1) or x, "string")
    monkeypatch.setattr(q_cohort.fx, "cohort_sales", lambda *_: read.append(1) or sales.withColumn("invoice_date", seen("invoice_date").alias("invoice_date")))
    found = q_cohort.q_cohort_incremental(spark, str(tmp_path))
    assert len(read) == 1 and found.count() == cohort.cohort_revenue(sales).count()
    assert count.value <= 2 * 60  # each row is made once (its date is used twice), not once a batch
