"""Cohorts brought forward batch by batch, against one full run over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from custlens.operators import cohort, cohort_state
from custlens.sources import versions

SALES = "id long, invoice_date string, product_name string, product_sales_total double"


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = rng.choice([f"{rng.choice((2019, 2020))}-{rng.randint(1, 12):02d}-0{rng.randint(1, 9)}"] * 8 + ["0000-00-00", None, "2020-13-40"])
        who = rng.choice([1] * 4 + [2, 3, 4, 5, None])  # one customer holds about half
        out.append((who, day, rng.choice(["A", "B", None]), rng.choice([None, 0.0, -2.5, 0.1, 19.99, 7.25])))
    return out


def cells(df):
    return sorted(
        ((r.product_name, r.cohort_month, r.cohort_index, None if r.revenue is None else round(r.revenue, 6), r.customers) for r in df.collect()),
        key=str,
    )


@pytest.mark.parametrize("merge_after", [1, 2, 99])
def test_batches_equal_one_run(spark, tmp_path, merge_after):
    data, path = rows(150, merge_after), str(tmp_path / "state")
    parts = [data[:40], [], data[40:41] * 2, data[41:]]
    for i, part in enumerate(parts):
        assert cohort_state.add_batch(spark.createDataFrame(part, SALES), path, f"b{i}", merge_after=merge_after) == i + 1
    everything = spark.createDataFrame([r for p in parts for r in p], SALES)
    assert cells(cohort_state.cohort_cells(spark, path)) == cells(cohort.cohort_revenue(everything))
    firsts = cohort.cohort_rows(everything).groupBy("customer", "product_name").agg(F.min("invoice_month").alias("cohort_month"))
    assert sorted(map(tuple, cohort_state.first_months(spark, path).collect()), key=str) == sorted(map(tuple, firsts.collect()), key=str)
    note = versions.versions(spark, path)[len(parts)]["note"]
    assert note["keys"] == ["b0", "b1", "b2", "b3"] and len(note["logs"]) <= merge_after


def test_a_first_month_moves_back(spark, tmp_path):
    path = str(tmp_path / "state")
    sale = lambda *days: spark.createDataFrame([(1, d, "A", 10.1) for d in days], SALES)
    cohort_state.add_batch(sale("2020-03-05", "2020-04-05"), path, "1")
    before = cells(cohort_state.cohort_cells(spark, path))
    assert [(str(m), i, n) for _, m, i, _, n in before] == [("2020-03-01", 1, 1), ("2020-03-01", 2, 1)]
    cohort_state.add_batch(sale("2020-01-31", "2020-04-01"), path, "2")
    after = cells(cohort_state.cohort_cells(spark, path))
    assert [(str(m), i, r, n) for _, m, i, r, n in after] == [("2020-01-01", 1, 10.1, 1), ("2020-01-01", 3, 10.1, 1), ("2020-01-01", 4, 20.2, 1)]
    assert cells(cohort_state.cohort_cells(spark, path, 1)) == before  # the old version stays readable


def test_keys_crashes_and_two_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    a, b = (spark.createDataFrame(rows(30, s), SALES) for s in (1, 2))
    assert cohort_state.add_batch(a, path, "a") == 1
    one = cells(cohort_state.cohort_cells(spark, path))
    assert cohort_state.add_batch(a, path, "a") == 1 and cells(cohort_state.cohort_cells(spark, path)) == one

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(versions, "_claim", die)
        with pytest.raises(RuntimeError, match="killed"):
            cohort_state.add_batch(b, path, "b")
    assert cells(cohort_state.cohort_cells(spark, path)) == one
    publish = versions.publish_version

    def other_first(df, *args, **kwargs):
        monkeypatch.setattr(versions, "publish_version", publish)
        cohort_state.add_batch(b, path, "b")
        return publish(df, *args, **kwargs)

    monkeypatch.setattr(versions, "publish_version", other_first)
    with pytest.raises(versions.VersionTaken):
        cohort_state.add_batch(b.limit(3), path, "c")
    assert cells(cohort_state.cohort_cells(spark, path)) == cells(cohort.cohort_revenue(a.unionAll(b)))
    used = set(versions.versions(spark, path)[2]["note"]["logs"])
    gone = cohort_state.drop_old_states(spark, path, keep=1, grace_seconds=0)
    assert len([x for x in gone if x.startswith("log-")]) == 2 and not used & set(gone)
    assert cells(cohort_state.cohort_cells(spark, path)) == cells(cohort.cohort_revenue(a.unionAll(b)))


def test_an_empty_state(spark, tmp_path):
    path = str(tmp_path / "state")
    with pytest.raises(versions.NoVersion):
        cohort_state.first_months(spark, path)
    assert cohort_state.add_batch(spark.createDataFrame([], SALES), path, "none") == 1
    assert cohort_state.cohort_cells(spark, path).count() == 0 and cohort_state.first_months(spark, path).count() == 0
