"""Staff KPIs by batches with state, against the batch operators over all rows."""

import datetime as dt
import random

import pytest

from custlens.operators import kpi
from custlens.sources import versions
from custlens.streaming import kpi_state

EVENTS = "event_id long, ts timestamp_ntz, staff_id long, event_type string, product int, value double"
START = dt.datetime(2024, 3, 1, 9)


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        ts = START + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 4))
        what = rng.choice(["signup", "purchase", "purchase", "view", None])
        out.append((i, rng.choice([ts] * 9 + [None]), rng.choice([7, 7, 7, 1, 2, None]), what, rng.choice([0, 1, 2, None]), rng.choice([None, 0.1, 19.99, -3.5])))
    return out


def table(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def check_kpis(grain, ev, staff):
    """The four KPIs of the state equal those of the rows it took."""
    assert table(kpi_state.leads_by_day_hour(grain)) == table(kpi.leads_by_day_hour(ev))
    assert table(kpi_state.conversion(grain)) == table(kpi.conversion(ev))
    assert table(kpi_state.product_contribution(grain)) == table(kpi.product_contribution(ev))
    assert table(kpi_state.staff_summary(grain, staff)) == table(kpi.staff_summary(ev, staff))


def test_rows_in_time_order_equal_the_batch_form(spark, tmp_path):
    data, path = sorted(rows(160), key=lambda r: r[1] or START), str(tmp_path / "s")
    staff = spark.createDataFrame([(7, "ann  lee"), (7, "Ann Lee"), (1, "bo")], "staff_id long, staff_name string")
    sizes = []
    for n, at in enumerate(range(0, 160, 40)):
        kpi_state.advance(spark.createDataFrame(data[at : at + 40], EVENTS), path, n)
        sizes.append(versions.read_version(spark, path).select("op_day").distinct().count())
    assert max(sizes) <= 3 and kpi_state.closed_days(spark, path).count() > 0
    kpi_state.finish(spark, path)
    assert versions.read_version(spark, path).count() == 0
    valid, bad = kpi.split_valid(spark.createDataFrame(data, EVENTS))
    check_kpis(kpi_state.closed_days(spark, path), kpi.restructure(valid), staff)
    assert table(kpi_state.rejects(spark, path)) == table(bad)


def test_every_row_is_counted_once_or_rejected(spark, tmp_path):
    data, path = rows(120, 5), str(tmp_path / "s")
    known, taken, mark = {r[0]: r for r in data}, [], None
    late = set()
    for n, at in enumerate(range(0, 120, 30)):
        part = data[at : at + 30]
        kpi_state.advance(spark.createDataFrame(part, EVENTS), path, n, grace=dt.timedelta(hours=5))
        good = [r for r in part if None not in r[1:5]]
        day_end = {r[0]: dt.datetime.combine((r[1] - dt.timedelta(hours=12, minutes=31)).date(), dt.time(12, 31)) + dt.timedelta(days=1) for r in good}
        late |= {r[0] for r in good if mark and day_end[r[0]] <= mark}
        counted = [r for r in good if r[0] not in late]
        taken += counted
        marks = [m for m in (mark, *(r[1] - dt.timedelta(hours=5) for r in counted)) if m]
        mark = max(marks, default=None)
    kpi_state.finish(spark, path)
    got = kpi_state.rejects(spark, path).collect()
    assert late and {r.event_id for r in got if r.reason == "late"} == late
    assert {r.event_id for r in got} == set(known) - {r[0] for r in taken} and len(got) == len({r.event_id for r in got})
    staff = spark.createDataFrame([], "staff_id long, staff_name string")
    check_kpis(kpi_state.closed_days(spark, path), kpi.restructure(spark.createDataFrame(taken, EVENTS)), staff)


def test_the_end_of_a_day(spark, tmp_path):
    path = str(tmp_path / "s")
    event = lambda *ts: spark.createDataFrame([(1, t, 7, "signup", 1, None) for t in ts], EVENTS)
    none = dt.timedelta(0)

    def leads():
        return {str(r.op_day): r.leads for r in kpi_state.conversion(kpi_state.closed_days(spark, path)).collect()}

    kpi_state.advance(event(dt.datetime(2024, 3, 2, 12, 30, 59)), path, 0, none)
    assert kpi_state.closed_days(spark, path).count() == 0 and kpi_state.rejects(spark, path) is None
    kpi_state.advance(event(dt.datetime(2024, 3, 2, 12, 31)), path, 1, none)
    assert leads() == {"2024-03-01": 1}
    kpi_state.advance(event(dt.datetime(2024, 3, 2, 12, 30), dt.datetime(2024, 3, 2, 13)), path, 2, none)
    assert [r.reason for r in kpi_state.rejects(spark, path).collect()] == ["late"]
    kpi_state.finish(spark, path)
    assert leads() == {"2024-03-01": 1, "2024-03-02": 2}
    kpi_state.advance(event(dt.datetime(2024, 3, 2, 14)), path, 3, none)
    assert kpi_state.rejects(spark, path).count() == 2 and leads() == {"2024-03-01": 1, "2024-03-02": 2}


def test_repeated_and_failed_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    first, second = (spark.createDataFrame(rows(30, s), EVENTS) for s in (1, 2))
    wide = dt.timedelta(days=9)
    assert kpi_state.advance(first, path, 4, wide) == 1 == kpi_state.advance(first, path, 4, wide)
    n = kpi_state.rejects(spark, path).count()

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(versions, "_claim", die)
        with pytest.raises(RuntimeError, match="killed"):
            kpi_state.advance(second, path, 5, wide)
    assert kpi_state.rejects(spark, path).count() == n
    assert kpi_state.advance(second, path, 5, wide) == 2
    assert kpi_state.advance(first.limit(0), path, 6, wide) == 3
    kpi_state.finish(spark, path)
    staff = spark.createDataFrame([], "staff_id long, staff_name string")
    valid, bad = kpi.split_valid(first.unionAll(second))
    check_kpis(kpi_state.closed_days(spark, path), kpi.restructure(valid), staff)
    assert kpi_state.rejects(spark, path).count() == bad.count() > n
