"""Scalar helpers against plain-Python statements of the same rules, on
generated inputs (each batch of examples is one Spark job)."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custlens.functions.dates import add_days_checked, elapsed_days, month_index, ts_literal
from custlens.functions.numeric import safe_int
from custlens.functions.text import canonical_name
from custlens.operators.rfm import repeat_order_score

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
AS_OF = dt.datetime(2024, 6, 1, 13, 0, 0)
stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 1, 1))


@SETTINGS
@given(st.lists(stamps, min_size=1, max_size=40))
def test_elapsed_days_is_floored(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")
    got = [r[0] for r in df.select(elapsed_days("ts", ts_literal(AS_OF))).collect()]
    assert got == [(AS_OF - v).days for v in values]


def _plus_days(text, n):
    """The F5 rule: strict YYYY-M-D text plus int(n) days, else None."""
    if text is None:
        return None
    try:
        d = dt.datetime.strptime(text, "%Y-%m-%d")
        return (d + dt.timedelta(days=int(n))).date()
    except (ValueError, TypeError):
        return None


date_texts = st.one_of(
    st.none(),
    st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 1, 1)).map(lambda d: d.isoformat()),
    st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 1, 1)).map(lambda d: f"{d.year}-{d.month}-{d.day}"),
    st.sampled_from(["0000-00-00", "2001-13-45", "zzz", "2024", "2024-05", "2024-01-05 10:00:00", " 2024-01-05"]),
)


@SETTINGS
@given(st.lists(st.tuples(date_texts, st.integers(min_value=-400, max_value=400)), min_size=1, max_size=40))
def test_add_days_matches_strptime_rule(spark, rows):
    df = spark.createDataFrame(rows, "d string, n int")
    got = [r[0] for r in df.select(add_days_checked("d", "n")).collect()]
    assert got == [_plus_days(d, n) for d, n in rows]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-3, max_value=60)), min_size=1, max_size=40))
def test_repeat_score(spark, freqs):
    df = spark.createDataFrame([(f,) for f in freqs], "f bigint")
    got = [r[0] for r in df.select(repeat_order_score("f")).collect()]
    assert got == [f - 1 if f in (1, 2, 3, 4, 5) else 5 for f in freqs]


@SETTINGS
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=40))
def test_month_index(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(month_index("a", "b")).collect()]
    assert got == [(a.year - b.year) * 12 + a.month - b.month + 1 for a, b in pairs]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abcPRODUCTprodut 1", max_size=12)), min_size=1, max_size=40))
def test_canonical_rules(spark, names):
    rules = [("product", "PRODUCT"), ("t 1", "T-ONE")]

    def expected(name):
        if name is None:
            return None
        out = name
        for needle, canon in rules:
            if needle.lower() in out.lower():
                out = canon
        return out

    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(canonical_name("n", rules)).collect()]
    assert got == [expected(n) for n in names]


@SETTINGS
@given(
    st.lists(
        st.one_of(st.none(), st.sampled_from(["5", "5.7", "-2.9", "x", ""]), st.integers(-50, 50).map(str)),
        min_size=1,
        max_size=40,
    )
)
def test_safe_int_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(safe_int("v")).collect()]
    want = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").fillna(0).astype(int).tolist()
    assert got == want


def test_day_arithmetic_ignores_session_time_zone(spark):
    """Wall-clock rules must not move when the session zone has DST."""
    from custlens.functions.dates import hour_label, operational_day

    rows = [
        (dt.datetime(2001, 3, 1, 0, 0), dt.datetime(2001, 8, 1, 0, 0)),
        (dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 11, 2, 29, 59)),
        (dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 11, 4, 1, 30)),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, as_of timestamp_ntz")
    cols = [
        elapsed_days("ts", F.col("as_of")).alias("d"),
        hour_label("ts").alias("h"),
        operational_day("ts").alias("o"),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = [tuple(r) for r in df.select(*cols).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    utc = [tuple(r) for r in df.select(*cols).collect()]
    assert la == utc
    assert [r[0] for r in utc] == [(b - a).days for a, b in rows]
    assert [r[1] for r in utc] == ["00:00", "02:00", "01:00"]
