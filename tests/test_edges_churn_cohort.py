"""Hand-worked edge cases (FIXTURES §3) for cohort, churn, text and KPIs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from custlens.functions.dates import add_days_checked, operational_day, ts_literal
from custlens.functions.text import clean_region, strip_suffix_token
from custlens.operators import churn_report as rep
from custlens.operators.churn import churn_label, churn_labels, receipt_dates
from custlens.operators.cohort import cohort_retention, cohort_revenue
from custlens.operators.returns import exclude_returned_tracking
from custlens.operators.textprep import transcripts

D = dt.datetime


def test_cohort_index_and_sentinel(spark):
    rows = [(1, "2023-11-05", "P", 10.0), (1, "2024-01-20", "P", 5.0), (2, "0000-00-00", "P", 99.0), (3, None, "P", 1.0)]
    df = spark.createDataFrame(rows, "id bigint, invoice_date string, product_name string, product_sales_total double")
    got = {(r["cohort_month"].isoformat(), r["cohort_index"]): r["revenue"] for r in cohort_revenue(df).collect()}
    assert got == {("2023-11-01", 1): 10.0, ("2023-11-01", 3): 5.0}


def test_zero_first_cohort_gives_null_ratio(spark):
    rev = spark.createDataFrame(
        [("P", dt.date(2024, 1, 1), 1, 0.0), ("P", dt.date(2024, 1, 1), 2, 5.0)],
        "product_name string, cohort_month date, cohort_index int, revenue double",
    )
    got = {r["cohort_index"]: r["retention"] for r in cohort_retention(rev).collect()}
    assert got == {1: None, 2: None}


def test_return_codes_with_null(spark):
    sales = spark.createDataFrame([(None,), ("a",), ("b",)], "tracking_number string")
    returns = spark.createDataFrame([(None,), ("a",)], "AWB string")
    kept = sorted([r[0] for r in exclude_returned_tracking(sales, returns).collect()], key=lambda x: (x is not None, x))
    assert kept == [None, "b"]


def test_eta_lookup_rules(spark):
    eta = spark.createDataFrame(
        [("Bandung", None, 1), ("Bogor", 3, 2), ("bogor", 9, 3)], "region string, eta_days int, priority int"
    )
    cust = spark.createDataFrame(
        [("Kab. Bandung", "2024-01-01"), ("Kota Bogor", "2024-01-01"), ("Nowhere", "2024-01-01")],
        "region string, invoice_date string",
    )
    got = {r["region"]: r["receipt_date"] for r in receipt_dates(cust, eta).collect()}
    assert got == {"bandung": None, "bogor": dt.date(2024, 1, 4), "nowhere": dt.date(2024, 1, 6)}


def test_region_text(spark):
    df = spark.createDataFrame([("Kab. Bandung",), ("Kota Bogor",)], "r string")
    assert [x[0] for x in df.select(clean_region("r")).collect()] == ["bandung", "bogor"]


def test_bad_dates(spark):
    df = spark.createDataFrame([(None,), ("zzz",), ("2024-1-5",), ("2024-01-05 10:00:00",), ("2001-13-45",)], "d string")
    got = [r[0] for r in df.select(add_days_checked("d", F.lit(2))).collect()]
    assert got == [None, None, dt.date(2024, 1, 7), None, None]


def test_churn_label_cases(spark):
    df = spark.createDataFrame([(None, 5), (-1, 5), (5, 5), (6, 5)], "interval bigint, dep bigint")
    got = [r[0] for r in df.select(churn_label(F.col("interval"), F.col("dep"))).collect()]
    assert got == ["Invalid", "Tidak", "Tidak", "Ya"]


def _labelled(spark):
    cust = spark.createDataFrame(
        [
            ("P", 2, "2024-01-01", "t1", "X", 1, 10.0),
            ("P", 1, "0000-00-00", "t2", "X", 1, 10.0),
            ("P", 1, None, "t3", "X", 1, 10.0),
            ("Q", 3, "2024-03-01", "t4", "X", 2, 20.0),
            ("Q", 1, "2024-01-01", "t5", "X", 1, 5.0),
        ],
        "product string, quantity int, invoice_date string, tracking_code string, region string, boxes int, monetary double",
    )
    returns = spark.createDataFrame([("t5",)], "return_code string")
    eta = spark.createDataFrame([("x", 2, 1)], "region string, eta_days int, priority int")
    days = spark.createDataFrame([("P", 10)], "product_name string, days_per_unit int")
    return churn_labels(cust, returns, eta, days, ts_literal("2024-02-01 00:00:00"))


def test_churn_pipeline(spark):
    got = {r["tracking_code"]: (r["interval"], r["depletion_days"], r["churn"]) for r in _labelled(spark).collect()}
    # t1: receipt 2024-01-03, interval 29, 20 days of stock → Ya
    # t2: sentinel dropped; t3: NULL date → Invalid; t4: future receipt → Tidak; t5: returned
    assert got == {"t1": (29, 20, "Ya"), "t3": (None, 10, "Invalid"), "t4": (-31, 0, "Tidak")}


def test_modes_and_summary(spark):
    df = spark.createDataFrame([("P", v) for v in (5, 5, 6, 6, 7)], "product string, interval bigint")
    modes = rep.interval_modes(df).first()["modes"]
    assert modes == [5, 6]
    summ = rep.column_summary(df, "interval").first()
    assert (summ["mode"], summ["mean"], summ["median"], summ["min"], summ["max"]) == (5, 5, 6.0, 5, 7)


def test_invalid_intervals_in_statistics(spark):
    df = spark.createDataFrame([("P", 10), ("P", None)], "product string, interval bigint")
    assert rep.interval_stats(df, invalid_as_zero=True).first()["mean"] == 5.0
    assert rep.interval_stats(df, invalid_as_zero=False).first()["mean"] == 10.0


def test_dense_share_keeps_zero(spark):
    df = spark.createDataFrame([("P", "Ya"), ("P", "Tidak")], "product string, churn string")
    dense = {r["churn"]: r["percentage"] for r in rep.label_share_dense(df).collect()}
    sparse = {r["churn"]: r["percentage"] for r in rep.label_share(df).collect()}
    assert dense == {"Invalid": 0.0, "Tidak": 50.0, "Ya": 50.0}
    assert sparse == {"Tidak": 50.0, "Ya": 50.0}


def test_box_numbers(spark):
    df = spark.createDataFrame([("P", v) for v in (1, 2, 3, 4, 100)], "product string, interval bigint")
    r = rep.interval_box(df).first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"]) == (2.0, 3.0, 4.0, 1, 4, 1)


def test_end_token(spark):
    df = spark.createDataFrame([("hi</s>",), ("hi",)], "t string")
    assert [r[0] for r in df.select(strip_suffix_token("t", "</s>")).collect()] == ["hi", "hi"]


def test_chat_drops_trailing_empty_reply(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "u1"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"), (1, 3, "assistant", "")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    msgs = transcripts(turns).first()["messages"]
    assert [(m["role"], m["content"]) for m in msgs] == [("user", "u1"), ("assistant", "a1"), ("user", "u2")]


def test_operational_day(spark):
    df = spark.createDataFrame([(D(2024, 5, 31, 12, 30, 59),), (D(2024, 5, 31, 12, 31, 0),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(operational_day("ts")).collect()]
    assert got == [dt.date(2024, 5, 30), dt.date(2024, 5, 31)]


def test_receipt_only_missing_flag(spark):
    eta = spark.createDataFrame([("x", 2, 1)], "region string, eta_days int, priority int")
    cust = spark.createDataFrame(
        [("X", "2024-01-01", dt.date(2024, 1, 10)), ("X", "2024-01-01", None)],
        "region string, invoice_date string, receipt_date date",
    )
    overwrite = [r["receipt_date"] for r in receipt_dates(cust, eta).collect()]
    keep = [r["receipt_date"] for r in receipt_dates(cust, eta, only_missing=True).collect()]
    assert overwrite == [dt.date(2024, 1, 3), dt.date(2024, 1, 3)]
    assert keep == [dt.date(2024, 1, 10), dt.date(2024, 1, 3)]


def test_keyword_filter_date_range_and_cap(spark):
    from custlens.operators.textprep import keyword_filter

    rows = [
        (1, D(2024, 1, 1), "I love #vegan food"),
        (2, D(2024, 3, 1), "#Vegan again"),
        (3, D(2024, 9, 1), "#vegan too late"),
        (4, D(2024, 2, 1), "nonvegan words only"),
        (5, D(2024, 2, 2), "#plantbased lunch"),
    ]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, text string")
    hits = keyword_filter(df, ["#vegan", "#plantbased"], ts_col="ts", since="2024-01-01", until="2024-08-15")
    assert sorted(r["id"] for r in hits.collect()) == [1, 2, 5]
    capped = keyword_filter(df, ["#vegan", "#plantbased"], ts_col="ts", since="2024-01-01", until="2024-08-15", limit=2, order_by=["id"])
    assert [r["id"] for r in capped.collect()] == [1, 2]


def test_chat_long_form(spark):
    from custlens.operators.textprep import transcript_messages

    turns = spark.createDataFrame(
        [(1, 0, "user", "u1"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"), (1, 3, "assistant", ""), (2, 0, "user", "x")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    got = sorted((r["conv_id"], r["turn"]) for r in transcript_messages(turns).collect())
    assert got == [(1, 0), (1, 1), (1, 2), (2, 0)]


def test_cells_beyond_the_horizon_fail(spark):
    from custlens.operators.cohort import cohort_matrix

    cells = spark.createDataFrame(
        [("P", "2024-01", 1, 10.0), ("P", "2024-01", 5, 7.0)], "product_name string, cohort_month string, cohort_index int, revenue double"
    )
    wide = cohort_matrix(cells, 5).first()
    assert (wide["1"], wide["2"], wide["5"]) == (10.0, None, 7.0)
    with pytest.raises(Exception, match="outside of the horizon"):
        cohort_matrix(cells, 3).collect()


def test_repeated_directory_rows_do_not_double_events(spark):
    from custlens.operators.kpi import restructure, staff_summary

    events = spark.sql("SELECT timestamp_ntz'2024-01-01 13:00:00' AS ts, 7 AS staff_id, 'signup' AS event_type, 1 AS product, 0.0D AS value")
    staff = spark.createDataFrame([(7, "b x"), (7, "a  x")], "staff_id int, staff_name string")
    row = staff_summary(restructure(events), staff).first()
    assert (row["leads"], row["staff_name"]) == (1, "A X")


def test_trailing_empty_reply_is_removed_by_one_rule(spark):
    from custlens.operators.textprep import transcript_messages, transcripts

    rows = [(1, 1, "user", "u"), (1, 2, "assistant", "x"), (1, 2, "assistant", ""), (2, 1, "user", "u"), (2, 2, "assistant", ""), (3, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    long = transcript_messages(turns).groupBy("conv_id").count().collect()
    wide = transcripts(turns).collect()
    assert {r["conv_id"]: r["count"] for r in long} == {r["conv_id"]: len(r["messages"]) for r in wide if r["messages"]} == {1: 3, 2: 1}
