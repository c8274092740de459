"""Hand-worked edge cases (FIXTURES §3) for returns, RFM, funnel, segments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from custlens.functions.dates import months_before, ts_literal
from custlens.operators.funnel import funnel_single_pack, funnel_stage, funnel_two_pack
from custlens.operators.returns import exclude_high_return
from custlens.operators.rfm import calculate_rfm, repeat_order_score
from custlens.operators.segment import (
    NotConverged,
    assign_nearest,
    grid_centroids,
    group_statistics,
    hibernate,
    kmeans_centroids,
    name_clusters,
    scale_features,
)

SALES = (
    "customer_id bigint, last_shipment_date timestamp_ntz, invoice_date timestamp_ntz, product_sales_total double, "
    "product_name string, product_id int, product_qty int, province_id int, sale_status int, pack string"
)
D = dt.datetime


def _sales(spark, rows):
    full = []
    for r in rows:
        base = dict(
            customer_id=1,
            last_shipment_date=D(2024, 1, 1),
            invoice_date=D(2024, 1, 1),
            product_sales_total=10.0,
            product_name="P",
            product_id=1,
            product_qty=1,
            province_id=1,
            sale_status=1,
            pack="small",
        )
        base.update(r)
        full.append(tuple(base[c.split()[0]] for c in SALES.split(", ")))
    return spark.createDataFrame(full, SALES)


def test_return_share_exactly_half_drops_pair(spark):
    df = _sales(spark, [{"sale_status": 3}, {"sale_status": 3}, {}, {}])
    assert exclude_high_return(df).count() == 0


def test_few_rows_kept_even_if_all_returned(spark):
    df = _sales(spark, [{"sale_status": 3}] * 3)
    assert exclude_high_return(df).count() == 3


def test_null_key_survives_c1_and_is_dropped_by_c2(spark):
    df = _sales(spark, [{"customer_id": None, "sale_status": 3}] * 5)
    kept = exclude_high_return(df)
    assert kept.count() == 5
    assert calculate_rfm(kept, ts_literal("2024-02-01 00:00:00")).count() == 0


def test_missing_shipment_is_invoice_plus_five_days(spark):
    df = _sales(spark, [{"last_shipment_date": None, "invoice_date": D(2024, 1, 1)}])
    row = calculate_rfm(exclude_high_return(df), ts_literal("2024-02-01 00:00:00")).first()
    assert row["last_shipment_date"] == D(2024, 1, 6)


def test_recency_in_future_is_clamped(spark):
    df = _sales(spark, [{"last_shipment_date": D(2024, 1, 2, 12)}])
    row = calculate_rfm(df, ts_literal("2024-01-01 13:00:00")).first()
    assert row["recency"] == 0


def test_tie_on_latest_date_takes_largest_quantity(spark):
    df = _sales(spark, [{"product_qty": 2}, {"product_qty": 5}, {"product_qty": 9, "last_shipment_date": D(2023, 1, 1)}])
    row = calculate_rfm(df, ts_literal("2024-02-01 00:00:00")).first()
    assert (row["product_qty"], row["frequency"], row["monetary"]) == (5, 3, 30.0)


def test_canonical_rule(spark):
    df = _sales(spark, [{"product_name": "xProDUCT 1"}])
    row = calculate_rfm(df, ts_literal("2024-02-01 00:00:00"), canonical_rules=[("PRODUCT", "PRODUCT")]).first()
    assert row["product_name"] == "PRODUCT"


def test_two_packs_on_latest_day(spark):
    df = _sales(
        spark,
        [
            {"pack": "small", "product_qty": 2},
            {"pack": "large", "product_qty": 1},
            {"pack": "large", "product_qty": 7, "last_shipment_date": D(2023, 6, 1)},
        ],
    )
    packs = spark.createDataFrame([("P", "small", 6), ("P", "large", 10)], "product_name string, pack string, days_per_unit int")
    row = funnel_two_pack(df, packs, ts_literal("2024-01-23 00:00:00")).first()
    assert row["depletion_date"] == D(2024, 1, 23)
    assert row["funnel"] == "Hot"


def test_month_clip(spark):
    v = spark.range(1).select(months_before(ts_literal("2024-05-31 00:00:00"), 3).alias("d")).first()["d"]
    assert v == D(2024, 2, 29)


@pytest.mark.parametrize(
    "dep, expected",
    [("2024-05-31 00:00:00", "Hot"), ("2024-02-29 00:00:00", "Warm"), ("2024-02-28 23:59:59", "Cold"), (None, "Cold")],
)
def test_funnel_boundaries(spark, dep, expected):
    col = ts_literal(dep) if dep else F.lit(None).cast("timestamp_ntz")
    got = spark.range(1).select(funnel_stage(col, ts_literal("2024-05-31 00:00:00")).alias("f")).first()["f"]
    assert got == expected


def test_single_pack_unknown_product_is_cold(spark):
    rfm = spark.createDataFrame(
        [(1, "Q", D(2024, 1, 1), 3)], "customer_id bigint, product_name string, last_shipment_date timestamp_ntz, product_qty int"
    )
    days = spark.createDataFrame([("P", 7)], "product_name string, days_per_unit int")
    row = funnel_single_pack(rfm, days, ts_literal("2024-01-02 00:00:00")).first()
    assert row["depletion_date"] is None and row["funnel"] == "Cold"


def test_repeat_score(spark):
    df = spark.createDataFrame([(f,) for f in (1, 2, 5, 6, 40)], "frequency bigint")
    got = [r[0] for r in df.select(repeat_order_score("frequency")).collect()]
    assert got == [0, 1, 4, 5, 5]


def test_cluster_names_and_overrides(spark):
    rows = [
        ("P", 0, 6), ("P", 0, 6),
        ("P", 1, 2), ("P", 1, 2),
        ("P", 2, 1), ("P", 2, 2),
        ("P", 3, None),
    ]
    df = spark.createDataFrame(rows, "product_name string, cluster int, frequency bigint")
    got = {(r["cluster_id"], r["frequency"]): r["cluster"] for r in name_clusters(df).collect()}
    assert got[(0, 6)] == "Champion"
    assert got[(1, 2)] == "Loyal"
    assert got[(2, 1)] == "Potential Loyal"
    assert got[(3, None)] == "At Risk"
    override = spark.createDataFrame([("P", 1, 6), ("P", 1, 2), ("P", 1, 2)], "product_name string, cluster int, frequency bigint")
    assert {r["frequency"]: r["cluster"] for r in name_clusters(override).collect()}[6] == "Champion"
    h = spark.createDataFrame([("Potential Loyal", "Cold"), ("Potential Loyal", "Warm")], "cluster string, funnel string")
    assert [r[0] for r in hibernate(h).collect()] == ["Hibernate", "Potential Loyal"]


def test_zero_variance_scales_to_zero(spark):
    df = spark.createDataFrame(
        [(1, "P", 5, 1, 1.0), (2, "P", 5, 2, 2.0)],
        "customer_id bigint, product_name string, recency bigint, frequency bigint, monetary double",
    )
    rows = scale_features(df).orderBy("customer_id").collect()
    assert [r["z_recency"] for r in rows] == [0.0, 0.0]
    assert [r["z_frequency"] for r in rows] == [-1.0, 1.0]


def test_fewer_rows_than_k(spark):
    df = spark.createDataFrame(
        [(i, "P", float(i), float(i), float(i)) for i in range(3)],
        "customer_id bigint, product_name string, recency double, frequency double, monetary double",
    )
    stats = group_statistics(df)
    scaled = scale_features(df, stats=stats)
    assigned = assign_nearest(scaled, kmeans_centroids(scaled, grid_centroids(stats, 5)))
    assert assigned.count() == 3 and assigned.select("cluster").distinct().count() <= 3


def test_kmeans_fails_when_it_does_not_settle(spark):
    df = spark.createDataFrame(
        [(i, "P", float(i * i), float(i % 7), float(i % 3)) for i in range(40)],
        "customer_id bigint, product_name string, recency double, frequency double, monetary double",
    )
    stats = group_statistics(df)
    with pytest.raises(NotConverged):
        kmeans_centroids(scale_features(df, stats=stats), grid_centroids(stats, 5), max_rounds=1)
