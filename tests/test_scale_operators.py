"""Operators whose point is a plan that holds at any size, each forced at a small threshold
through the path that large tables take, and compared with the plain form."""

import csv
import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import kmeans, quantiles, ranking, returns, rfm, segment
from custlens.sources import versions
from custlens.sources.files import read_csv_folder

PAIRS = "customer_id long, product_name string, sale_status int, qty int"
POINTS = "customer_id long, product_name string, recency double, frequency double, monetary double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- K-Means: k-means|| seeds ------------------------------------------------


def blobs(spark, products=("P", "Q"), n=200, seed=1):
    """Five tight clusters off the diagonal, which diagonal seeds can't tell apart."""
    rng = random.Random(seed)
    rows = []
    for p in products:
        centres = [(rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(5)]
        rows += [(i, p, *[x + rng.gauss(0, 0.5) for x in centres[i % 5]]) for i in range(n)]
    return spark.createDataFrame(rows, POINTS)


def fitted(df, k=5):
    stats = segment.group_statistics(df)
    fixed, centres = segment.kmeans_fit(segment.scale_features(df, stats=stats), stats, k)
    return stats, fixed, centres


def cost_by_product(assigned):
    return {r.product_name: r.c for r in assigned.groupBy("product_name").agg(F.sum("distance").alias("c")).collect()}


def test_kmeans_is_no_worse_than_the_grid_and_reruns_are_equal(spark):
    df = blobs(spark)
    stats, fixed, centres = fitted(df)
    best = cost_by_product(segment.assign_nearest(fixed, centres))
    zs = [f"z_{f}" for f in segment.FEATURES]
    grid = kmeans.fixed_point(segment.grid_centroids(stats, 5), zs)
    seeds = cost_by_product(segment.assign_nearest(fixed, grid))
    from_grid = kmeans.fixed_point(segment.kmeans_centroids(segment.scale_features(df, stats=stats), segment.grid_centroids(stats, 5)), zs)
    settled = cost_by_product(segment.assign_nearest(fixed, from_grid))
    for p, c in best.items():
        assert c <= seeds[p] and c <= settled[p] * (1 + 1e-6)
        assert c < 0.05 * seeds[p]  # the clusters are found
    again = fitted(df.repartition(7, F.rand(3)))[2]
    assert sorted(map(tuple, centres.collect())) == sorted(map(tuple, again.collect()))


def test_kmeans_with_few_different_points(spark):
    rows = [(i, "P", float(i % 2), 1.0, 1.0) for i in range(20)] + [(1, "one", 3.0, 3.0, 3.0)]
    _, fixed, centres = fitted(spark.createDataFrame(rows, POINTS))
    assigned = segment.assign_nearest(fixed, centres)
    assert assigned.count() == 21 and all(c == 0 for c in cost_by_product(assigned).values())


def test_candidates_stay_few_and_draws_belong_to_rows(spark):
    df = blobs(spark, ("P",), 600)
    stats = segment.group_statistics(df)
    zs = [f"z_{f}" for f in segment.FEATURES]
    fixed = kmeans.fixed_point(segment.scale_features(df, stats=stats), zs)
    points = fixed.select("product_name", F.col("customer_id").cast("string").alias("_key"), *zs)
    found = kmeans.parallel_candidates(points, 5, 2, 3, 10.0, "product_name", zs)
    for r in found.groupBy("start").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect():
        assert 5 <= r.n <= 1 + 3 * 30 and r.w == 600
    u = spark.range(1000).select(kmeans.draw(F.col("id").cast("string"), F.lit(0), "x").alias("u"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 < low < 0.02 and 0.98 < high < 1 and 0.45 < mean < 0.55


# --- order statistics --------------------------------------------------------


def check_quantiles(spark, groups, fractions, bins):
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame([(g, x) for g, x in rows], "g string, x double")
    got = {r.g: (r.n, r.quantiles) for r in quantiles.exact_quantiles(df, ["x"], fractions, ["g"], bins).collect()}
    want = {}
    for g, xs in groups.items():
        xs = sorted((x for x in xs if x is not None), key=lambda x: (math.isnan(x), x))
        if xs:
            out = []
            for f in fractions:
                p = f * (len(xs) - 1)
                low, high = xs[math.floor(p)], xs[math.ceil(p)]
                out.append(low if low == high or (math.isnan(low) and math.isnan(high)) else low + (high - low) * (p - math.floor(p)))
            want[g] = (len(xs), out)
    assert got.keys() == want.keys()
    for g, (n, q) in want.items():
        assert got[g][0] == n
        np.testing.assert_allclose(got[g][1], q, rtol=1e-12, err_msg=str(g))


@pytest.mark.parametrize("bins", [2, 16, quantiles.BINS])
def test_quantiles_of_all_kinds_of_values(spark, bins):
    rng = random.Random(bins)
    groups = {
        None: [rng.uniform(-5, 5) for _ in range(101)],
        "ties": [1.0] * 50 + [2.0] * 49 + [None],
        "one": [3.5],
        "none": [None, None],
        "magnitudes": [s * 10.0**e for s in (-1, 1) for e in range(-300, 301, 40)] + [0.0, -0.0],
        "tiny": [5e-324 * i for i in range(6)],
        "special": [float("inf"), float("-inf"), float("nan"), 1.0, 2.0, float("inf"), float("nan")],
        "huge": [1.7e308, -1.7e308, 1.0],
    }
    fractions = [0.0, 0.25, 0.5, 1.0] if bins > 2 else [0.5]
    if bins == 2:
        groups = {g: groups[g] for g in ("ties", "magnitudes", None)}
    check_quantiles(spark, groups, fractions, bins)


def test_no_buffer_grows_with_the_rows(spark):
    df = spark.range(3000).select((F.col("id") * 0.37).alias("x"))
    values = quantiles._stacked(df, [], ["x"])
    found = quantiles.select_ranks(values, spark.createDataFrame([(("x",), 7), (("x",), 2999)], "_g struct<column_name: string>, rank long"), 8)
    assert {(r.rank, round(r.value, 6)) for r in found.collect()} == {(7, 2.59), (2999, round(2999 * 0.37, 6))}
    summary = quantiles.continuous_summary(df, ["x"], 8)
    assert not any(f in plan(summary) for f in ("percentile", "median(", "mode("))
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df, ["x"], [1.5])


# --- return rule -------------------------------------------------------------


def sales_rows(seed=0):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"]), rng.choice([1, 1, 3]), i) for i in range(600)]
    rows += [(7, "hot", 3 if i % 2 else 1, i) for i in range(400)]  # a third of all rows, half of them returned
    return rows + [(8, "hot", 3 if i % 3 == 0 else 1, i) for i in range(300)]


@pytest.mark.parametrize("above", [returns.FILTER_ABOVE, 0])
def test_return_rule_by_join_and_by_filter(spark, above):
    rows = sales_rows()
    count = {}
    for c, p, s, _ in rows:
        n, r = count.get((c, p), (0, 0))
        count[c, p] = (n + 1, r + (s == 3))
    bad = {k for k, (n, r) in count.items() if None not in k and n > 3 and 100 * r >= 50 * n}
    assert (7, "hot") in bad and (8, "hot") not in bad and len(bad) > 1
    df = spark.createDataFrame(rows, PAIRS)
    got = returns.exclude_high_return(df, filter_above=above)
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in df.drop("sale_status").collect() if (r.customer_id, r.product_name) not in bad)
    assert got.columns == ["customer_id", "product_name", "qty"]


def test_filter_has_no_false_negatives_and_leaves_most_rows_in_place(spark):
    pairs = spark.range(500).select(F.col("id").alias("customer_id"), F.lit("x").alias("product_name"))
    bits = returns.pair_filter(pairs, returns.KEYS, 128)
    word, mask = returns._word_and_mask(returns.KEYS, 128)
    rows = spark.range(5000).select(F.col("id").alias("customer_id"), F.lit("x").alias("product_name"))
    rows = rows.withColumn("w", word).withColumn("m", mask).join(bits, F.col("w") == F.col("word"), "left")
    hit = rows.where(F.coalesce(F.col("bits").bitwiseAND(F.col("m")) == F.col("m"), F.lit(False)))
    assert hit.where("customer_id < 500").count() == 500
    assert hit.where("customer_id >= 500").count() < 0.25 * 4500
    kept = returns.without_pairs(spark.range(5000).select(F.col("id").alias("customer_id"), F.lit("x").alias("product_name")), pairs, filter_above=0)
    assert kept.count() == 4500 and kept.where("customer_id < 500").count() == 0


def test_rfm_uses_the_same_rule_without_a_window(spark):
    rows = [(c, p, s, f"2024-01-{1 + i % 28:02d} 00:00:00", None, 1.0, 1) for i, (c, p, s, _) in enumerate(sales_rows())]
    schema = "customer_id long, product_name string, sale_status int, invoice_date string, last_shipment_date string, product_sales_total double, product_qty int"
    df = spark.createDataFrame(rows, schema)
    found = [
        rfm.summary_from_days(rfm.drop_high_return_days(rfm.day_rows(rfm.prepare_sales(df)), filter_above=above))
        for above in (returns.FILTER_ABOVE, 0)
    ]
    plain = rfm.pair_summary(rfm.prepare_sales(returns.exclude_high_return(df)))
    want = sorted(map(str, plain.select(*sorted(plain.columns)).collect()))
    for f in found:
        assert "Window" not in plan(f)
        assert sorted(map(str, f.select(*sorted(plain.columns)).collect())) == want


# --- ranks and row caps ------------------------------------------------------


@pytest.fixture()
def many_ranges(spark):
    """Small tables stay in several ranges, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("n", [0, 1, 499, 500, 777, 1000, 5000])
def test_row_cap_equals_limit(spark, many_ranges, n):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice([None, *range(30)]), i) for i in range(1000)], "v int, i int").repartition(4)
    want = [tuple(r) for r in df.orderBy("v", "i").limit(n).collect()]
    got = ranking.first_rows(df, ["v", "i"], n, small=0)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert got.columns == ["v", "i"]


def test_one_group_is_ranked_by_several_tasks(spark, many_ranges):
    df = spark.createDataFrame([("d", float(i % 700)) for i in range(2000)] + [(None, None), (None, 1.0), ("e", None)], "day string, v double")
    got = ranking.dense_ranks(df, ["day"], "v")
    assert "SinglePartition" not in plan(got)
    ranks = {(r.day, r.v): r["rank"] for r in got.collect()}
    assert all(ranks["d", float(v)] == 700 - v for v in range(700))
    assert ranks[None, 1.0] == 1 and ranks[None, None] == 2 and ranks["e", None] == 1 and len(ranks) == 703
    parts = ranking.by_range(df.distinct(), [F.col("day"), F.col("v").desc()], "t")
    assert parts.where("day = 'd'").select("_part").distinct().count() > 1


# --- versions ----------------------------------------------------------------


def numbers(df):
    return sorted(r.x for r in df.collect())


def table(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "x int")


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["save", "_write_text", "versions", "_names", "_claim"])
def test_a_writer_killed_at_any_step_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    with pytest.raises(versions.NoVersion):
        versions.read_version(spark, path)
    assert versions.publish_version(table(spark, 1, 2), path) == 1

    def die(*_):
        raise Killed

    with monkeypatch.context() as m:
        if step == "save":
            bad = table(spark, 1, 0).select(F.when(F.col("x") == 0, F.raise_error(F.lit("no"))).otherwise(F.lit("1")).cast("int").alias("x"))
            with pytest.raises(Exception, match="no"):
                versions.publish_version(bad, path)
        else:
            m.setattr(versions, step, die)
            with pytest.raises(Killed):
                versions.publish_version(table(spark, 9), path)
    assert numbers(versions.read_version(spark, path)) == [1, 2]
    assert versions.publish_version(table(spark, 3), path) == 2
    assert numbers(versions.read_version(spark, path)) == [3] and numbers(versions.read_version(spark, path, 1)) == [1, 2]


def test_broken_manifests_and_old_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(1, 4):
        assert versions.publish_version(table(spark, i), path) == i
    versions._write_text(spark, f"{path}/_versions/4.json", '{"folder": "da')
    assert numbers(versions.read_version(spark, path)) == [3]
    assert versions.publish_version(table(spark, 5), path) == 5
    (tmp_path / "t" / "data-orphan").mkdir()
    gone = versions.drop_old_versions(spark, path, keep=2, grace_seconds=0)
    assert len(gone) == 3 and "data-orphan" in gone
    assert sorted(versions.versions(spark, path)) == [3, 5]
    assert numbers(versions.read_version(spark, path)) == [5] and numbers(versions.read_version(spark, path, 3)) == [3]
    with pytest.raises(ValueError):
        versions.drop_old_versions(spark, path, keep=0)


def test_two_writers_get_two_numbers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    claim, first = versions._claim, []

    def slower(*a):
        if not first:
            first.append(1)
            versions.publish_version(table(spark, 1), path)  # the other writer is done just before
        return claim(*a)

    monkeypatch.setattr(versions, "_claim", slower)
    assert versions.publish_version(table(spark, 2), path) == 2
    assert numbers(versions.read_version(spark, path)) == [2] and numbers(versions.read_version(spark, path, 1)) == [1]


# --- CSV with line breaks in values ------------------------------------------

FILES = {
    "a.csv": 'id,note\n1,plain\n2,"two\nlines"\n\n3,"a ""quoted"" word\n\n\nand, a comma"\n4,x\n5,"\n"\n6,"last"',
    "b.csv": 'note,Id#\r\n"crlf\r\ninside",7\r\nend,8\r\n',
    "c.csv": 'id,"no\nte"\n9,"' + "long\n" * 12 + '"\n10,é\n',
}


@pytest.mark.parametrize("split", [1, 5, 1 << 20])
def test_csv_folder_equals_the_csv_module_however_it_is_split(spark, tmp_path, split):
    want = []
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode())
        header, *rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        header = ["id" if h == "Id#" else h for h in header]
        want += [tuple(dict(zip(header, r, strict=True)).get(c) for c in ("id", "note", "no\nte")) for r in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_csv_folder(spark, str(tmp_path), ["id", "Id#"], "id")
        got = [(r["id"], r["note"], r["no\nte"]) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(got, key=str) == sorted(want, key=str)
