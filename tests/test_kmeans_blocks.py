"""K-Means over blocks of points: every point is in one block, and what numpy finds there is what a plain loop finds."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import kmeans, segment

POINTS = "customer_id long, product_name string, _key string, x double, y double"


def unpacked(found) -> list[tuple]:
    out = []
    for r in found.collect():
        x, y = (np.frombuffer(r[z], np.float64) for z in ("x", "y"))
        assert len(x) == len(y) == len(r._keys) == r._n
        out += [(r.product_name, k, *(None if np.isnan(v) else float(v) for v in p)) for k, *p in zip(r._keys, x, y, strict=True)]
    return sorted(out, key=str)


def test_blocks_hold_every_point_once(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "BLOCK", 50)
    rng = random.Random(5)
    rows = [(i, rng.choice(["P", "Q", "é", None]), f"k{i}", rng.choice([None, float(rng.randrange(99))]), float(i)) for i in range(700)]
    points = spark.createDataFrame(rows, POINTS).repartition(3)
    found = kmeans.blocks(points, "product_name", ["x", "y"])
    assert unpacked(found) == sorted([r[1:] for r in rows if r[1] is not None], key=str)
    assert found.agg(F.max("_n")).first()[0] <= 50 and found.count() < 60
    assert kmeans.blocks(found, "product_name", ["x", "y"]) is found


def test_nearest_with_ties_and_gaps():
    xs = [np.array([0.0, 5.0, 10.0, np.nan]), np.array([0.0, 0.0, 0.0, 1.0])]
    centres = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}]
    at, d2 = kmeans.nearest(xs, centres, ["x", "y"])
    assert at.tolist() == [0, 0, 1, 0]  # a tie, and a point without a distance, go to the first
    assert d2[:3].tolist() == [0, 25, 0] and np.isnan(d2[3])
    at, d2 = kmeans.nearest([x[:3] for x in xs], [*centres, {"x": None, "y": 0.0}], ["x", "y"])
    assert at.tolist() == [2, 2, 2] and np.isnan(d2).all()  # NULL comes before all numbers


def test_numpy_draws_are_those_of_the_column(spark):
    keys = ["", "a", "1|Brand#11", "é|ü", "x" * 200]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for start, step in ((0, "first"), (2, "3")):
        want = [r.u for r in df.select(kmeans.draw(F.col("k"), F.lit(start), step).alias("u")).collect()]
        assert kmeans._draws([k.encode() for k in keys], start, step).tolist() == want


@pytest.mark.parametrize("block", [7, 8_192])
def test_lloyd_equals_a_plain_loop(spark, monkeypatch, block):
    monkeypatch.setattr(kmeans, "BLOCK", block)
    rng, zs, unit = random.Random(9), ["x", "y"], kmeans.UNIT
    points = [(g, float(rng.randrange(-3 * unit, 3 * unit)), float(rng.randrange(-3 * unit, 3 * unit))) for g in "AB" for _ in range(90)]
    seeds = [(g, s, c, float(rng.randrange(-unit, unit)), float(rng.randrange(-unit, unit))) for g in "AB" for s in range(2) for c in range(3)]
    df = spark.createDataFrame([(g, f"{i}", x, y) for i, (g, x, y) in enumerate(points)], "g string, _key string, x double, y double")
    given = spark.createDataFrame(seeds, "g string, start int, cluster int, x double, y double")
    found = kmeans.lloyd(df, given, "g", zs, 100, 1e-4)
    got = {(r.g, r.start, r.cluster): (r.x, r.y) for r in found.collect()}
    for g in "AB":
        for s in range(2):
            centres, moving = [c[3:] for c in seeds if c[:2] == (g, s)], True
            while moving:
                members = [[] for _ in centres]
                for _, *p in (p for p in points if p[0] == g):
                    d2 = [sum((a - b) ** 2 for a, b in zip(c, p, strict=True)) for c in centres]
                    members[d2.index(min(d2))].append(p)
                new = [tuple(float(np.floor(sum(v) / len(m) + 0.5)) for v in zip(*m, strict=True)) if m else c for c, m in zip(centres, members, strict=True)]
                moving = sum((a - b) ** 2 for c, n in zip(centres, new, strict=True) for a, b in zip(c, n, strict=True)) > 1e-4 * unit * unit
                centres = new
            assert [got[g, s, c] for c in range(3)] == centres


def test_kmeans_check_leaves_the_rows_where_they_are(spark, tmp_path, monkeypatch):
    from custlens.plans import q_segments

    rng = random.Random(2)
    rows = [(i, p, rng.uniform(0, 9), rng.uniform(0, 9), rng.uniform(0, 9)) for p in ("P", "Q") for i in range(60)]
    scored = spark.createDataFrame(rows, "customer_id long, product_name string, recency double, frequency double, monetary double")
    monkeypatch.setattr(q_segments, "_scored", lambda *_: scored)
    found = q_segments.q_kmeans_check(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "customer_id" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert sorted(map(tuple, found.collect())) == [(p, 60, 60, 0, True) for p in ("P", "Q")]


def test_no_row_of_the_points_is_left_out(spark):
    rows = [(i, "P", float(i % 7), float(i % 11), float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "customer_id long, product_name string, recency double, frequency double, monetary double")
    stats = segment.group_statistics(df)
    fixed, centres = segment.kmeans_fit(segment.scale_features(df, stats=stats), stats, 5)
    assert segment.assign_nearest(fixed, centres).where("cluster is not null").count() == 500 and centres.count() == 5
