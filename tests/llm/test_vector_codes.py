"""Operator 13 against plain Lloyd rounds on Python integers."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from custlens.llm import vector_codes

ROWS = "vec_id long, embedding array<float>, label int, row string, POS int, code string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "r", 1, "c") for i, v, label in rows], ROWS)


def slow(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = [len(v) for _, v, _ in kept if v and len(v) % parts == 0]
    length = max(Counter(usable).items(), key=lambda x: (x[1], x[0]))[0] if usable else 0
    whole = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in kept if length and len(v) == length]
    w = length // parts
    seeds = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[s[1][p * w : (p + 1) * w] for s in seeds] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _ in whole:
            for p in range(parts):
                x = v[p * w : (p + 1) * w]
                members[p, nearest(p, x)[1]].append(x)
        books = [
            [[sum(c) // len(m) for c in zip(*m, strict=True)] if (m := members.get((p, e))) else old for e, old in enumerate(book)]
            for p, book in enumerate(books)
        ]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, by_label = [], Counter()
    for i, v, label in whole:
        found = [nearest(p, v[p * w : (p + 1) * w]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    odd = [(i, None, None, label) for i, v, label in kept if not (length and len(v) == length)]
    some = {label for *_, label in out}
    return Counter((i, c, e, by_label[label] if label in some else None, digest) for i, c, e, label in out + odd)


def vectors(n, dim=16, seed=0, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(7)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        v = [float(f"{x + spread * rng.gauss(0, 0.2):.4f}") for x in c]
        rows.append((i, v, rng.choice([None, 1, 2, 3])))
    return rows


def as_floats(rows):
    import numpy as np

    return [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def check(spark, rows, **settings):
    got = vector_codes.report(frame(spark, rows), **settings).collect()
    want = {k: v for k, v in settings.items() if k in ("parts", "entries", "rounds", "scale")}
    assert Counter(tuple(r) for r in got) == slow(as_floats(rows), **want)


@pytest.mark.parametrize("owner_rows", [vector_codes.OWNER_ROWS, 7])
def test_equals_plain_rounds(spark, owner_rows):
    rows = vectors(300)
    rows += [(301, None, 1), (302, [1.0, None] + [0.0] * 14, 1), (303, [float("nan")] * 16, None), (304, [float("inf")] + [0.0] * 15, 2)]
    check(spark, rows, owner_rows=owner_rows)


def test_one_vector_holds_most_rows_and_ids_repeat(spark):
    same = [0.25, -0.5] * 8
    rows = vectors(60, seed=2) + [(1000 + i, same, 5) for i in range(200)] + [(None, same, None)] * 5 + [(3, same, 1), (3, [0.0] * 16, 1)]
    check(spark, rows, owner_rows=16)


def test_fewer_rows_than_entries_and_ties(spark):
    check(spark, vectors(5, dim=8, seed=3))
    check(spark, [(i, [float(i % 2)] * 8, i % 2) for i in range(40)])


def test_large_components_are_exact(spark):
    rows = [(i, [x * 1000.0 for x in v], label) for i, v, label in vectors(80, seed=4)]
    check(spark, rows, scale=1 << 12)
    check(spark, [(i, [x * 30.0 for x in v], label) for i, v, label in vectors(40, seed=5)], parts=4, entries=3, rounds=2)


def test_odd_lengths_stay_without_a_code(spark):
    check(spark, [*vectors(40, seed=6), (100, [], 1), (101, [1.0] * 9, 9), (102, [1.0] * 8, 1)])
    got = vector_codes.report(frame(spark, [(1, [1.0, 2.0], 1), (2, [], None)])).collect()
    assert {(r.vec_id, r.code, r.error, r.label_error) for r in got} == {(1, None, None, None), (2, None, None, None)}


def test_empty_table(spark):
    empty = frame(spark, [(1, None, 1)])
    assert vector_codes.report(empty).count() == 0
    assert vector_codes.report(empty.limit(0)).count() == 0


def test_only_changing_parts_are_shuffled(spark):
    """Two well separated groups settle at once: the later steps move nothing."""
    rows = [(i, [float(100 * (i % 2)) + 0.001 * i] * 8, 1) for i in range(64)]
    usable = vector_codes.kept_vectors(frame(spark, rows)).selectExpr("vec_id AS row", "*")
    books, home = vector_codes.fit(usable, 8, entries=2, rounds=4)
    assert home.table().count() == 64 * 8
    moved = [p for p in home.paths if "moved=" not in p]
    assert len(moved) == 1 and spark.read.schema(home.schema).parquet(moved[0]).count() == 0
    home.drop()
