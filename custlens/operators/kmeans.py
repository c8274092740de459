"""K-Means of all groups at once, seeded by k-means|| (M2).

* Coordinates are fixed-point: scaled features as whole millionths, kept in doubles.
  Sums of coordinates and of (truncated) squared distances are sums of integers, so
  they don't depend on the order in which tasks deliver them: reruns are equal.
* Random numbers are digests of (seed, start, step, row key), not a generator's state:
  a task that runs again draws the same numbers, and no row needs a neighbour.
* Seeding, per group and start: the first candidate is the row with the least random
  number. Each round adds every row with probability ``oversample * d² / cost``, where d is
  its distance to the candidates so far and cost the sum of d². Candidates are
  weighted by the rows nearest to them, and k of them are drawn by weight * d².
  A start has about 1 + rounds * oversample candidates, however many rows there are.
* Lloyd rounds run for all groups and starts together. A start whose centres have
  settled takes part no more. The start with the least cost is kept; the grid seeds are
  a start too, so the result is never worse than what they lead to.

Points are packed once into blocks: rows of one group with up to ``BLOCK`` points as arrays
of doubles. A round reads the blocks, never moves them: the centres of a group join them
as one array, numpy finds the nearest centre of every point of a block, and a few sums per
(block, start, cluster) go on to Spark's aggregates. The driver only asks whether any start
is still moving.

A coordinate may be NULL (NaN in a block). Its distances are NULL, which come before
all numbers, so the point goes to the first cluster; sums leave the coordinate out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.session import staged

UNIT = 1_000_000
SEED = "custlens"
ROUNDS, STARTS = 3, 3
LOOK = 4
BLOCK = 8_192  # points of one group in a block
HELD = 1 << 18  # points that a task holds before it writes their blocks


class NotConverged(RuntimeError):
    pass


def fixed_point(scaled: DataFrame, zs: list[str]) -> DataFrame:
    """The columns ``zs`` rounded to whole millionths."""
    return scaled.withColumns({z: F.floor(F.col(z) * F.lit(float(UNIT)) + F.lit(0.5)).cast("double") for z in zs})


def draw(key: Column, start: Column, step: str | Column) -> Column:
    """A number in (0, 1) that belongs to the row, the start and the step."""
    step = F.lit(step) if isinstance(step, str) else step
    digest = F.md5(F.concat_ws("|", F.lit(SEED), start.cast("string"), step, key))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def _d2(a, b, zs: list[str]) -> Column:
    """Squared distance of two things with the fields ``zs``."""
    return reduce(lambda x, y: x + y, [(a[z] - b[z]) * (a[z] - b[z]) for z in zs])


def _cost(d2: np.ndarray) -> np.ndarray:
    """Squared distances in whole millionths of the scaled unit."""
    return np.floor(d2 / float(UNIT))


def blocks(points: DataFrame, group_col: str, zs: list[str]) -> DataFrame:
    """(group, _n, *zs, and _keys if the points have a _key): the points in blocks of one group,
    coordinates as bytes of doubles. A point without a group is in no block. What is
    packed already is returned as it is."""
    if "_n" in points.columns:
        return points
    keyed = "_key" in points.columns
    names = [group_col, "_n", *zs, *(["_keys"] if keyed else [])]

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        found = table.column(0).combine_chunks().dictionary_encode()
        codes = found.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        edges = np.flatnonzero(np.diff(codes[order])) + 1
        cuts = [(a, min(a + BLOCK, end)) for start, end in zip([0, *edges], [*edges, len(order)], strict=True) for a in range(start, end, BLOCK)]
        columns = [pa.array(codes[order[[a for a, _ in cuts]]]), pa.array([b - a for a, b in cuts], pa.int32())]
        columns[0] = found.dictionary.take(columns[0])
        for i in range(len(zs)):
            values = table.column(1 + i).to_numpy()[order].astype(np.float64)
            columns.append(pa.array([values[a:b].tobytes() for a, b in cuts], pa.binary()))
        if keyed:
            keys = table.column(1 + len(zs)).combine_chunks().take(pa.array(order))
            columns.append(pa.ListArray.from_arrays(pa.array([*(a for a, _ in cuts), len(order)], pa.int32()), keys))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= HELD:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    rows = points.where(F.col(group_col).isNotNull()).select(group_col, *zs, *(["_key"] if keyed else []))
    ddl = ", ".join([f"`{group_col}` {rows.schema[group_col].dataType.simpleString()}", "_n int", *[f"`{z}` binary" for z in zs]])
    return staged(rows.mapInArrow(run, ddl + (", _keys array<string>" if keyed else "")), "kmeans-points")


def _packed(centres: DataFrame, group_col: str, zs: list[str], *extra: str) -> DataFrame:
    """A row per group with the centres of its starts, and ``extra`` values of each start.
    Staged: the blocks join it by its size."""
    centre = F.struct(F.col("cluster"), *[F.col(z) for z in zs])
    by_start = centres.groupBy(group_col, "start").agg(*[F.max(x).alias(x) for x in extra], F.array_sort(F.collect_list(centre)).alias("_c"))
    return staged(by_start.groupBy(group_col).agg(F.collect_list(F.struct("start", *extra, "_c")).alias("_starts")), "kmeans-packed")


def nearest(coordinates: list[np.ndarray], centres: list[dict], zs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each point the number of the nearest centre (the first on ties) and its squared
    distance. ``centres`` come by ascending cluster."""
    best, at = None, np.zeros(len(coordinates[0]), np.int64)
    gaps = any(np.isnan(x).any() for x in coordinates)
    for j, c in enumerate(centres):
        centre = [np.nan if c[z] is None else c[z] for z in zs]
        d2 = reduce(lambda x, y: x + y, [(a - b) * (a - b) for a, b in zip(centre, coordinates, strict=True)])
        if gaps or any(np.isnan(a) for a in centre):
            d2[np.isnan(d2)] = -np.inf
        if best is None:
            best = d2
        else:
            closer = d2 < best
            at[closer] = j
            np.minimum(best, d2, out=best)
    best[np.isneginf(best)] = np.nan
    return at, best


def _each_block(points: DataFrame, packed: DataFrame, group_col: str, zs: list[str], keyed: bool, of: Callable, ddl: str) -> DataFrame:
    """(group, start, ...): the rows ``of(start, coordinates, nearest, d2, keys)`` of every block
    and every start of its group."""
    columns = [group_col, "_starts", *zs, *(["_keys"] if keyed else [])]
    joined = points.join(packed, group_col).select(*columns)
    group_type = joined.schema[group_col].dataType.simpleString()
    names = [x.split()[0].strip("`") for x in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, own = [], []
            for i in range(batch.num_rows):
                coordinates = [np.frombuffer(batch.column(2 + k)[i].as_buffer(), np.float64) for k in range(len(zs))]
                keys = [k.encode() for k in batch.column(2 + len(zs))[i].as_py()] if keyed else None
                for start in batch.column(1)[i].as_py():
                    at, d2 = nearest(coordinates, start["_c"], zs)
                    out += [(start["start"], *r) for r in of(start, coordinates, at, d2, keys)]
                own += [i] * (len(out) - len(own))
            if out:
                rest = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), *rest], names=[group_col, "start", *names])

    arrow = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    types = [pa.int32(), *(arrow[x.split()[-1]] for x in ddl.split(", "))]
    return joined.mapInArrow(run, f"`{group_col}` {group_type}, start int, {ddl}")


def _costs(points: DataFrame, packed: DataFrame, group_col: str, zs: list[str]) -> DataFrame:
    """(group, start, cost): the sum of the squared distances."""

    def of(start: dict, coordinates: list, at: np.ndarray, d2: np.ndarray, keys: None) -> list[tuple]:
        known = d2[~np.isnan(d2)]
        return [(int(_cost(known).astype(np.int64).sum()) if len(known) else None,)]

    each = _each_block(points, packed, group_col, zs, False, of, "cost long")
    return each.groupBy(group_col, "start").agg(F.sum(F.col("cost").cast("decimal(19,0)")).cast("double").alias("cost"))


def _draws(keys: list[bytes], start: int, step: str) -> np.ndarray:
    """``draw`` of each key."""
    front = f"{SEED}|{start}|{step}|".encode()
    digits = np.frombuffer(b"".join([hashlib.md5(front + k).digest()[:6] for k in keys]), np.uint8).reshape(-1, 6)
    return (digits.astype(np.float64) @ (256.0 ** np.arange(5, -1, -1)) + 0.5) / float(1 << 48)


def _first(points: DataFrame, starts: int, group_col: str, zs: list[str]) -> DataFrame:
    """(group, start, *zs, _key): the point with the least number of each start."""
    none = F.lit(None).cast("double")
    each = F.transform(F.sequence(F.lit(0), F.lit(starts - 1)), lambda s: F.struct(s.alias("start"), F.array(F.struct(F.lit(0).alias("cluster"), *[none.alias(z) for z in zs])).alias("_c")))
    begun = staged(points.select(group_col).distinct().withColumn("_starts", each), "kmeans-packed")

    def of(start: dict, coordinates: list, at: np.ndarray, d2: np.ndarray, keys: list[bytes]) -> list[tuple]:
        u = _draws(keys, start["start"], "first")
        i = min(np.flatnonzero(u == u.min()).tolist(), key=lambda n: keys[n])
        return [(float(u[i]), keys[i].decode(), *_point(coordinates, i))]

    found = _each_block(points, begun, group_col, zs, True, of, ", ".join(["_u double", "_key string", *[f"`{z}` double" for z in zs]]))
    return found.groupBy(group_col, "start").agg(F.min(F.struct("_u", "_key", *zs)).alias("c")).select(group_col, "start", *[f"c.{z}" for z in zs], "c._key")


def _point(coordinates: list[np.ndarray], i: int) -> list[float | None]:
    return [None if np.isnan(x[i]) else float(x[i]) for x in coordinates]


def parallel_candidates(
    points: DataFrame, k: int, starts: int, rounds: int, oversample: float, group_col: str, zs: list[str]
) -> DataFrame:
    """(group, start, cluster, *zs, _key, weight): the candidates of each start, numbered by
    step and key, with the number of rows nearest to each. ``points`` has (group, _key, *zs),
    or is their ``blocks``."""
    points = blocks(points, group_col, zs)
    found = staged(_first(points, starts, group_col, zs).withColumn("cluster", F.lit(0)), "kmeans-candidates")
    for r in range(1, rounds + 1):
        costs = staged(_costs(points, _packed(found, group_col, zs), group_col, zs), "kmeans-costs")

        def chosen(start: dict, coordinates: list, at: np.ndarray, d2: np.ndarray, keys: list[bytes], step: str = str(r)) -> list[tuple]:
            if start["cost"] is None:
                return []
            some = np.flatnonzero(_cost(d2) > 0)
            if not len(some):
                return []
            u = _draws([keys[i] for i in some], start["start"], step)
            some = some[u * start["cost"] < float(oversample) * _cost(d2[some])]
            return [(keys[i].decode(), *_point(coordinates, i)) for i in some.tolist()]

        packed = _packed(found.join(costs, [group_col, "start"]), group_col, zs, "cost")
        new = _each_block(points, packed, group_col, zs, True, chosen, ", ".join(["_key string", *[f"`{z}` double" for z in zs]]))
        found = staged(found.unionByName(new.withColumn("cluster", F.lit(r))), "kmeans-candidates")
    # Number the candidates of a start; a row that equals a candidate has d² = 0 and is never drawn again.
    listed = F.array_sort(F.collect_list(F.struct("cluster", "_key", *zs)))
    packed = found.groupBy(group_col, "start").agg(listed.alias("c")).select(group_col, "start", F.posexplode("c").alias("n", "c"))
    found = staged(packed.select(group_col, "start", F.col("n").alias("cluster"), *[f"c.{z}" for z in zs], "c._key"), "kmeans-candidates")

    def members(start: dict, coordinates: list, at: np.ndarray, d2: np.ndarray, keys: None) -> list[tuple]:
        n = np.bincount(at, minlength=len(start["_c"]))
        return [(c["cluster"], int(n[j])) for j, c in enumerate(start["_c"]) if n[j]]

    each = _each_block(points, _packed(found, group_col, zs), group_col, zs, False, members, "cluster int, n long")
    weights = each.groupBy(group_col, "start", "cluster").agg(F.sum("n").alias("weight"))
    return found.join(weights, [group_col, "start", "cluster"], "left").fillna(0, ["weight"])


def _sums(points: DataFrame, packed: DataFrame, group_col: str, zs: list[str]) -> DataFrame:
    """(group, start, cluster, n, *zs): members of each centre by block and the sums of their coordinates."""

    def of(start: dict, coordinates: list, at: np.ndarray, d2: np.ndarray, keys: None) -> list[tuple]:
        order = np.argsort(at, kind="stable")
        found, first, n = np.unique(at[order], return_index=True, return_counts=True)
        sums = []
        for x in coordinates:
            known = ~np.isnan(x)
            total = np.add.reduceat(np.where(known, x, 0).astype(np.int64)[order], first)
            some = np.add.reduceat(known.astype(np.int64)[order], first)
            sums.append([int(t) if s else None for t, s in zip(total, some, strict=True)])
        return [(start["_c"][j]["cluster"], int(m), *s) for j, m, s in zip(found, n, zip(*sums, strict=True), strict=True)]

    return _each_block(points, packed, group_col, zs, False, of, ", ".join(["cluster int", "n long", *[f"`{z}` long" for z in zs]]))


def reduced(candidates: DataFrame, k: int, group_col: str, zs: list[str]) -> DataFrame:
    """(group, start, cluster, *zs): k seeds of each start, drawn from its candidates one by one,
    the first by weight, the others by weight * d² to those drawn before: of racing clocks
    -ln(u) / rate the first to ring. Fewer different candidates than k give fewer seeds."""
    fields = ["cluster", "weight", "_key", *zs]
    packed = candidates.groupBy(group_col, "start").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("c"))

    def ring(c: Column, rate: Column, step: Column) -> Column:
        clock = -F.log(draw(c["_key"], F.col("start"), F.concat(F.lit("pick"), step.cast("string")))) / rate
        return F.struct(F.when(rate > 0, clock).alias("at"), c["cluster"].alias("n"), *[c[z].alias(z) for z in zs])

    def first_of(rings: Column) -> Column:
        return F.array_min(F.filter(rings, lambda x: x["at"].isNotNull()))

    def pick(drawn: Column, step: Column) -> Column:
        def rate(c: Column) -> Column:
            return c["weight"] * F.array_min(F.transform(drawn, lambda d: _d2(c, d, zs)))

        return F.filter(
            F.concat(drawn, F.array(first_of(F.transform("c", lambda c: ring(c, rate(c), step))))), lambda x: x.isNotNull()
        )

    first = F.array(first_of(F.transform("c", lambda c: ring(c, c["weight"].cast("double"), F.lit(1)))))
    # The draws are a fold over the steps: a few dozen candidates stay in one row.
    drawn = F.aggregate(F.sequence(F.lit(2), F.lit(k)), first, pick) if k > 1 else first
    seeds = packed.select(group_col, "start", F.posexplode(drawn).alias("cluster", "s"))
    return seeds.select(group_col, "start", "cluster", *[f"s.{z}" for z in zs])


def _state(rows: DataFrame, group_col: str, zs: list[str], limit: float) -> DataFrame:
    """A row per group: its starts with their centres, and which of them move on. ``rows``
    has (group, start, cluster, *zs, _moving, _shift). Staged: the next round joins it by its size."""
    centre = F.struct("cluster", *zs)
    starts = rows.groupBy(group_col, "start").agg(
        F.array_sort(F.collect_list(centre)).alias("_c"), (F.max("_moving") & (F.sum("_shift") > F.lit(limit))).alias("_moving")
    )
    packed = starts.groupBy(group_col).agg(F.collect_list(F.struct("start", "_moving", "_c")).alias("_starts"))
    return staged(packed, "kmeans-round")


def lloyd(
    points: DataFrame, seeds: DataFrame, group_col: str, zs: list[str], max_rounds: int, tolerance: float
) -> DataFrame:
    """(group, start, cluster, *zs): the centres of every start, moved until their squared
    shifts, in scaled units, add up to no more than ``tolerance``. A centre is its members'
    mean in whole millionths; one that lost all members stays. A round is one write of the
    centres. Whether any start moves on is asked every ``LOOK`` rounds: a round without moving starts
    changes nothing."""
    points = blocks(points, group_col, zs)
    new = [f"_new_{z}" for z in zs]
    limit = tolerance * UNIT * UNIT
    state = _state(seeds.withColumns({"_moving": F.lit(True), "_shift": F.lit(limit + 1)}), group_col, zs, limit)
    for done in range(1, max_rounds + 1):
        open_ = F.filter("_starts", lambda s: s["_moving"])
        moving = state.select(group_col, open_.alias("_starts")).where(F.size("_starts") > 0)
        # A few rows per block, dealt by group once: all aggregates up to the state go on from there.
        sums = _sums(points, moving, group_col, zs).repartition(group_col).groupBy(group_col, "start", "cluster").agg(
            *[F.floor(F.sum(z) / F.sum("n") + F.lit(0.5)).cast("double").alias(n) for z, n in zip(zs, new, strict=True)]
        )
        had = state.select(group_col, F.inline("_starts")).select(group_col, "start", "_moving", F.inline("_c"))
        both = [(z, F.coalesce(F.col(n), F.col(z))) for z, n in zip(zs, new, strict=True)]
        shift = reduce(lambda a, b: a + b, [(n - F.col(z)) * (n - F.col(z)) for z, n in both])
        moved = had.join(sums, [group_col, "start", "cluster"], "left").select(
            group_col, "start", "cluster", "_moving", shift.alias("_shift"), *[n.alias(z) for z, n in both]
        )
        state = _state(moved, group_col, zs, limit)
        asked = done % LOOK == 0 or done == max_rounds
        if asked and state.where(F.exists("_starts", lambda s: s["_moving"])).isEmpty():
            return state.select(group_col, F.inline("_starts")).select(group_col, "start", F.inline("_c"))
    raise NotConverged(f"K-Means didn't settle in {max_rounds} rounds")


def best_start(points: DataFrame, centres: DataFrame, group_col: str, zs: list[str]) -> DataFrame:
    """(group, start, cost): the start of least cost of each group, the lower on ties."""
    costs = _costs(blocks(points, group_col, zs), _packed(centres, group_col, zs), group_col, zs)
    return costs.groupBy(group_col).agg(F.min(F.struct("cost", "start")).alias("b")).select(group_col, "b.start", "b.cost")


def fit(
    fixed: DataFrame,
    grid: DataFrame,
    k: int,
    key_cols: list[str],
    group_col: str,
    zs: list[str],
    max_rounds: int,
    tolerance: float,
    starts: int = STARTS,
    rounds: int = ROUNDS,
    oversample: float | None = None,
) -> DataFrame:
    """(group, cluster, *zs): the best centres of each group, in whole millionths.

    ``fixed`` comes from ``fixed_point``; ``grid`` has the grid seeds in the same
    unit. ``key_cols`` tell rows apart: rows with equal keys draw equal numbers.
    """
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    points = blocks(fixed.select(group_col, key.alias("_key"), *zs), group_col, zs)
    candidates = parallel_candidates(points, k, starts, rounds, oversample or 2.0 * k, group_col, zs)
    seeds = reduced(staged(candidates, "kmeans-weighted"), k, group_col, zs)
    grid = grid.select(group_col, F.lit(starts).alias("start"), F.col("cluster").cast("int").alias("cluster"), *zs)
    centres = lloyd(points, seeds.unionByName(grid), group_col, zs, max_rounds, tolerance)
    best = staged(best_start(points, centres, group_col, zs), "kmeans-best")
    return staged(centres.join(best, [group_col, "start"]).select(group_col, "cluster", *zs), "kmeans-centres")
