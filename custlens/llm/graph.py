"""Connected components of a table of links, for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import stage, unstage

BUFFER = 200_000


class Forest:
    """Union-find; the root of a tree is its least member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (nxt := up.get(top, top)) != top:
            top = nxt
        while (nxt := up.get(x, x)) != top:
            up[x] = top
            x = nxt
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in self.up]


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same components by fewer links: a star per tree of a bounded buffer."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.up) >= BUFFER:
            yield _batch(forest.links())
            forest = Forest()
    if forest.up:
        yield _batch(forest.links())


def _are_stars(pairs: DataFrame) -> bool:
    """No id has two smaller neighbours, or both a smaller and a greater one."""
    ends = pairs.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        pairs.select("v", F.lit(0), F.lit(1))
    )
    per_id = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per_id.where("up > 1 or (up = 1 and down = 1)").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b; longs): the least id it reaches.

    Each round joins every id's greater neighbours, then its smaller ones, to the
    least id around it, until only stars are left. A round is aggregates, which combine
    before the shuffle, and joins over the links: a hub's neighbours never meet in one
    group, and its joins are broadcast or split. Rows of a round: the links at most, and one an id.
    """
    thin = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_thinned, "a long, b long")
    pairs = stage(thin.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _are_stars(pairs):
        # The greater neighbours u of v go to the least id around v.
        below = pairs.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("least"))
        least = stage(below, "links-least")
        large = pairs.join(least, "v", "left").select("u", F.coalesce("least", "v").alias("v"))
        large = stage(large.distinct(), "links-large")
        # u and its neighbours, all smaller now, go to the least of them.
        own = stage(large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")), "links-own")
        others = large.join(own.where("m <> most").select("u", "m"), "u").where("v <> m").select("v", "m")
        done = pairs
        pairs = stage(own.select("u", F.col("m").alias("v")).union(others).distinct(), "links-round")
        unstage(done, least, large, own)
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
