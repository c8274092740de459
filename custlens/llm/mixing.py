"""Operator 3, mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies that each of its
documents should get on average. The whole part is given to every document. The
fractional part p becomes 0 or 1 by pivotal rounding: two documents with sizes
a, b and parts p, q meet and transfer mass, p up by d and q down by d*a/b or the
other way, with the probabilities that keep the expectations, until one of them
is 0 or 1. Each transfer keeps a*p + b*q, so that a source's words stay at its
target but for the one document that is left at the end.

Distribution: the documents of a source are dealt to leaves by a hash of their id,
their size and a number among rows equal in both, about ``LEAF`` in each, so that an id
of very many rows meets in no task. Each leaf runs as one ordered pass and hands one
undecided document on; the residuals of ``FAN`` leaves meet in a node of the next
level, until one node per source is left. The leaves and the random numbers
depend on the documents alone, so that reruns agree on any cluster.

NULL text or no word: size 0, taken 0. NULL sources are one source, the last in
order; sources with no words get target 0. A NULL id is an id like others.
Repeated rows are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.llm.common import fresh, stage, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
LEAF = 4096
FAN = 256


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Every source gets ``weight / sum of weights`` of ``share`` times all sizes, but
    ``most`` times its own size at the most; what is above goes to the others by
    weight, until none is above. Each round is one aggregate over the sources.
    """
    per = stage(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")),
        "mix-sources",
    )
    # The rank by code point is a running count: within each range partition of
    # the ordered sources, plus what the partitions before it hold.
    ordered = per.select(
        F.col("source").isNull().alias("last"), "source", "source_size", "n_docs"
    ).repartitionByRange("last", "source").withColumn("part", F.spark_partition_id())
    ordered = stage(
        ordered.withColumn(
            "at", F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1
        ),
        "mix-ranked",
    )
    held = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = held.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ordered.join(before, "part").select(
        "source",
        "source_size",
        "n_docs",
        F.get(cycle, F.pmod(F.col("at") + F.col("before"), F.lit(len(weights))).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
    )
    ranked = stage(ranked, "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, level, full = share * total, None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("limit")
        n, spent, weight = ranked.agg(
            F.count(F.when(above, 1)),
            F.sum(F.when(above, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
        ).first()
        if n == full or not weight:
            break
        full, level = n, max(0.0, left - spent) / weight
    if level is None:
        level = 0.0
    return ranked.select(
        "source",
        "source_size",
        "n_docs",
        F.least(F.col("weight") * F.lit(float(level)), F.col("limit")).alias("target"),
    )


_NODE = "source_no long, node long, mix_id {id}, size long, h long, copies long, part double, open boolean"


def _transfer(a: int, q: float, b: int, p: float, r: float) -> tuple[float, float]:
    """The parts of two documents of sizes a, b after they met; one is whole."""
    up = min(1.0 - q, p * b / a)  # by this q can rise while p falls
    down = min(q, (1.0 - p) * b / a)
    change = up if r * (up + down) < down else -down
    return q + change, p - change * a / b


def _rounding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One ordered pass over the nodes of a partition; a node may span batches.

    In a node the held document meets the next one, and whichever becomes whole
    is passed out; the one that is left goes out as ``open``.
    """
    node, held, schema = None, None, None
    for batch in batches:
        out: list[tuple] = []
        schema = pa.schema([*[f for f in batch.schema if f.name != "r"], pa.field("open", pa.bool_())])
        for x in zip(*(batch.column(n).to_pylist() for n in (*schema.names[:-1], "r")), strict=True):
            *x, r = x
            if node != (node := (x[0], x[1])) and held is not None:
                out.append((*held, True))
                held = None
            if not 0.0 < x[6] < 1.0:
                out.append((*x[:5], x[5] + int(x[6] >= 1.0), 0.0, False))
                continue
            if held is None:
                held = x
                continue
            held[6], x[6] = _transfer(held[3], held[6], x[3], x[6], r)
            # One of the two is whole, up to the rounding of floats.
            if min(x[6], 1.0 - x[6]) > min(held[6], 1.0 - held[6]):
                held, x = x, held
            out.append((*x[:5], x[5] + int(x[6] > 0.5), 0.0, False))
            if not 1e-12 < held[6] < 1.0 - 1e-12:
                out.append((*held[:5], held[5] + int(held[6] > 0.5), 0.0, False))
                held = None
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
            )
    if held is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c], f.type) for c, f in zip((*held, True), schema, strict=True)], schema=schema
        )


def _uniform(*cols: Column) -> Column:
    """A number from [0, 1) that the columns alone decide."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _numbered(rows: DataFrame, leaf: int) -> DataFrame:
    """``rows`` with ``no``, which counts rows equal in every column from 0. Equal rows are
    counted by an aggregate and made again by ``leaf`` in tasks of their own: no window."""
    names, zero = rows.columns, F.lit(0).cast("long")
    counted = stage(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    few = counted.where(F.col("n") <= leaf).withColumn("no", F.explode(F.sequence(zero, F.col("n") - 1)))
    starts = F.sequence(zero, F.col("n") - 1, F.lit(leaf).cast("long"))
    many = counted.where(F.col("n") > leaf).withColumn("start", F.explode(starts)).repartition(*names, "start")
    last = F.least(F.col("start") + leaf, "n") - 1
    many = many.withColumn("no", F.explode(F.sequence(F.col("start"), last)))
    return few.select(*names, "no").unionByName(many.select(*names, "no"))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    leaf: int = LEAF,
    fan: int = FAN,
    seed: int = 1,
) -> DataFrame:
    """(mix_id, source, size, source_size, target, copies, taken), a row for each input row."""
    sizes = docs.select(
        F.col(f"`{id_col}`").alias("mix_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )
    sized = stage(_numbered(sizes, leaf), "mix-sizes")
    targets = source_targets(sized, weights, share, most)
    targets = stage(
        targets.withColumn("source_no", F.xxhash64(F.col("source").isNull(), "source")), "mix-targets"
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = (
        sized.withColumn("source_no", F.xxhash64(F.col("source").isNull(), "source"))
        .join(targets.drop("source"), "source_no")
        .select(
            "source_no",
            F.pmod(F.xxhash64(F.lit(seed), "mix_id", "size", "no"), F.ceil(F.col("n_docs") / F.lit(leaf))).alias("node"),
            "mix_id",
            "size",
            F.xxhash64(F.lit(seed + 1), "mix_id", "size", "no").alias("h"),
            ratio.alias("ratio"),
        )
        .select(
            "source_no",
            "node",
            "mix_id",
            "size",
            "h",
            F.when(F.col("size") > 0, F.floor("ratio")).otherwise(0).cast("long").alias("copies"),
            F.when(F.col("size") > 0, F.col("ratio") - F.floor("ratio")).otherwise(0.0).alias("part"),
        )
    )
    most_docs = targets.agg(F.max("n_docs")).first()[0] or 0
    nodes, level, decided = -(-most_docs // leaf), 0, []
    schema = _NODE.format(id=sized.schema["mix_id"].dataType.simpleString())
    while True:
        done = stage(
            start.withColumn("r", _uniform(F.lit(seed + 2 + level), F.col("h"), F.col("mix_id")))
            .repartition("source_no", "node")
            .sortWithinPartitions("source_no", "node", "h", "mix_id", "size")
            .mapInArrow(_rounding, schema),
            f"mix-level{level}",
        )
        decided.append(done.where("not open"))
        rest = done.where("open")
        if nodes <= 1:
            break
        start = rest.select(
            "source_no", F.floor(F.col("node") / F.lit(fan)).alias("node"), "mix_id", "size", "h", "copies", "part"
        )
        nodes, level = -(-nodes // fan), level + 1
    # The one document that is left of a source is in or out by its own part.
    last = rest.withColumn(
        "copies",
        F.col("copies")
        + (_uniform(F.lit(seed + 100), F.col("h"), F.col("mix_id")) < F.col("part")).cast("long"),
    )
    rows = last.select("source_no", "mix_id", "size", "copies")
    for d in decided:
        rows = rows.unionByName(d.select("source_no", "mix_id", "size", "copies"))
    return rows.join(targets, "source_no").select(
        "mix_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    A 128-bit hash of all its values stands for a row, so rows that share an id or have
    none are dealt apart. Rows equal in every column are interchangeable: one of them
    stands for all, with the sum of their copies. The rows move once, to their copies.
    """
    # A hash skips NULLs, so their places go in as well.
    values = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    row, rank, part = (fresh(docs, f"mix_{c}") for c in ("row", "rank", "part"))
    keyed = docs.withColumn(row, F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(7), *values).alias("b")))
    found = copies(keyed, row, text_col, source_col, **settings).groupBy(F.col("mix_id").alias(row))
    found = found.agg(F.sum("copies").alias(rank), F.count(F.lit(1)).alias(part)).where(f"{rank} > 0")
    found = stage(found, "mix-copies")
    repeated = found.where(f"{part} > 1").select(row, rank)
    # Always a shuffle join: the plan, and what it writes, is alike at every size.
    once = keyed.join(found.where(f"{part} = 1").select(row, rank).hint("merge"), row)
    taken = once.withColumn(rank, F.explode(F.sequence(F.lit(1).cast("long"), rank)))
    taken = taken.select([F.col(f"`{x}`") for x in docs.columns])
    if not repeated.limit(1).count():
        return taken
    # One row may stand for a third of all: its copies are made by ``LEAF`` in tasks of their own.
    single = keyed.join(repeated, row, "left_semi").dropDuplicates([row]).join(repeated, row)
    starts = F.sequence(F.lit(0).cast("long"), F.col(rank) - 1, F.lit(LEAF).cast("long"))
    spread = single.withColumn(part, F.explode(starts)).repartition(row, part)
    last = F.least(F.col(part) + LEAF, F.col(rank)) - 1
    spread = spread.withColumn(rank, F.explode(F.sequence(F.col(part), last)))
    return taken.unionAll(spread.select([F.col(f"`{x}`") for x in docs.columns]))
