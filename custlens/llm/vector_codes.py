"""Operator 13, vector code compression by member-resident Lloyd rounds.

Components become integers, a vector is cut into equal parts, and a codebook of a few
entries is fitted per part position, so that a vector becomes a byte or less a part.

The rows of the fit are parts. Their owner is the partition of (position, entry, salt):
members of an entry are resident there, and a round is

* update: the owners' sums and counts of their resident members, a row per position
  and entry, give the new entries;
* assignment: each resident part looks for its nearest new entry. Those that keep their
  entry stay where they are, in the files that the task writes beside its input;
  only those that change it are shuffled to their new owners.

So after the first placement a round shuffles what still moves, not the table. Each
round's residents are written to the shared folder before those of the round before are deleted: a
lost executor re-reads files. An entry may hold any share of the parts: the number of
salts is such that an owner has about ``OWNER_ROWS`` members even if one entry had all
parts of its position. The driver holds the codebooks only, entries x vector length
integers.

Results: vectors that are NULL or have NULL or non-finite components are dropped. All
arithmetic is on integers and exact; an error that exceeds a long fails the job.
Vectors whose length isn't the table's commonest length that the number of parts divides
(the greatest on ties; empty vectors have none) can't be cut alike: they are kept with a
NULL code and error and take no part in the fit. Rows with equal or NULL vec_ids are rows of their own; among
equal ids the seeds go by the components. With fewer rows than entries
the codebook is as long as there are rows. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from custlens.llm.common import stage
from custlens.session import scratch_path

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
OWNER_ROWS = 4096
# Integers up to here multiply and add exactly in doubles, for parts of up to 2,048 components.
EXACT = 1 << 20

Codebooks = list[list[list[int]]]


def kept_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE
) -> DataFrame:
    """(vec_id, label, v): the usable vectors with their components as floor(scale * x)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))
    return (
        vectors.where(v.isNotNull() & ~bad)
        .select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), whole.alias("v"))
    )


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, as exact integers."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if most <= EXACT and x.shape[1] <= 2048:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        return found.astype(np.int64)
    a, b = x.astype(object), entries.astype(object)
    return np.stack([((a - e) ** 2).sum(1) for e in b], axis=1)


def _nearest(batch: pa.RecordBatch, books: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """Each part's nearest entry, the lower index on ties, and its squared distance."""
    pos = batch.column("pos").to_numpy()
    parts = batch.column("part")
    x = parts.flatten().to_numpy().reshape(len(pos), -1)
    entry, error = np.zeros(len(pos), dtype=np.int32), np.zeros(len(pos), dtype=object)
    for p in np.unique(pos):
        rows = np.flatnonzero(pos == p)
        d = _distances(x[rows], books[p])
        entry[rows] = best = d.argmin(axis=1)
        error[rows] = d[np.arange(len(rows)), best]
    return entry, error.tolist()


def _sums(members: DataFrame, entries: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sum of the members of each (position, entry)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            key = batch.column("pos").to_numpy().astype(np.int64) * entries + batch.column("entry").to_numpy()
            x = batch.column("part").flatten().to_numpy().reshape(len(key), -1)
            x = x if np.abs(x).max(initial=0) < 1 << 40 else x.astype(object)
            for k in np.unique(key).tolist():
                own = x[key == k]
                had = total.setdefault(k, [0, [0] * x.shape[1]])
                had[0] += len(own)
                had[1] = [a + int(b) for a, b in zip(had[1], own.sum(axis=0), strict=True)]
        # Sums go as text: they are exact whatever their size.
        rows = [(k, n, ",".join(map(str, s))) for k, (n, s) in total.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["k", "n", "sums"])

    partial = members.select("pos", "entry", "part").mapInArrow(run, "k long, n long, sums string")
    split = partial.select("k", "n", F.posexplode(F.split("sums", ",")).alias("i", "s"))
    added = split.groupBy("k", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in added.orderBy("k", "i").collect():  # entries x vector length rows at most
        found.setdefault(divmod(r.k, entries), (r.n, []))[1].append(int(r.s))
    return found


def _updated(books: Codebooks, members: DataFrame, entries: int) -> Codebooks:
    sums = _sums(members, entries)

    def entry(p: int, e: int, old: list[int]) -> list[int]:
        n, total = sums.get((p, e), (0, []))
        return [s // n for s in total] if n else old

    return [[entry(p, e, old) for e, old in enumerate(book)] for p, book in enumerate(books)]


def _with_moved(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("moved", BooleanType())])


def _assigned(parts: DataFrame, books: Codebooks) -> DataFrame:
    """``parts`` with ``entry`` anew, and whether it changed."""
    tables = [np.array(b, dtype=np.int64) for b in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, _ = _nearest(batch, tables)
            moved = pa.array(entry != batch.column("entry").to_numpy())
            at = batch.schema.get_field_index("entry")
            columns = batch.columns
            columns[at] = pa.array(entry, pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, moved], names=[*batch.schema.names, "moved"])

    return parts.mapInArrow(run, _with_moved(parts.schema))


class Residents:
    """The parts by owner, in the shared folder; each step replaces the files of the step before."""

    def __init__(self, spark: SparkSession, salts: int) -> None:
        self.spark, self.salts, self.paths = spark, salts, []

    def _owner(self):
        return "pos", "entry", F.pmod(F.xxhash64("row"), F.lit(self.salts))

    def _path(self) -> str:
        return scratch_path(self.spark, f"vector-codes-{uuid.uuid4().hex}")

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)

    def place(self, parts: DataFrame) -> None:
        """All parts to their first owners."""
        self.schema = parts.schema
        self.paths = [self._path()]
        parts.repartition(*self._owner()).write.parquet(self.paths[0])

    def step(self, books: Codebooks) -> None:
        """Assign anew; those that change their entry migrate, the others stay."""
        split, came = self._path(), self._path()
        _assigned(self.table(), books).write.partitionBy("moved").parquet(split)
        moved = self.spark.read.schema(_with_moved(self.schema)).parquet(split)
        moved.where("moved").drop("moved").repartition(*self._owner()).write.parquet(came)
        old, self.paths = self.paths, [came]
        stayed = f"{split}/moved=false"
        if _exists(self.spark, stayed):
            self.paths.append(stayed)
        _drop(self.spark, old + [f"{split}/moved=true"])

    def drop(self) -> None:
        _drop(self.spark, self.paths)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged files that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _common_length(kept: DataFrame, parts: int) -> int:
    n = F.size("v")
    sizes = kept.where((n > 0) & (n % parts == 0)).groupBy(n.alias("n")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return first.n if first else 0


def fit(
    usable: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, owner_rows: int = OWNER_ROWS
) -> tuple[Codebooks, Residents]:
    """Codebooks after ``rounds`` rounds over the staged table ``usable`` (row, vec_id,
    label, v), and the parts as they lie at their owners of the last round."""
    width = length // parts
    seeds = usable.orderBy(F.col("vec_id").asc_nulls_last(), "v", "row").limit(entries).collect()
    books = [[list(s.v[p * width : (p + 1) * width]) for s in seeds] for p in range(parts)]
    cut = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("v", p * width + 1, width)))
    flat = usable.select("row", cut.alias("pos", "part")).withColumn("entry", F.lit(-1))
    home = Residents(usable.sparkSession, max(1, -(-usable.count() // owner_rows)))
    home.place(_assigned(flat, books).drop("moved"))
    for r in range(rounds):
        books = _updated(books, home.table(), entries)
        if r < rounds - 1:
            home.step(books)
    return books, home


def book_digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    owner_rows: int = OWNER_ROWS,
) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256): a row per kept vector."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit a byte")
    kept = kept_vectors(vectors, id_col, vector_col, label_col, scale)
    kept = stage(kept.withColumn("row", F.monotonically_increasing_id()), "vector-codes-kept")
    length = _common_length(kept, parts)
    usable = kept.where(F.size("v") == length) if length else kept.limit(0)
    books, home = fit(usable, length, parts, entries, rounds, owner_rows)
    tables = [np.array(b, dtype=np.int64) for b in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, error = _nearest(batch, tables)
            columns = [batch.column("row"), batch.column("pos"), pa.array(entry, pa.int32()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "pos", "entry", "d"])

    last = home.table().select("row", "pos", "part").mapInArrow(run, "row long, pos int, entry int, d long")
    of_row = last.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "entry"))).alias("e"), F.sum("d").alias("error"))
    digits = F.transform("e", lambda x: F.lower(F.lpad(F.hex(x["entry"]), 2, "0")))
    coded = of_row.select("row", F.array_join(digits, "").alias("code"), "error")
    found = stage(kept.select("row", "vec_id", "label").join(coded, "row", "left"), "vector-codes")
    home.drop()
    return found.select("vec_id", "label", "code", "error", F.lit(book_digest(books)).alias("codebooks_sha256"))


def report(vectors: DataFrame, **settings) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): ``codes`` with the sum of
    the errors of all rows of equal label, NULL labels together."""
    found = codes(vectors, **settings)
    by_label = stage(found.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-codes-labels")
    joined = found.join(by_label.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
