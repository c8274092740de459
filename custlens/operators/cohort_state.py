"""C9 / W1 kept up to date: the cohort table of all sales so far, brought forward by one
batch of new rows at a time instead of being computed anew.

The state is a versioned table of cells (``sources.versions``) and logs beside it. Every
batch adds one log: ``months``, its sums per (customer, product, month), and ``firsts``,
its first month per (customer, product). The manifest of a version names the logs that belong to it
and the keys of the batches it holds, so cells and logs change in one step. A batch that
dies before its manifest leaves the state as it was; one that comes again under its key
changes nothing.

A batch may hold late rows. Where a customer's first month moves back, the months
that the state has of that customer leave their old cells and enter the new ones.

A batch's sums and the months that the state has of its customers are dealt by (customer,
product) once; what the batch adds, first months and moved months all come out of that
one shuffle, which meets a row per month at most, however many sales a customer has. Up to
``FEW`` pairs of a batch are looked up in the logs by a semi-join, small enough for a
broadcast; a larger batch takes the logs whole, as a join would shuffle them too. ``merge_after``
logs are merged into one, which is written from the same shuffle: such a log holds the sums of
old and new rows, with columns beside them that say what its batch brought.

Amounts are held as decimals with ``SCALE`` fraction digits: taking a moved customer out of
a cell leaves nothing behind, and the order of the batches doesn't matter. An amount that is no
finite number fails its batch. As in the full form, rows without a customer or a valid month
are left out, a NULL product is a product, and a cell of NULL amounts alone has NULL revenue.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custlens.functions.dates import month_index
from custlens.operators.cohort import cohort_rows
from custlens.sources import versions
from custlens.sources.files import _fs_and_path, delete_path

SCALE = 6
AMOUNT = f"decimal(38,{SCALE})"
PAIR = ("customer", "product_name")
MONTH = (*PAIR, "invoice_month")
CELL = ("product_name", "cohort_month", "cohort_index")
MERGE_AFTER = 16
FEW = 200_000


def _match(df: DataFrame, other: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    """``df`` joined with ``other`` on equal keys; a NULL product equals a NULL product."""
    other = other.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(other, on, how).drop(*[f"_{k}" for k in keys])


def _summed(months: DataFrame) -> DataFrame:
    sums = [F.sum("amount").cast(AMOUNT).alias("amount"), F.sum("priced").alias("priced")]
    return months.groupBy(*MONTH).agg(*sums)


def month_sums(sales: DataFrame, *columns: str) -> DataFrame:
    """(customer, product_name, invoice_month, amount, priced) of a batch; ``priced`` counts
    the rows with an amount. ``columns`` are those of ``cohort_rows``."""
    rows = cohort_rows(sales, None, *columns)
    priced = F.col("amount").isNotNull().cast("long")
    return _summed(rows.select(*MONTH, F.coalesce(F.col("amount").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("amount"), priced.alias("priced")))


def _firsts(months: DataFrame) -> DataFrame:
    return months.groupBy(*PAIR).agg(F.min("invoice_month").alias("first"))


def _note(spark: SparkSession, path: str) -> tuple[int, dict]:
    found = versions.versions(spark, path)
    number = max(found, default=0)
    return number, found[number]["note"] if number else {"keys": [], "logs": []}


def _log(spark: SparkSession, path: str, logs: list[str], part: str, like: DataFrame) -> DataFrame:
    if not logs:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(*[f"{path}/{log}/{part}" for log in logs])


def _write(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _with_old(old_months: DataFrame, months: DataFrame) -> DataFrame:
    """A row per (customer, product, month) of the state and the batch: the sums over both (amount,
    priced), whether the state ``had`` it and whether it ``came``, the batch's own part where it is
    both, and the pair's first month now (``first``) and in the state (``before``)."""
    rows = old_months.withColumn("came", F.lit(False)).unionByName(months.withColumn("came", F.lit(True)))
    came, both = F.col("came"), F.max("came") & F.max(~F.col("came"))
    part = [
        F.when(both, F.sum(F.when(came, F.col("amount"))).cast(AMOUNT)).alias("came_amount"),
        F.when(both, F.sum(F.when(came, F.col("priced")))).alias("came_priced"),
    ]
    sums = [F.sum("amount").cast(AMOUNT).alias("amount"), F.sum("priced").alias("priced")]
    each = rows.repartition(*PAIR).groupBy(*MONTH).agg(*sums, *part, F.max(~came).alias("had"), F.max("came").alias("came"))
    pair = Window.partitionBy(*PAIR)
    before = F.min(F.when(F.col("had"), F.col("invoice_month"))).over(pair)
    return each.withColumns({"first": F.min("invoice_month").over(pair), "before": before})


def _changes(each: DataFrame) -> DataFrame:
    """Rows to add to the cells, from ``_with_old``. What came enters the cells of its first month.
    Where that moves back, what the state had leaves its old cells and enters with it."""
    had, came = F.col("had"), F.col("came")
    moved = F.coalesce(F.col("first") < F.col("before"), F.lit(False))
    amount, priced = (F.coalesce(F.col(f"came_{c}"), F.col(c)) for c in ("amount", "priced"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    had_amount, had_priced = (F.col(c) - F.when(came, F.col(f"came_{c}")).otherwise(0) for c in ("amount", "priced"))

    def row(month, amount, priced, customers):
        return F.struct(
            month.alias("cohort_month"),
            amount.cast(AMOUNT).alias("amount"), priced.cast("long").alias("priced"), customers.alias("customers"),
        )

    enters = row(
        F.col("first"),
        F.when(moved, F.col("amount")).otherwise(amount), F.when(moved, F.col("priced")).otherwise(priced),
        F.when(moved | ~had, one).otherwise(none),
    )
    leaves = row(F.col("before"), -had_amount, -had_priced, -one)
    rows = F.when(moved & had, F.array(enters, leaves)).when(came, F.array(enters))
    changes = each.select("product_name", "invoice_month", F.inline(rows))
    return changes.select(
        "product_name", "cohort_month", month_index("invoice_month", "cohort_month").alias("cohort_index"), "amount", "priced", "customers"
    )


def add_batch(sales: DataFrame, path: str, key: str, *columns: str, merge_after: int = MERGE_AFTER) -> int:
    """Bring the state at ``path`` forward by the rows of ``sales``; the number of the version.

    ``key`` names the batch; a key that the state holds is not added again. Two writers
    can't both build on one version: the later one gets ``versions.VersionTaken`` and tries again.
    """
    spark, path = sales.sparkSession, path.rstrip("/")
    number, note = _note(spark, path)
    if key in note["keys"]:
        return number
    folder = f"log-{uuid.uuid4().hex}"
    months = month_sums(sales, *columns)
    old_months = _log(spark, path, note["logs"], "months", months)
    if len(note["logs"]) >= merge_after:
        each = _write(_with_old(old_months, months), f"{path}/{folder}/months")
        _write(each.where("invoice_month = first").select(*PAIR, "first"), f"{path}/{folder}/firsts")
        logs = [folder]
    else:
        months = _write(months.sortWithinPartitions(*PAIR), f"{path}/{folder}/months")
        firsts = _write(_firsts(months), f"{path}/{folder}/firsts")
        if firsts.count() <= FEW:
            old_months = _match(old_months, firsts.select(*PAIR), PAIR, "left_semi")
        each = _with_old(old_months, months)
        logs = [*note["logs"], folder]
    changes = _changes(each)
    if number:
        changes = versions.read_version(spark, path, number).unionByName(changes)
    sums = [F.sum("amount").cast(AMOUNT).alias("amount"), F.sum("priced").alias("priced"), F.sum("customers").alias("customers")]
    cells = changes.groupBy(*CELL).agg(*sums).where("customers > 0")
    return versions.publish_version(cells, path, note={"keys": [*note["keys"], key], "logs": logs}, after=number)


def cohort_cells(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """C9's long form from the state: product_name, cohort_month, cohort_index, revenue, customers."""
    revenue = F.when(F.col("priced") > 0, F.col("amount").cast("double")).alias("revenue")
    return versions.read_version(spark, path, number).select(*CELL, revenue, "customers")


def first_months(spark: SparkSession, path: str) -> DataFrame:
    """W1 from the state: customer, product_name, cohort_month."""
    _, note = _note(spark, path)
    if not note["logs"]:
        raise versions.NoVersion(f"{path} has no version")
    parts = spark.read.parquet(*[f"{path}/{log}/firsts" for log in note["logs"]])
    return parts.groupBy(*PAIR).agg(F.min("first").alias("cohort_month"))


def drop_old_states(spark: SparkSession, path: str, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
    """``versions.drop_old_versions``, and logs that no version left names and nobody wrote
    to for ``grace_seconds``."""
    path = path.rstrip("/")
    gone = versions.drop_old_versions(spark, path, keep, grace_seconds)
    named = {log for m in versions.versions(spark, path).values() for log in m["note"]["logs"]}
    fs, at = _fs_and_path(spark, path)
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        idle = time.time() - status.getModificationTime() / 1000
        if name.startswith("log-") and name not in named and idle >= grace_seconds:
            delete_path(spark, f"{path}/{name}")
            gone.append(name)
    return gone
