"""G2, G6-G9 as a stream of batches with state: days close by event time, late rows are
rejected and not lost, and the open days can be emitted at the end.

The state holds the open operational days as one aggregate per (day, hour, staff, product), from which all
four KPIs follow. ``advance`` takes it forward by one batch of events:

- rows that fail a validity rule (G2), and valid ones of a day that has closed (``late``), are
  appended to the rejects with their reason; all others are added to the state;
- the mark rises to the latest event time seen less ``grace``; it never falls;
- days that end (12:31 of the next day) at or before the mark leave the state and are appended
  to the closed days, which never change again.

So every row of the input is in exactly one of: rejects, closed days, open days. ``finish``
closes what is open. A later row of such a day is late.

The open days are a versioned table; its manifest names the folders of closed days and rejects that
belong to it, the mark, and the number of the last batch. A batch that dies has
changed nothing, and a batch whose number is not above the last one is skipped, so a source that
repeats its last batch after a failure (as Spark's ``foreachBatch`` does) counts nothing twice.

Scale: a batch is aggregated with map-side combine before anything is shuffled; the state is
as large as the open days' groups, not as the input. Rows are read twice, once for the sums and
once for the rejects. Values are held as decimals with six fraction digits, so the result
doesn't depend on how rows fall into batches. An event time far ahead closes all days before it:
filter such rows out first if the source can send them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custlens.functions.dates import operational_day
from custlens.operators import kpi
from custlens.session import staged
from custlens.sources import versions

GRAIN = ("op_day", "hour", "staff_id", "product")
AMOUNT = "decimal(38,6)"
GRACE = dt.timedelta(hours=2)
EMPTY = {"batch": -1, "mark": None, "closed": [], "rejects": []}


def _day_end(op_day: Column) -> Column:
    """12:31 of the next day, where ``operational_day`` turns."""
    return F.date_add(op_day, 1).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(12), F.lit(31))


def _is_past(op_day: Column, mark: str | None) -> Column:
    return F.lit(False) if mark is None else _day_end(op_day) <= F.lit(mark).cast("timestamp_ntz")


def _sums(*more: Column) -> list[Column]:
    counts = [F.sum(c).alias(c) for c in ("events", "leads", "purchases", "priced")]
    return [*counts, F.sum("amount").cast(AMOUNT).alias("amount"), *more]


def _grain(valid: DataFrame) -> DataFrame:
    """The batch per (day, hour, staff, product), with the latest event time."""
    paid = F.when(F.col("is_purchase"), F.col("value"))
    ones = kpi.restructure(valid).select(
        *GRAIN,
        "ts",
        F.lit(1).cast("long").alias("events"),
        F.coalesce(F.col("is_lead").cast("long"), F.lit(0)).alias("leads"),
        F.coalesce(F.col("is_purchase").cast("long"), F.lit(0)).alias("purchases"),
        paid.isNotNull().cast("long").alias("priced"),
        F.coalesce(paid.cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("amount"),
    )
    return ones.groupBy(*GRAIN).agg(*_sums(F.max("ts").alias("latest")))


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    found = versions.versions(spark, path)
    number = max(found, default=0)
    return number, found[number]["note"] if number else EMPTY


def _append(df: DataFrame, path: str, kind: str) -> list[str]:
    """Write the rows to a folder of their own; none if there is no row."""
    if df.isEmpty():
        return []
    folder = f"{kind}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return [folder]


def advance(events: DataFrame, path: str, batch: int, grace: dt.timedelta = GRACE) -> int:
    """Take the state at ``path`` forward by ``events`` (event columns with ts, staff_id,
    event_type, product and value), the ``batch``-th of its source, numbered upwards. Returns
    the version. Two writers can't both build on one version (``versions.VersionTaken``)."""
    spark, path = events.sparkSession, path.rstrip("/")
    number, note = _state(spark, path)
    if batch <= note["batch"]:
        return number
    valid, bad = kpi.split_valid(events)
    late = _is_past(operational_day("ts"), note["mark"])
    added = staged(_grain(valid.where(~late)), "kpi-batch")
    refused = bad
    if note["mark"] is not None:
        refused = bad.unionByName(valid.where(late).withColumn("reason", F.lit("late")))
    # The mark goes by the whole microsecond text, so that no zone or float comes in.
    latest = added.agg(F.max("latest").cast("string")).first()[0]
    marks = [note["mark"]] if note["mark"] else []
    if latest:
        marks.append((dt.datetime.fromisoformat(latest) - grace).isoformat(" ", "microseconds"))
    mark = max(marks, default=None)
    rows = added.drop("latest")
    if number:
        rows = rows.unionByName(versions.read_version(spark, path, number)).groupBy(*GRAIN).agg(*_sums())
    rows = staged(rows, "kpi-open")
    past = _is_past(F.col("op_day"), mark)
    note = {
        "batch": batch,
        "mark": mark,
        "closed": note["closed"] + _append(rows.where(past), path, "closed"),
        "rejects": note["rejects"] + _append(refused, path, "rejects"),
    }
    return versions.publish_version(rows.where(~past), path, note=note, after=number)


def finish(spark: SparkSession, path: str) -> int:
    """Close the open days; the mark rises to the end of the last one."""
    path = path.rstrip("/")
    number, note = _state(spark, path)
    rows = versions.read_version(spark, path, number)
    end = rows.agg(F.max(_day_end(F.col("op_day"))).cast("string")).first()[0]
    if end is None:
        return number
    end = dt.datetime.fromisoformat(end).isoformat(" ", "microseconds")
    note = note | {"mark": max(end, note["mark"] or end), "closed": note["closed"] + _append(rows, path, "closed")}
    return versions.publish_version(rows.limit(0), path, note=note, after=number)


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    """The grain of all closed days. A day is in one folder only."""
    path = path.rstrip("/")
    number, note = _state(spark, path)
    like = versions.read_version(spark, path, number)
    if not note["closed"]:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(*[f"{path}/{f}" for f in note["closed"]])


def rejects(spark: SparkSession, path: str) -> DataFrame | None:
    """The rejected event rows with their ``reason``; None if there is none."""
    path = path.rstrip("/")
    _, note = _state(spark, path)
    return spark.read.parquet(*[f"{path}/{f}" for f in note["rejects"]]) if note["rejects"] else None


def leads_by_day_hour(grain: DataFrame) -> DataFrame:
    """G6."""
    return grain.groupBy("op_day", "hour").agg(F.sum("leads").alias("leads"))


def conversion(grain: DataFrame) -> DataFrame:
    """G7."""
    per = grain.groupBy("op_day").agg(F.sum("leads").alias("leads"), F.sum("purchases").alias("purchases"))
    return per.withColumn("conversion_rate", F.try_divide(F.col("purchases"), F.col("leads")))


def _revenue() -> Column:
    return F.when(F.sum("priced") > 0, F.sum("amount").cast("double"))


def product_contribution(grain: DataFrame) -> DataFrame:
    """G8. The window runs over one row per day and product."""
    per = grain.where("purchases > 0").groupBy("op_day", "product").agg(_revenue().alias("revenue"))
    return per.withColumn("share", F.try_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy("op_day"))))


def staff_summary(grain: DataFrame, staff: DataFrame) -> DataFrame:
    """G1 and G9."""
    counts = [F.sum(c).alias(c) for c in ("events", "leads", "purchases")]
    per = grain.groupBy("op_day", "staff_id").agg(*counts, F.coalesce(_revenue(), F.lit(0.0)).alias("revenue"))
    return kpi.integrate(per, staff)
