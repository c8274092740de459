"""File sources and sinks (S2–S5) and the JDBC writer.

S2 is the interesting one: a folder of CSV exports whose headers differ
(the tracking column is ``AWB`` in one, ``AWB#`` or ``Tracking Id`` in
another, columns in any order). One ``read.csv(folder)`` would apply the
first file's header to every file and silently shift values. So the lines are
read as text, the first record of every file is found by an aggregate, and each
record is taken apart by the header of its own file.

A quoted value may hold line breaks, and files are split all the same. A line opens or
closes a value if its number of quotes is odd, so each split counts these lines, and
the counts' sums over a file's splits say whether a split begins inside a value.
Splits without such lines are whole records already and are never shuffled; in the others a
window finds the lines at which records start, and lines of one record are joined.
"""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from custlens.session import staged


def csv_records(lines: DataFrame) -> DataFrame:
    """(_path, _start, _at, _line): the records of ``lines`` (same columns), each at the place
    of its first line, without a carriage return at its end."""
    odd = (F.length("_line") - F.length(F.replace(F.col("_line"), F.lit('"'), F.lit("")))) % 2 == 1
    here = Window.partitionBy("_path").orderBy("_start")
    before = F.coalesce(F.sum("_odd").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = lines.groupBy("_path", "_start").agg(F.count_if(odd).alias("_odd")).withColumn("_open", before % 2 == 1)
    splits = staged(splits, "csv-splits")
    whole = (F.col("_odd") == 0) & ~F.col("_open")
    columns = ["_path", "_start", "_at", "_line"]
    found = lines.join(splits.where(whole), ["_path", "_start"]).select(*columns)
    mixed = splits.where(~whole)
    if not mixed.isEmpty():
        rows = Window.partitionBy("_path", "_start").orderBy("_at")
        turns = F.coalesce(F.sum(odd.cast("int")).over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        inside = (turns + F.col("_open").cast("int")) % 2 == 1
        at = F.struct("_start", "_at")
        placed = lines.join(mixed, ["_path", "_start"]).withColumn("_first", F.when(~inside, at))
        placed = placed.withColumn("_record", F.last("_first", ignorenulls=True).over(rows.rowsBetween(Window.unboundedPreceding, 0)))
        placed = staged(placed.select(*columns, "_record"), "csv-lines")
        # A split may begin within a record of an earlier split: the last that started before it.
        starts = lines.join(splits.where(whole), ["_path", "_start"]).groupBy("_path", "_start").agg(F.max("_at").alias("_at"))
        last = starts.select("_path", "_start", at.alias("_last")).unionByName(
            placed.groupBy("_path", "_start").agg(F.max("_record").alias("_last"))
        )
        earlier = F.last("_last", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1))
        last = staged(last.select("_path", "_start", earlier.alias("_earlier")), "csv-open")
        joined = placed.join(last, ["_path", "_start"]).withColumn("_record", F.coalesce("_record", "_earlier"))
        parts = F.array_sort(F.collect_list(F.struct("_start", "_at", "_line")))
        whole_text = F.array_join(F.transform(parts, lambda p: p["_line"]), "\n")
        records = joined.groupBy("_path", "_record").agg(whole_text.alias("_line"))
        found = found.unionByName(records.select("_path", "_record._start", "_record._at", "_line"))
    return found.withColumn("_line", F.regexp_replace("_line", "\r$", ""))


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    aliases: list[str],
    target: str,
    glob: str = "*.csv",
    recursive: bool = False,
) -> DataFrame:
    """S2 + U2: read every CSV in ``folder``; in each file the **first** of
    ``aliases`` present is renamed ``target``; stack by column name with
    missing columns NULL. All values are text (no inference).

    Files are split like any text, and only the different headers come to the
    driver, as the result's columns must be known there. Quotes stand around whole values and
    are doubled inside them; such values may hold line breaks.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).option("lineSep", "\n")
    lines = reader.text(folder).select(
        F.col("value").alias("_line"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    lines = csv_records(lines)
    first = lines.filter("_start = 0").groupBy("_path").agg(F.min_by("_line", "_at").alias("_header"), F.min("_at").alias("_first"))
    headers = [r["_header"] for r in first.select("_header").distinct().orderBy("_header").collect()]
    if not headers:
        raise FileNotFoundError(f"no {glob} files in {folder}")
    layouts = {}
    for header in headers:
        names = next(csv.reader(io.StringIO(header, newline="")))
        alias = next((x for x in aliases if x in names), None)
        layouts[header] = [target if n == alias else n for n in names]
    columns = list(dict.fromkeys(n for names in layouts.values() for n in names))
    width = max(map(len, layouts.values()))
    values = F.from_csv("_line", ", ".join(f"c{i} string" for i in range(width)), {"escape": '"', "multiLine": "true"})
    rows = lines.join(first, "_path").filter("(_start <> 0 OR _at <> _first) AND _line <> ''").select("_header", values.alias("_v"))
    out = []
    for name in columns:
        value = F.lit(None).cast("string")
        for header, names in layouts.items():
            if name in names:
                value = F.when(F.col("_header") == header, F.col(f"_v.c{names.index(name)}")).otherwise(value)
        out.append(value.alias(name))
    return rows.select(*out)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S3: one CSV with a header; pass ``schema`` to avoid inference."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder (recursive) on whatever file system holds it."""
    fs, target = _fs_and_path(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S4 for a lake table: write the new contents beside the old, then swap
    directories, so a failed write never leaves an empty table (Q20)."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(staging)
    fs, target = _fs_and_path(spark, path)
    _, staged = _fs_and_path(spark, staging)
    old = None
    if fs.exists(target):
        _, old = _fs_and_path(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
        if not fs.rename(target, old):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"could not move {staging} into place")
    if old is not None:
        fs.delete(old, True)


def replace_jdbc_table(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, batch_size: int = 1000) -> None:
    """S4 for a database table: TRUNCATE + insert in batches of 1000, as the
    reference does. The truncate and the inserts are not one transaction
    (the same gap as the reference, Q20); prefer ``replace_table`` for lakes."""
    writer = df.write.mode("overwrite").option("truncate", True).option("batchsize", batch_size)
    writer.jdbc(url, table, properties=properties or {})


def write_csv(df: DataFrame, path: str) -> None:
    """Write a result (a matrix's index is an ordinary column) as CSV
    with a header, replacing the folder."""
    df.write.mode("overwrite").option("header", True).csv(path)
