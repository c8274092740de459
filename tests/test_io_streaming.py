"""Sources, sinks and the streaming KPI."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from custlens.operators import kpi
from custlens.operators.textprep import EmptyInput, instruction_dataset, load_split, publish
from custlens.sources.files import read_csv, read_csv_folder, replace_table, write_csv
from custlens.sources.tables import lower_case_columns, name_columns
from custlens.streaming.kpi_stream import start_hourly_leads, totals

SF = "/root/testdata/sf0.001"


def test_mixed_headers_folder(spark, tmp_path):
    d = tmp_path / "returns"
    d.mkdir()
    (d / "a.csv").write_text("AWB,reason\n1001,damaged\n1002,late\n")
    (d / "b.csv").write_text("reason,AWB#,extra\nwrong,2001,x\n")
    (d / "c.csv").write_text("Tracking Id\n3001\n")
    (d / "d.csv").write_text("AWB,reason\n1003,late\n")
    df = read_csv_folder(spark, str(d), ["AWB", "AWB#", "Tracking Id"], "AWB")
    rows = {r["AWB"]: (r["reason"], r["extra"]) for r in df.collect()}
    assert rows == {
        "1001": ("damaged", None),
        "1002": ("late", None),
        "1003": ("late", None),
        "2001": ("wrong", "x"),
        "3001": (None, None),
    }


def test_first_alias_wins(spark, tmp_path):
    d = tmp_path / "r"
    d.mkdir()
    (d / "a.csv").write_text("AWB#,AWB\nx,y\n")
    df = read_csv_folder(spark, str(d), ["AWB", "AWB#"], "AWB")
    # 'AWB' is first in the alias list and present, so it is the one kept.
    assert df.columns == ["AWB#", "AWB"] and df.first()["AWB"] == "y"


def test_csv_with_schema(spark, tmp_path):
    p = tmp_path / "eta.csv"
    p.write_text("Region,Est. Time Arrival\nBandung,3\n")
    df = read_csv(spark, str(p), "Region string, eta int")
    assert df.first()["eta"] == 3


def test_replace_table_swaps(spark, tmp_path):
    path = str(tmp_path / "rfm")
    replace_table(spark.range(3), path)
    replace_table(spark.range(5, 7), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [5, 6]
    assert [p for p in os.listdir(tmp_path) if "staging" in p or ".old-" in p] == []


def test_write_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "matrix")
    df = spark.createDataFrame([("2024-01-01", 1.5, None)], "cohort_month string, `1` double, `2` double")
    write_csv(df, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["cohort_month", "1", "2"] and back.first()["1"] == "1.5"


def test_instruction_dataset_publish_and_load(spark, tmp_path):
    a = spark.createDataFrame([("Do", "x", "y")], "Instruction string, Input string, Output string")
    b = spark.createDataFrame([("Do2", "x2", "y2")], "instruction string, input string, output string")
    ds = instruction_dataset([lower_case_columns(a), b])
    assert ds.count() == 2 and all(t.endswith("</s>") for t in [r["text"] for r in ds.collect()])
    path = str(tmp_path / "pub")
    publish(ds, path)
    back = load_split(spark, path, "train")
    assert back.count() == 2 and "text" in back.columns


def test_empty_input_raises(spark):
    empty = spark.createDataFrame([], "instruction string, input string, output string")
    with pytest.raises(EmptyInput):
        instruction_dataset([empty])


def test_naming_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert name_columns(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        lower_case_columns(spark.createDataFrame([(1, 2)], "`A` int, `a2` int").toDF("A", "a"))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_streaming_hourly_leads_matches_batch(spark, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        compare_stream_with_batch(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def compare_stream_with_batch(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{SF}/events.parquet", src / "part-0.parquet")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    q = start_hourly_leads(spark, str(src), sink, ckpt)
    q.awaitTermination(300)
    streamed = totals(spark.read.parquet(sink))
    # Only windows the watermark has closed are final; compare those.
    ev = spark.read.parquet(f"{SF}/events.parquet")
    closed_before = ev.agg(F.max("ts")).first()[0].replace(minute=0, second=0, microsecond=0)
    import datetime as dt

    # Windows of a zone that is off by half an hour end up to an hour later.
    cutoff = closed_before - dt.timedelta(hours=3)
    ev = ev.withColumnRenamed("user_id", "staff_id").withColumn("product", F.get_json_object("props", "$.k").cast("int"))
    closed = kpi.restructure(kpi.split_valid(ev)[0])
    closed = closed.filter(F.col("ts") < F.lit(str(cutoff)).cast("timestamp_ntz"))
    batch = {(r["op_day"], r["hour"]): r["leads"] for r in kpi.leads_by_day_hour(closed).collect()}
    got = {(r["op_day"], r["hour"]): r["leads"] for r in streamed.collect()}
    assert got and all(got.get(k) == v for k, v in batch.items())
