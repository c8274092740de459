"""Structured Streaming form of the hourly lead count.

The reference has no streaming code; its dashboards are refreshed from
activity logs. This is the same KPI computed incrementally: events arrive as
files, each (operational day, clock hour) window is finalised once the
watermark passes it, and finished windows are appended to the sink. Summing
the sink by (op_day, hour) gives the batch result for all hours that the
watermark has passed; the last hours are emitted when later events arrive. A
clock hour can occur twice inside one operational day (12:00–12:30 at its end
and 12:31–12:59 at its start), and a window of the engine can span two clock
hours where the session's zone is off by half an hour; labels come from the
event's own time, so the sums are the same in every zone. Invalid events are
left out as in the batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custlens.functions.dates import hour_label, operational_day
from custlens.operators.kpi import LEAD, split_valid

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def hourly_leads(events: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Leads per (operational day, hour window) of a streaming event frame.

    ``withWatermark`` needs a zoned TIMESTAMP, so the NTZ event time is cast
    first; state for a window is dropped once the watermark passes its end.
    """
    valid, _ = split_valid(
        events.withColumn("staff_id", F.col("user_id")).withColumn("product", F.get_json_object("props", "$.k").try_cast("int"))
    )
    timed = valid.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", watermark)
    grouped = timed.groupBy(F.window("event_time", "1 hour").alias("w"), operational_day("ts").alias("op_day"), hour_label("ts").alias("hour"))
    counted = grouped.agg(F.count_if(F.col("event_type") == LEAD).alias("leads"))
    return counted.select(
        "op_day",
        "hour",
        F.col("w.start").alias("window_start"),
        "leads",
    )


def start_hourly_leads(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``hourly_leads`` from a folder of event parquet files into a
    parquet sink (append). ``checkpoint`` is a folder in shared storage of this
    source and sink alone: a query that is started again with it resumes where
    it stopped."""
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(source_dir)
    writer = (
        hourly_leads(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def totals(sink: DataFrame) -> DataFrame:
    """The batch G6 table from the appended windows."""
    return sink.groupBy("op_day", "hour").agg(F.sum("leads").alias("leads"))
