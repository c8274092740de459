"""Registered queries for the operational KPIs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.operators import kpi
from custlens.plans.registry import edge, query
from custlens.session import scratch_path, staged
from custlens.sources import fixtures as fx
from custlens.streaming import kpi_state

_EV_SQL = """,
dir AS (
  SELECT staff_id, min(array_to_string(list_transform(string_split(lower(trim(regexp_replace(staff_name, '\\s+', ' ', 'g'))), ' '),
                    lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')) AS staff_name
  FROM staff_directory GROUP BY staff_id),
ev AS (
  SELECT a.*, d.staff_name,
         CAST(a.ts - INTERVAL '12 hours 31 minutes' AS DATE) AS op_day,
         strftime(date_trunc('hour', a.ts), '%H:00') AS hour,
         a.event_type = 'signup' AS is_lead, a.event_type = 'purchase' AS is_purchase
  FROM staff_activity a LEFT JOIN dir d ON a.staff_id = d.staff_id
  WHERE a.ts IS NOT NULL AND a.staff_id IS NOT NULL AND a.event_type IS NOT NULL AND a.product IS NOT NULL),
pts AS (
  SELECT u.op_day, u.staff_id, u.product, u.units, t.target, t.weight, u.units >= t.target AS met,
         u.units * t.weight + CASE WHEN u.units >= t.target THEN t.bonus ELSE 0 END AS points,
         least(1.0, u.units / t.target) AS completion
  FROM (SELECT op_day, staff_id, product, count(*) AS units FROM ev WHERE is_purchase GROUP BY ALL) u
  JOIN targets t ON u.product = t.product),
daily AS (
  SELECT op_day, staff_id, CAST(sum(points) AS BIGINT) AS points, count(*) FILTER (WHERE met) AS targets_met,
         sum(least(units, target)) / (SELECT sum(target) FROM targets) AS completion_rate
  FROM pts GROUP BY ALL)
"""


def _sql(body: str) -> str:
    return fx.with_fixtures(_EV_SQL + body, "staff_activity", "staff_directory", "targets")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = kpi.split_valid(fx.staff_activity(spark, sf))
    return kpi.restructure(valid)


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.points(_events(spark, sf), fx.targets(spark))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.daily_achievement(_points(spark, sf), fx.targets(spark))


@query("op_day_hour_leads", _sql("SELECT op_day, hour, count(*) FILTER (WHERE is_lead) AS leads FROM ev GROUP BY ALL"))
def q_op_day_hour_leads(spark: SparkSession, sf: str) -> DataFrame:
    """Leads per operational day (from 12:31) and hour."""
    return edge(kpi.leads_by_day_hour(_events(spark, sf)))


@query(
    "conversion",
    _sql(
        """SELECT op_day, count(*) FILTER (WHERE is_lead) AS leads, count(*) FILTER (WHERE is_purchase) AS purchases,
       round(count(*) FILTER (WHERE is_purchase) / nullif(count(*) FILTER (WHERE is_lead), 0), 6) AS conversion_rate
FROM ev GROUP BY op_day"""
    ),
)
def q_conversion(spark: SparkSession, sf: str) -> DataFrame:
    """G7."""
    return edge(kpi.conversion(_events(spark, sf)).withColumn("conversion_rate", F.round("conversion_rate", 6)))


@query(
    "product_contribution",
    _sql(
        """SELECT op_day, product, round(revenue, 2) AS revenue,
       round(revenue / nullif(sum(revenue) OVER (PARTITION BY op_day), 0), 6) AS share
FROM (SELECT op_day, product, sum(value) AS revenue FROM ev WHERE is_purchase GROUP BY ALL)"""
    ),
)
def q_product_contribution(spark: SparkSession, sf: str) -> DataFrame:
    """G8."""
    out = kpi.product_contribution(_events(spark, sf))
    return edge(out.select("op_day", "product", F.round("revenue", 2).alias("revenue"), F.round("share", 6).alias("share")))


@query(
    "staff_summary",
    _sql(
        """SELECT op_day, staff_id, staff_name, count(*) AS events,
       count(*) FILTER (WHERE is_lead) AS leads, count(*) FILTER (WHERE is_purchase) AS purchases,
       round(coalesce(sum(value) FILTER (WHERE is_purchase), 0), 2) AS revenue
FROM ev GROUP BY ALL"""
    ),
)
def q_staff_summary(spark: SparkSession, sf: str) -> DataFrame:
    """G1 + G9: per (day, staff) with the directory name."""
    return edge(kpi.staff_summary(_events(spark, sf), fx.staff_directory(spark, sf)).withColumn("revenue", F.round("revenue", 2)))


def _streamed(spark: SparkSession, sf: str) -> str:
    """The state after all activity in three batches: arrival is by number of the event, which
    doesn't follow its time, and all days stay open until the end."""
    import datetime as dt

    activity = staged(fx.staff_activity(spark, sf), "activity")
    path = scratch_path(spark, f"kpi-state-{uuid.uuid4().hex}")
    for n in range(3):
        kpi_state.advance(activity.where(F.pmod("event_id", F.lit(3)) == n), path, n, grace=dt.timedelta(days=365))
    kpi_state.finish(spark, path)
    return path


@query(
    "staff_summary_stream",
    _sql(
        """SELECT op_day, staff_id, staff_name, count(*) AS events,
       count(*) FILTER (WHERE is_lead) AS leads, count(*) FILTER (WHERE is_purchase) AS purchases,
       round(coalesce(sum(value) FILTER (WHERE is_purchase), 0), 2) AS revenue
FROM ev GROUP BY ALL"""
    ),
)
def q_staff_summary_stream(spark: SparkSession, sf: str) -> DataFrame:
    """G1 + G9 from the state of a stream of batches."""
    grain = kpi_state.closed_days(spark, _streamed(spark, sf))
    return edge(kpi_state.staff_summary(grain, fx.staff_directory(spark, sf)).withColumn("revenue", F.round("revenue", 2)))


@query(
    "late_events",
    _sql(
        """,
seen AS (
  SELECT *, max(CASE WHEN event_id % 2 = 0 THEN ts END) OVER () - INTERVAL '2 hours' AS mark FROM ev)
SELECT event_id, 'late' AS reason FROM seen
WHERE event_id % 2 = 1 AND CAST(op_day AS TIMESTAMP) + INTERVAL '36 hours 31 minutes' <= mark
UNION ALL
SELECT event_id, CASE WHEN ts IS NULL THEN 'missing_ts' WHEN staff_id IS NULL THEN 'missing_staff'
                      WHEN event_type IS NULL THEN 'missing_event_type' ELSE 'bad_props' END
FROM staff_activity WHERE ts IS NULL OR staff_id IS NULL OR event_type IS NULL OR product IS NULL"""
    ),
)
def q_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """G2 on a stream: the rejects when events with even numbers arrive first and the odd ones after them."""
    activity = staged(fx.staff_activity(spark, sf), "activity")
    path = scratch_path(spark, f"kpi-state-{uuid.uuid4().hex}")
    for n in range(2):
        kpi_state.advance(activity.where(F.pmod("event_id", F.lit(2)) == n), path, n)
    return kpi_state.rejects(spark, path).select("event_id", "reason")


@query("points", _sql("SELECT op_day, staff_id, product, units, target, weight, met, points FROM pts"))
def q_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points against product targets."""
    return edge(_points(spark, sf).drop("completion"))


@query("completion", _sql("SELECT op_day, staff_id, product, round(completion, 6) AS completion FROM pts"))
def q_completion(spark: SparkSession, sf: str) -> DataFrame:
    """Individual completion rate per product."""
    return edge(_points(spark, sf).select("op_day", "staff_id", "product", F.round("completion", 6).alias("completion")))


@query(
    "daily_achievement",
    _sql("SELECT op_day, staff_id, points, targets_met, round(completion_rate, 6) AS completion_rate FROM daily"),
)
def q_daily_achievement(spark: SparkSession, sf: str) -> DataFrame:
    """G12."""
    return edge(_daily(spark, sf).withColumn("completion_rate", F.round("completion_rate", 6)))


@query(
    "leaderboard",
    _sql(
        "SELECT op_day, staff_id, points, CAST(dense_rank() OVER (PARTITION BY op_day ORDER BY points DESC) AS INTEGER) AS rank "
        "FROM daily"
    ),
)
def q_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Dense rank of daily points."""
    return edge(kpi.leaderboard(_daily(spark, sf)).select("op_day", "staff_id", "points", "rank"))


@query(
    "leaderboard_by_range",
    _sql(
        "SELECT op_day, staff_id, points, CAST(dense_rank() OVER (PARTITION BY op_day ORDER BY points DESC) AS INTEGER) AS rank "
        "FROM daily"
    ),
)
def q_leaderboard_by_range(spark: SparkSession, sf: str) -> DataFrame:
    """W3 by range partitions and prefix counts, for days of any size."""
    return edge(kpi.leaderboard_by_range(_daily(spark, sf)).select("op_day", "staff_id", "points", "rank"))


@query(
    "price_ranks",
    """SELECT l_returnflag, l_extendedprice,
       CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS INTEGER) AS rank
FROM (SELECT DISTINCT l_returnflag, l_extendedprice FROM lineitem)""",
)
def q_price_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """W3 over groups with very many different values: the dense rank of every price within its return flag."""
    from custlens.operators.ranking import dense_ranks
    from custlens.sources.tables import read_table

    lines = read_table(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice"])
    return dense_ranks(lines, ["l_returnflag"], "l_extendedprice")


@query(
    "event_quality",
    fx.with_fixtures(
        """SELECT coalesce(CASE WHEN ts IS NULL THEN 'missing_ts' WHEN staff_id IS NULL THEN 'missing_staff'
                     WHEN event_type IS NULL THEN 'missing_event_type' WHEN product IS NULL THEN 'bad_props' END,
                'valid') AS reason, count(*) AS n
FROM staff_activity GROUP BY ALL""",
        "staff_activity",
    ),
)
def q_event_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per validity outcome (valid + rejects = input)."""
    return kpi.validity_counts(fx.staff_activity(spark, sf))


@query(
    "event_rejects",
    fx.with_fixtures(
        """SELECT event_id, CASE WHEN ts IS NULL THEN 'missing_ts' WHEN staff_id IS NULL THEN 'missing_staff'
                      WHEN event_type IS NULL THEN 'missing_event_type' ELSE 'bad_props' END AS reason
FROM staff_activity
WHERE ts IS NULL OR staff_id IS NULL OR event_type IS NULL OR product IS NULL""",
        "staff_activity",
    ),
)
def q_event_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The rejected activity rows with their reason."""
    _, rejects = kpi.split_valid(fx.staff_activity(spark, sf))
    return rejects.select("event_id", "reason")
