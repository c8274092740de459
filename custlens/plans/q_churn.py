"""Registered queries for the churn notebook: C12–C15."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.dates import ts_literal
from custlens.operators import churn_report as rep
from custlens.operators.churn import churn_flag, churn_labels, depletion, receipt_dates
from custlens.operators.common import null_profile
from custlens.operators.returns import exclude_returned_tracking
from custlens.plans.registry import edge, query
from custlens.sources import fixtures as fx

AS_OF_SQL = f"TIMESTAMP '{fx.CHURN_AS_OF}'"
_FIXTURES = ("churn_customers", "returns", "eta", "unit_days")

_LABEL_SQL = f"""
kept AS (
  SELECT * FROM churn_customers c
  WHERE NOT EXISTS (SELECT 1 FROM returns r WHERE r.AWB = CAST(c.tracking_code AS VARCHAR))),
valid AS (SELECT * FROM kept WHERE invoice_date IS DISTINCT FROM '0000-00-00'),
eta1 AS (
  SELECT DISTINCT ON (lower(region)) lower(region) AS rk, eta_days
  FROM eta ORDER BY lower(region), priority NULLS LAST, eta_days),
r0 AS (
  SELECT v.* REPLACE (lower(replace(replace(v.region, 'Kab. ', ''), 'Kota ', '')) AS region) FROM valid v),
r1 AS (
  SELECT r0.*, CASE WHEN e.rk IS NOT NULL THEN CAST(e.eta_days AS VARCHAR) ELSE '5' END AS eta_txt
  FROM r0 LEFT JOIN eta1 e ON r0.region = e.rk),
r2 AS (
  SELECT r1.*,
         CASE WHEN regexp_full_match(eta_txt, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim(eta_txt) AS INTEGER)
              ELSE CAST(trunc(TRY_CAST(eta_txt AS DOUBLE)) AS INTEGER) END AS eta_n,
         CASE WHEN regexp_full_match(invoice_date, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
              THEN TRY_CAST(invoice_date AS DATE) END AS inv_d
  FROM r1),
r3 AS (
  SELECT r2.*, TRY_CAST(eta_txt AS DOUBLE) AS eta_days,
         CASE WHEN inv_d IS NOT NULL AND eta_n IS NOT NULL THEN inv_d + eta_n END AS receipt_date,
         CAST(trunc(coalesce(TRY_CAST(quantity * u.days_per_unit AS DOUBLE), 0)) AS BIGINT) AS depletion_days,
         CAST(trunc(coalesce(TRY_CAST(u.days_per_unit AS DOUBLE), 0)) AS BIGINT) AS days_per_unit
  FROM r2 LEFT JOIN unit_days u ON r2.product = u.product_name),
r4 AS (
  SELECT r3.*, CASE WHEN receipt_date IS NOT NULL THEN receipt_date + CAST(depletion_days AS INTEGER) END AS depletion_date
  FROM r3),
r5 AS (
  SELECT r4.*, CASE WHEN depletion_date IS NOT NULL THEN
           CAST(floor(date_diff('microsecond', CAST(receipt_date AS TIMESTAMP), {AS_OF_SQL}) / 86400000000.0) AS BIGINT)
         END AS interval
  FROM r4),
labelled AS (
  SELECT product, quantity, invoice_date, tracking_code, region, eta_days, receipt_date, days_per_unit,
         depletion_days, depletion_date, interval,
         CASE WHEN interval IS NULL THEN 'Invalid' WHEN interval < 0 THEN 'Tidak'
              WHEN depletion_days >= interval THEN 'Tidak' ELSE 'Ya' END AS churn,
         boxes, monetary
  FROM r5)"""


def _sql(body: str, *extra: str) -> str:
    return fx.with_fixtures(",\n" + _LABEL_SQL.strip() + "\n" + body, *_FIXTURES, *extra)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return churn_labels(
        fx.churn_customers(spark, sf),
        fx.returns(spark, sf),
        fx.eta(spark, sf),
        fx.unit_days(spark, sf),
        ts_literal(fx.CHURN_AS_OF),
        returns_col="AWB",
    )


_LABEL_COLS = (
    "product quantity invoice_date tracking_code region eta_days receipt_date days_per_unit "
    "depletion_days depletion_date interval churn boxes monetary"
).split()


@query(
    "receipt_date",
    _sql("SELECT product, tracking_code, region, invoice_date, eta_days, receipt_date FROM labelled"),
)
def q_receipt_date(spark: SparkSession, sf: str) -> DataFrame:
    """C12 (J5, P6, F14, J6, F5)."""
    df = exclude_returned_tracking(fx.churn_customers(spark, sf), fx.returns(spark, sf), "tracking_code", "AWB")
    df = df.filter(~F.col("invoice_date").eqNullSafe("0000-00-00"))
    df = receipt_dates(df, fx.eta(spark, sf))
    return edge(df.select("product", "tracking_code", "region", "invoice_date", "eta_days", "receipt_date"))


@query(
    "depletion",
    _sql(
        "SELECT product, tracking_code, quantity, receipt_date, days_per_unit, depletion_days, depletion_date "
        "FROM labelled"
    ),
)
def q_depletion(spark: SparkSession, sf: str) -> DataFrame:
    """C13 (J8, F2, F17, F5)."""
    df = exclude_returned_tracking(fx.churn_customers(spark, sf), fx.returns(spark, sf), "tracking_code", "AWB")
    df = df.filter(~F.col("invoice_date").eqNullSafe("0000-00-00"))
    df = depletion(receipt_dates(df, fx.eta(spark, sf)), fx.unit_days(spark, sf))
    return edge(
        df.select("product", "tracking_code", "quantity", "receipt_date", "days_per_unit", "depletion_days", "depletion_date")
    )


@query(
    "churn_labels",
    _sql(
        "SELECT * REPLACE (CAST(interval AS DOUBLE) AS interval) FROM labelled"
    ),
)
def q_churn_labels(spark: SparkSession, sf: str) -> DataFrame:
    """C14: the labelled table (F6 on the receipt date, Q16)."""
    return edge(_labelled(spark, sf).select(*_LABEL_COLS), doubles=("interval",))


@query("churn_counts", _sql("SELECT churn, count(*) AS n FROM labelled GROUP BY churn"))
def q_churn_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A13 / O1."""
    return rep.label_counts(_labelled(spark, sf))


@query("churn_by_product", _sql("SELECT product, churn, count(*) AS n FROM labelled GROUP BY ALL"))
def q_churn_by_product(spark: SparkSession, sf: str) -> DataFrame:
    """A14."""
    return rep.label_counts_by_product(_labelled(spark, sf))


@query(
    "churn_share",
    _sql(
        """SELECT product, churn, n, round(n * 100.0 / sum(n) OVER (PARTITION BY product), 4) AS percentage
FROM (SELECT product, churn, count(*) AS n FROM labelled GROUP BY ALL)"""
    ),
)
def q_churn_share(spark: SparkSession, sf: str) -> DataFrame:
    """A15 (with J9: all products)."""
    out = rep.label_share(rep.restrict_products(_labelled(spark, sf), None))
    return out.withColumn("percentage", F.round("percentage", 4))


@query(
    "churn_crosstab",
    _sql(
        """SELECT product,
       count(*) FILTER (WHERE churn = 'Invalid') AS Invalid,
       count(*) FILTER (WHERE churn = 'Tidak') AS Tidak,
       count(*) FILTER (WHERE churn = 'Ya') AS Ya
FROM labelled GROUP BY product"""
    ),
)
def q_churn_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    """A16."""
    return rep.label_crosstab(_labelled(spark, sf))


@query(
    "churn_share_dense",
    _sql(
        """, labs AS (SELECT * FROM (VALUES ('Invalid'), ('Tidak'), ('Ya')) v(churn)),
prods AS (SELECT product, count(*) AS total FROM labelled GROUP BY product),
cnt AS (SELECT product, churn, count(*) AS n FROM labelled GROUP BY ALL)
SELECT p.product, l.churn, round(coalesce(c.n, 0) * 100.0 / p.total, 4) AS percentage
FROM prods p JOIN labs l ON TRUE LEFT JOIN cnt c ON c.product = p.product AND c.churn = l.churn"""
    ),
)
def q_churn_share_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Shares with zero rows for absent labels."""
    return rep.label_share_dense(_labelled(spark, sf)).withColumn("percentage", F.round("percentage", 4))


@query(
    "churn_value",
    _sql(
        """SELECT c.product, c.churn, c.n, p.price, round(c.n * p.price, 2) AS total
FROM (SELECT product, churn, count(*) AS n FROM labelled GROUP BY ALL) c
LEFT JOIN prices p ON c.product = p.product_name""",
        "prices",
    ),
)
def q_churn_value(spark: SparkSession, sf: str) -> DataFrame:
    """Potential value = label count × unit price."""
    out = rep.label_value(_labelled(spark, sf), fx.prices(spark, sf))
    return out.withColumn("total", F.round("total", 2))


@query(
    "churn_money",
    _sql("SELECT product, churn, round(coalesce(sum(monetary), 0), 2) AS sum_monetary FROM labelled GROUP BY ALL"),
)
def q_churn_money(spark: SparkSession, sf: str) -> DataFrame:
    """A21."""
    out = rep.label_sum(_labelled(spark, sf), "monetary")
    return out.withColumn("sum_monetary", F.round("sum_monetary", 2))


@query(
    "churn_boxes",
    _sql("SELECT product, churn, CAST(coalesce(sum(boxes), 0) AS BIGINT) AS sum_boxes FROM labelled GROUP BY ALL"),
)
def q_churn_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A22."""
    return rep.label_sum(_labelled(spark, sf), "boxes")


@query(
    "churn_flag",
    _sql(
        "SELECT product, tracking_code, churn, CASE WHEN churn = 'Ya' THEN 0 ELSE 1 END AS churn_flag FROM labelled"
    ),
)
def q_churn_flag(spark: SparkSession, sf: str) -> DataFrame:
    """the plots' 0/1 recoding, per row."""
    df = _labelled(spark, sf)
    return df.select("product", "tracking_code", "churn", churn_flag(F.col("churn")).alias("churn_flag"))


_SUMMARY_SQL = """
SELECT '{c}' AS column_name, CAST(trunc(avg({c})) AS BIGINT) AS mean, quantile_cont({c}, 0.5) AS median,
       (SELECT {c} FROM labelled WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
       min({c}) AS min, max({c}) AS max
FROM labelled"""


@query(
    "interval_summary",
    _sql(_SUMMARY_SQL.format(c="depletion_days") + "\nUNION ALL" + _SUMMARY_SQL.format(c="interval")),
)
def q_interval_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A10 for the estimated depletion days and the interval."""
    return rep.column_summary(_labelled(spark, sf), ["depletion_days", "interval"])


_VALID_SQL = ", vi AS (SELECT product, CAST(coalesce(interval, 0) AS BIGINT) AS interval FROM labelled)\n"


@query(
    "interval_stats",
    _sql(
        _VALID_SQL
        + """SELECT product, round(avg(interval), 4) AS mean, quantile_cont(interval, 0.5) AS median,
       min(interval) AS min, max(interval) AS max
FROM vi GROUP BY product"""
    ),
)
def q_interval_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A11 with Invalid as 0 (Q14)."""
    return rep.interval_stats(_labelled(spark, sf)).withColumn("mean", F.round("mean", 4))


@query(
    "interval_modes",
    _sql(
        _VALID_SQL
        + """, c AS (SELECT product, interval, count(*) AS n FROM vi GROUP BY ALL)
SELECT product, interval AS mode FROM (
  SELECT *, max(n) OVER (PARTITION BY product) AS mx FROM c) WHERE n = mx"""
    ),
)
def q_interval_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Every mode per product (the sorted list, one row per element)."""
    modes = rep.interval_modes(_labelled(spark, sf))
    return modes.select("product", F.explode("modes").alias("mode"))


@query(
    "interval_stats_modes",
    _sql(
        _VALID_SQL
        + """, c AS (SELECT product, interval, count(*) AS n FROM vi GROUP BY ALL),
m AS (SELECT product, interval AS mode FROM (SELECT *, max(n) OVER (PARTITION BY product) AS mx FROM c) WHERE n = mx)
SELECT s.product, mean, median, min, max, mode FROM (
  SELECT product, round(avg(interval), 4) AS mean, quantile_cont(interval, 0.5) AS median,
         min(interval) AS min, max(interval) AS max FROM vi GROUP BY product) s JOIN m ON s.product = m.product"""
    ),
)
def q_interval_stats_modes(spark: SparkSession, sf: str) -> DataFrame:
    """A11 joined to A12, one row per product and mode."""
    out = rep.interval_stats_modes(_labelled(spark, sf)).withColumn("mean", F.round("mean", 4))
    return out.select("product", "mean", "median", "min", "max", F.explode("modes").alias("mode"))


@query(
    "churn_counts_products",
    _sql("SELECT product, churn, count(*) AS n FROM labelled WHERE product IN ('Brand#11', 'Brand#23') GROUP BY ALL"),
)
def q_churn_counts_products(spark: SparkSession, sf: str) -> DataFrame:
    """A report over a list of products."""
    return rep.label_counts_by_product(rep.restrict_products(_labelled(spark, sf), ["Brand#11", "Brand#23"]))


@query(
    "interval_box",
    _sql(
        _VALID_SQL
        + """, q AS (
  SELECT product, quantile_cont(interval, 0.25) AS q1, quantile_cont(interval, 0.5) AS median,
         quantile_cont(interval, 0.75) AS q3 FROM vi GROUP BY product),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.product, q1, median, q3, iqr,
       min(interval) FILTER (WHERE interval >= lo AND interval <= hi) AS whisker_low,
       max(interval) FILTER (WHERE interval >= lo AND interval <= hi) AS whisker_high,
       count(*) FILTER (WHERE NOT (interval >= lo AND interval <= hi)) AS outliers
FROM vi JOIN f ON vi.product = f.product
GROUP BY f.product, q1, median, q3, iqr"""
    ),
)
def q_interval_box(spark: SparkSession, sf: str) -> DataFrame:
    """The box plot's numbers."""
    out = rep.interval_box(_labelled(spark, sf))
    return out.withColumn("outliers", F.col("outliers").cast("bigint"))


@query(
    "interval_hist",
    _sql(
        _VALID_SQL
        + """SELECT product, CAST(floor(interval / 90) AS BIGINT) AS bin, count(*) AS n,
       CAST(floor(interval / 90) AS BIGINT) * 90 AS bin_start
FROM vi GROUP BY ALL"""
    ),
)
def q_interval_hist(spark: SparkSession, sf: str) -> DataFrame:
    """The scatter plot as a 90-day histogram per product."""
    return rep.interval_histogram(_labelled(spark, sf), width=90)


_PROFILE_TYPES = {
    "product": "string",
    "quantity": "int",
    "invoice_date": "string",
    "tracking_code": "string",
    "region": "string",
    "eta_days": "double",
    "receipt_date": "date",
    "days_per_unit": "bigint",
    "depletion_days": "bigint",
    "depletion_date": "date",
    "interval": "bigint",
    "churn": "string",
    "boxes": "int",
    "monetary": "double",
}


@query(
    "null_profile",
    _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM labelled"
            for c, t in _PROFILE_TYPES.items()
        )
    ),
)
def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Type and NULL count of every column of the labelled table."""
    return null_profile(_labelled(spark, sf).select(*_LABEL_COLS))
