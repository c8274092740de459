"""Registered queries for the segmentation ETL: C1, C2, C4–C8, M1–M3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.dates import ts_literal
from custlens.operators.funnel import funnel_single_pack, funnel_two_pack
from custlens.operators.returns import exclude_high_return
from custlens.operators.rfm import repeat_order_score, rfm_excluding_returns
from custlens.plans.registry import edge, query
from custlens.sources import fixtures as fx

AS_OF_SQL = f"TIMESTAMP '{fx.SEGMENT_AS_OF}'"

# --- oracle building blocks -------------------------------------------------

_KEPT_SQL = """
bad AS (
  SELECT customer_id, product_name FROM sales
  GROUP BY customer_id, product_name
  HAVING count(*) > 3 AND count(*) FILTER (WHERE sale_status = 3) * 100 >= 50 * count(*)),
kept AS (
  SELECT s.* EXCLUDE (sale_status) FROM sales s
  WHERE NOT EXISTS (SELECT 1 FROM bad b
                    WHERE b.customer_id = s.customer_id AND b.product_name = s.product_name))"""

_PREP_SQL = """
prepared AS (
  SELECT * REPLACE (
           TRY_CAST(invoice_date AS TIMESTAMP) AS invoice_date,
           coalesce(TRY_CAST(last_shipment_date AS TIMESTAMP),
                    TRY_CAST(invoice_date AS TIMESTAMP) + INTERVAL 5 DAY) AS last_shipment_date),
         product_name AS given_product_name
  FROM kept)"""

_RFM_SQL = f"""
rfm AS (
  SELECT customer_id, given_product_name AS product_name,
         max(last_shipment_date) AS last_shipment_date,
         count(*) AS frequency,
         coalesce(sum(product_sales_total), 0) AS monetary,
         arg_max(product_qty, {{'a': last_shipment_date, 'b': product_qty}})
           FILTER (WHERE last_shipment_date IS NOT NULL) AS product_qty
  FROM prepared
  WHERE customer_id IS NOT NULL AND given_product_name IS NOT NULL
  GROUP BY customer_id, given_product_name),
rfm_r AS (
  SELECT *, CAST(floor(date_diff('microsecond', last_shipment_date, {AS_OF_SQL}) / 86400000000.0) AS BIGINT) AS _d
  FROM rfm)"""

_FUNNEL_LADDER = f"""CASE WHEN depletion_date >= {AS_OF_SQL} THEN 'Hot'
            WHEN depletion_date >= {AS_OF_SQL} - INTERVAL 3 MONTH THEN 'Warm'
            ELSE 'Cold' END"""


def _with(*ctes: str) -> str:
    return ",\n".join(c.strip() for c in ctes)


def _seg_sql(body: str, *fixtures: str) -> str:
    return fx.with_fixtures(body, "sales", *fixtures)


# --- Spark building blocks --------------------------------------------------


def _as_of():
    return ts_literal(fx.SEGMENT_AS_OF)


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return exclude_high_return(fx.sales(spark, sf))


def _rfm(spark: SparkSession, sf: str) -> DataFrame:
    return rfm_excluding_returns(fx.sales(spark, sf, geo=False), _as_of())


# --- queries ----------------------------------------------------------------


@query(
    "exclude_high_return",
    _seg_sql(",\n" + _with(_KEPT_SQL) + "\nSELECT * FROM kept"),
)
def q_exclude_high_return(spark: SparkSession, sf: str) -> DataFrame:
    """C1 (with P7, A1, A2, J1, F16): sales rows kept after the return rule."""
    return _kept(spark, sf)


@query(
    "rfm",
    _seg_sql(
        ",\n" + _with(_KEPT_SQL, _PREP_SQL, _RFM_SQL)
        + """
SELECT customer_id, product_name, last_shipment_date,
       CASE WHEN _d < 0 THEN 0 ELSE _d END AS recency,
       frequency, round(monetary, 2) AS monetary, product_qty
FROM rfm_r"""
    ),
)
def q_rfm(spark: SparkSession, sf: str) -> DataFrame:
    """C2 (A1, A3, A4, A5, F3, F4, F6, F7, J2)."""
    return _rfm(spark, sf).withColumn("monetary", F.round("monetary", 2))


@query(
    "repeat_order",
    _seg_sql(
        ",\n" + _with(_KEPT_SQL, _PREP_SQL, _RFM_SQL)
        + """
SELECT customer_id, product_name, frequency,
       CASE WHEN frequency IN (1, 2, 3, 4, 5) THEN CAST(frequency - 1 AS INTEGER) ELSE 5 END AS repeat_order
FROM rfm"""
    ),
)
def q_repeat_order(spark: SparkSession, sf: str) -> DataFrame:
    """C6."""
    return _rfm(spark, sf).select(
        "customer_id", "product_name", "frequency", repeat_order_score("frequency").alias("repeat_order")
    )


@query(
    "last_quantity",
    _seg_sql(
        ",\n" + _with(_KEPT_SQL, _PREP_SQL, _RFM_SQL)
        + "\nSELECT customer_id, product_name, last_shipment_date, product_qty FROM rfm"
    ),
)
def q_last_quantity(spark: SparkSession, sf: str) -> DataFrame:
    """A5: quantity on the latest shipment, largest quantity on ties (Q13)."""
    return _rfm(spark, sf).select("customer_id", "product_name", "last_shipment_date", "product_qty")


@query(
    "funnel_single",
    _seg_sql(
        ",\n" + _with(_KEPT_SQL, _PREP_SQL, _RFM_SQL)
        + f""",
f AS (
  SELECT r.customer_id, r.product_name, r.last_shipment_date, r.product_qty,
         CAST(u.days_per_unit AS DOUBLE) AS days_per_unit,
         r.last_shipment_date + to_days(CAST(r.product_qty * u.days_per_unit AS INTEGER)) AS depletion_date
  FROM rfm r LEFT JOIN unit_days u ON r.product_name = u.product_name)
SELECT *, {_FUNNEL_LADDER} AS funnel FROM f""",
        "unit_days",
    ),
)
def q_funnel_single(spark: SparkSession, sf: str) -> DataFrame:
    """C4 (J8, F12, F17) on the RFM rows, one pack size per product."""
    out = funnel_single_pack(_rfm(spark, sf), fx.unit_days(spark, sf), _as_of())
    out = out.select(
        "customer_id", "product_name", "last_shipment_date", "product_qty", "days_per_unit", "depletion_date", "funnel"
    )
    return edge(out, doubles=("days_per_unit",))


@query(
    "funnel_two_pack",
    _seg_sql(
        ",\n" + _with(_KEPT_SQL, _PREP_SQL)
        + f""",
day AS (
  SELECT customer_id, given_product_name AS product_name, last_shipment_date,
         max(product_qty) FILTER (WHERE pack = 'large') AS q_large,
         max(product_qty) FILTER (WHERE pack = 'small') AS q_small
  FROM prepared
  WHERE customer_id IS NOT NULL AND given_product_name IS NOT NULL
  GROUP BY ALL),
pair AS (
  SELECT customer_id, product_name, max(last_shipment_date) AS last_shipment_date,
         arg_max_null(q_large, last_shipment_date) FILTER (WHERE last_shipment_date IS NOT NULL) AS qty_large,
         arg_max_null(q_small, last_shipment_date) FILTER (WHERE last_shipment_date IS NOT NULL) AS qty_small
  FROM day GROUP BY ALL),
cfg AS (
  SELECT product_name,
         max(days_per_unit) FILTER (WHERE pack = 'large') AS d_large,
         max(days_per_unit) FILTER (WHERE pack = 'small') AS d_small
  FROM pack_days GROUP BY product_name),
f AS (
  SELECT p.*, last_shipment_date + to_days(CAST(
           CASE WHEN c.product_name IS NOT NULL
                THEN coalesce(qty_large * d_large, 0) + coalesce(qty_small * d_small, 0) END AS INTEGER)) AS depletion_date
  FROM pair p LEFT JOIN cfg c ON p.product_name = c.product_name)
SELECT customer_id, product_name, last_shipment_date,
       CAST(qty_large AS DOUBLE) AS qty_large, CAST(qty_small AS DOUBLE) AS qty_small, depletion_date,
       {_FUNNEL_LADDER} AS funnel
FROM f""",
        "pack_days",
    ),
)
def q_funnel_two_pack(spark: SparkSession, sf: str) -> DataFrame:
    """C5 (W2, A7, A8, P9) with the pack table replacing the hard-coded branches."""
    out = funnel_two_pack(
        fx.sales(spark, sf, geo=False), fx.pack_days(spark, sf), _as_of(), exclude_returns=True, packs=fx.PACKS
    )
    return edge(out, doubles=("qty_large", "qty_small"))


# --- segmentation (M1, M2b, M3, C3, C7, C8) ---------------------------------

_SCORED_SQL = f"""
day AS (
  SELECT customer_id, given_product_name AS product_name, last_shipment_date,
         count(*) AS n, sum(product_sales_total) AS sales, max(product_qty) AS qty,
         max(product_qty) FILTER (WHERE pack = 'large') AS q_large,
         max(product_qty) FILTER (WHERE pack = 'small') AS q_small
  FROM prepared
  WHERE customer_id IS NOT NULL AND given_product_name IS NOT NULL
  GROUP BY ALL),
pair AS (
  SELECT customer_id, product_name, sum(n) AS frequency, coalesce(sum(sales), 0) AS monetary,
         max(last_shipment_date) AS last_shipment_date,
         arg_max_null(qty, last_shipment_date) FILTER (WHERE last_shipment_date IS NOT NULL) AS product_qty,
         arg_max_null(q_large, last_shipment_date) FILTER (WHERE last_shipment_date IS NOT NULL) AS qty_large,
         arg_max_null(q_small, last_shipment_date) FILTER (WHERE last_shipment_date IS NOT NULL) AS qty_small
  FROM day GROUP BY ALL),
cfg AS (
  SELECT product_name,
         max(days_per_unit) FILTER (WHERE pack = 'large') AS d_large,
         max(days_per_unit) FILTER (WHERE pack = 'small') AS d_small
  FROM pack_days GROUP BY product_name),
dep AS (
  SELECT p.*, coalesce(
           CASE WHEN c.product_name IS NOT NULL
                THEN coalesce(qty_large * d_large, 0) + coalesce(qty_small * d_small, 0) END,
           p.product_qty * u.days_per_unit) AS depletion_days,
         CAST(floor(date_diff('microsecond', p.last_shipment_date, {AS_OF_SQL}) / 86400000000.0) AS BIGINT) AS _d
  FROM pair p LEFT JOIN cfg c ON p.product_name = c.product_name
  LEFT JOIN unit_days u ON p.product_name = u.product_name),
scored AS (
  SELECT customer_id, product_name, last_shipment_date,
         CASE WHEN _d < 0 THEN 0 ELSE _d END AS recency, CAST(frequency AS BIGINT) AS frequency, monetary, product_qty,
         CASE WHEN depletion_date >= {AS_OF_SQL} THEN 'Hot'
              WHEN depletion_date >= {AS_OF_SQL} - INTERVAL 3 MONTH THEN 'Warm' ELSE 'Cold' END AS funnel
  FROM (SELECT *, last_shipment_date + to_days(CAST(depletion_days AS INTEGER)) AS depletion_date FROM dep)),
stats AS (
  SELECT product_name,
         avg(recency) AS m_r, stddev_pop(recency) AS s_r,
         avg(frequency) AS m_f, stddev_pop(frequency) AS s_f,
         avg(monetary) AS m_m, stddev_pop(monetary) AS s_m
  FROM scored GROUP BY product_name),
scaled AS (
  SELECT s.*,
         CASE WHEN s_r IS NULL OR s_r = 0 THEN 0.0 ELSE (recency - m_r) / s_r END AS z_recency,
         CASE WHEN s_f IS NULL OR s_f = 0 THEN 0.0 ELSE (frequency - m_f) / s_f END AS z_frequency,
         CASE WHEN s_m IS NULL OR s_m = 0 THEN 0.0 ELSE (monetary - m_m) / s_m END AS z_monetary
  FROM scored s LEFT JOIN stats st ON s.product_name = st.product_name)"""

_CENTS_SQL = """
bounds AS (
  SELECT product_name,
         min(z_recency) AS lo_r, max(z_recency) AS hi_r,
         min(z_frequency) AS lo_f, max(z_frequency) AS hi_f,
         min(z_monetary) AS lo_m, max(z_monetary) AS hi_m
  FROM scaled GROUP BY product_name),
cents AS (
  SELECT product_name, j AS cluster,
         lo_r + ((j + 0.5::DOUBLE) / 5) * (hi_r - lo_r) AS c_r,
         lo_f + ((j + 0.5::DOUBLE) / 5) * (hi_f - lo_f) AS c_f,
         lo_m + ((j + 0.5::DOUBLE) / 5) * (hi_m - lo_m) AS c_m
  FROM bounds, (SELECT CAST(range AS INTEGER) AS j FROM range(5)))"""

_GRID_SQL = """
assigned AS (
  SELECT s.customer_id, s.product_name,
         arg_min(c.cluster, {'d': (c_r - z_recency) * (c_r - z_recency) + (c_f - z_frequency) * (c_f - z_frequency)
                                  + (c_m - z_monetary) * (c_m - z_monetary), 'c': c.cluster}) AS cluster
  FROM scaled s JOIN cents c ON s.product_name = c.product_name
  GROUP BY s.customer_id, s.product_name)"""

_NAMED_SQL = """
seg AS (
  SELECT s.*, a.cluster FROM scaled s JOIN assigned a
  ON s.customer_id = a.customer_id AND s.product_name = a.product_name),
medians AS (
  SELECT product_name, cluster, median(frequency) AS median_frequency,
         CASE WHEN median(frequency) >= 6 THEN 'Champion' WHEN median(frequency) >= 2 THEN 'Loyal'
              WHEN median(frequency) < 2 THEN 'Potential Loyal' ELSE 'At Risk' END AS cluster_name
  FROM seg GROUP BY product_name, cluster),
named AS (
  SELECT s.*, s.cluster AS cluster_id,
         CASE WHEN s.frequency > 5 THEN 'Champion' ELSE m.cluster_name END AS segment_name
  FROM seg s LEFT JOIN medians m ON s.product_name = m.product_name AND s.cluster = m.cluster)"""

_SEG_FIXTURES = ("unit_days", "pack_days")


def _seg_chain_sql(body: str, assigned: str = _GRID_SQL) -> str:
    """``assigned`` is the SQL of the rows' clusters, by the grid seeds or by K-Means."""
    chain = _with(_KEPT_SQL, _PREP_SQL, _SCORED_SQL, _CENTS_SQL, assigned, _NAMED_SQL)
    return _seg_sql(",\n" + chain + "\n" + body, *_SEG_FIXTURES).replace("WITH ", "WITH RECURSIVE ", 1)


# --- K-Means, written out: k-means|| seeds, the draws, Lloyd rounds, the best start ---

_U = "((CAST('0x' || substr(md5(concat_ws('|', 'custlens', {start}, '{step}', {key})), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656)"
_XYW_D2 = "(({a}.x - {b}.x) * ({a}.x - {b}.x) + ({a}.y - {b}.y) * ({a}.y - {b}.y) + ({a}.w - {b}.w) * ({a}.w - {b}.w))"
_D2 = _XYW_D2.format(a="c", b="p")


def _fixed(x: str) -> str:
    return f"floor({x} * 1000000 + 0.5::DOUBLE)"


def _kmeans_sql(k: int = 5, rounds: int = 3, starts: int = 3) -> str:
    ctes = [
        f"""
pts AS MATERIALIZED (
  SELECT product_name, customer_id, concat_ws('|', customer_id, product_name) AS key,
         {_fixed("z_recency")} AS x, {_fixed("z_frequency")} AS y, {_fixed("z_monetary")} AS w FROM scaled),
cand0 AS MATERIALIZED (
  SELECT product_name, s AS start, 0 AS step, unnest(arg_min({{'key': key, 'x': x, 'y': y, 'w': w}},
         {{'u': {_U.format(start="s", step="first", key="key")}, 'key': key}}))
  FROM pts, (SELECT CAST(range AS INTEGER) AS s FROM range({starts})) GROUP BY product_name, s)"""
    ]
    for r in range(1, rounds + 1):
        ctes.append(f"""
near{r} AS MATERIALIZED (
  SELECT p.product_name, c.start, p.key, p.x, p.y, p.w, min({_D2}) AS d2
  FROM pts p JOIN cand{r - 1} c USING (product_name) GROUP BY ALL),
cost{r} AS (SELECT product_name, start, CAST(sum(CAST(floor(d2 / 1000000) AS BIGINT)) AS DOUBLE) AS cost FROM near{r} GROUP BY ALL),
cand{r} AS MATERIALIZED (
  SELECT product_name, start, step, key, x, y, w FROM cand{r - 1} UNION ALL
  SELECT n.product_name, n.start, {r}, n.key, n.x, n.y, n.w FROM near{r} n JOIN cost{r} USING (product_name, start)
  WHERE {_U.format(start="n.start", step=r, key="n.key")} * cost < {2 * k} * floor(d2 / 1000000))""")
    ctes.append(f"""
listed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY product_name, start ORDER BY step, key, x, y, w) - 1 AS n FROM cand{rounds}),
own AS (
  SELECT product_name, start, n, count(*) AS weight FROM (
    SELECT p.product_name, c.start, p.key, arg_min(c.n, {{'d2': {_D2}, 'n': c.n}}) AS n
    FROM pts p JOIN listed c USING (product_name) GROUP BY ALL) GROUP BY ALL),
weighted AS MATERIALIZED (
  SELECT l.*, coalesce(o.weight, 0) AS weight FROM listed l LEFT JOIN own o USING (product_name, start, n)),
drawn1 AS MATERIALIZED (
  SELECT product_name, start, 0 AS cluster, unnest(arg_min({{'x': x, 'y': y, 'w': w}},
         {{'at': -ln({_U.format(start="start", step="pick1", key="key")}) / weight, 'n': n}}))
  FROM weighted WHERE weight > 0 GROUP BY product_name, start)""")
    for j in range(2, k + 1):
        ctes.append(f"""
drawn{j} AS MATERIALIZED (
  SELECT * FROM drawn{j - 1} UNION ALL
  SELECT product_name, start, {j - 1}, unnest(arg_min({{'x': x, 'y': y, 'w': w}},
         {{'at': -ln({_U.format(start="start", step=f"pick{j}", key="key")}) / rate, 'n': n}}))
  FROM (SELECT p.product_name, p.start, p.n, p.key, p.x, p.y, p.w, p.weight * min({_D2}) AS rate
        FROM weighted p JOIN drawn{j - 1} c USING (product_name, start) GROUP BY p.product_name, p.start, p.n, p.key, p.x, p.y, p.w, p.weight)
  WHERE rate > 0 GROUP BY product_name, start)""")
    moved = _XYW_D2.format(a="m", b="l")
    ctes.append(f"""
seeds AS (
  SELECT product_name, start, cluster, x, y, w FROM drawn{k} UNION ALL
  SELECT product_name, {starts}, cluster, {_fixed("c_r")}, {_fixed("c_f")}, {_fixed("c_m")} FROM cents),
lloyd AS (
  SELECT product_name, start, cluster, x, y, w, true AS moving FROM seeds
  UNION ALL
  SELECT product_name, start, cluster, x, y, w, sum(shift) OVER (PARTITION BY product_name, start) > 100000000
  FROM (
    SELECT l.product_name, l.start, l.cluster, coalesce(m.x, l.x) AS x, coalesce(m.y, l.y) AS y, coalesce(m.w, l.w) AS w,
           coalesce({moved}, 0) AS shift
    FROM lloyd l LEFT JOIN (
      SELECT product_name, start, cluster, floor(sum(x) / count(*) + 0.5::DOUBLE) AS x,
             floor(sum(y) / count(*) + 0.5::DOUBLE) AS y, floor(sum(w) / count(*) + 0.5::DOUBLE) AS w
      FROM (SELECT p.product_name, c.start, p.key, p.x, p.y, p.w, arg_min(c.cluster, {{'d2': {_D2}, 'c': c.cluster}}) AS cluster
            FROM pts p JOIN lloyd c ON p.product_name = c.product_name WHERE c.moving
            GROUP BY p.product_name, c.start, p.key, p.x, p.y, p.w)
      GROUP BY product_name, start, cluster) m
    ON m.product_name = l.product_name AND m.start = l.start AND m.cluster = l.cluster
    WHERE l.moving)),
settled AS MATERIALIZED (SELECT product_name, start, cluster, x, y, w FROM lloyd WHERE NOT moving),
best AS (
  SELECT product_name, arg_min(start, {{'cost': cost, 'start': start}}) AS start FROM (
    SELECT product_name, start, CAST(sum(CAST(floor(d2 / 1000000) AS BIGINT)) AS DOUBLE) AS cost FROM (
      SELECT p.product_name, c.start, p.key, min({_D2}) AS d2 FROM pts p JOIN settled c USING (product_name) GROUP BY ALL)
    GROUP BY ALL) GROUP BY product_name),
centres AS MATERIALIZED (SELECT c.* FROM settled c JOIN best USING (product_name, start)),
assigned AS (
  SELECT p.customer_id, p.product_name, arg_min(c.cluster, {{'d2': {_D2}, 'c': c.cluster}}) AS cluster
  FROM pts p JOIN centres c USING (product_name) GROUP BY p.customer_id, p.product_name)""")
    return _with(*ctes)


_KMEANS_SQL = _kmeans_sql()


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scored pairs, staged once: the segment queries read them in several
    branches (statistics, assignment, medians)."""
    from custlens.plans.segments import rfm_with_funnel
    from custlens.session import staged

    scored = rfm_with_funnel(
        fx.sales(spark, sf, geo=False), _as_of(), fx.unit_days(spark, sf), fx.pack_days(spark, sf), packs=fx.PACKS
    )
    return staged(scored, "scored")


def _grid(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scaled rows and the k = 5 deterministic seeds per product."""
    from custlens.operators.segment import grid_centroids, group_statistics, scale_features

    stats = group_statistics(scored)
    return scale_features(scored, stats=stats), grid_centroids(stats, 5)


@query(
    "rfm_scaled",
    _seg_chain_sql(
        "SELECT customer_id, product_name, round(z_recency, 6) AS z_recency, round(z_frequency, 6) AS z_frequency, "
        "round(z_monetary, 6) AS z_monetary FROM scaled"
    ),
)
def q_rfm_scaled(spark: SparkSession, sf: str) -> DataFrame:
    """M1: per-product z-scores of recency, frequency, monetary."""
    z, _ = _grid(_scored(spark, sf))
    return z.select("customer_id", "product_name", *[F.round(c, 6).alias(c) for c in ("z_recency", "z_frequency", "z_monetary")])


@query("nearest_centroid", _seg_chain_sql("SELECT customer_id, product_name, cluster FROM assigned"))
def q_nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest of k = 5 deterministic seeds per product."""
    from custlens.operators.segment import assign_nearest

    return assign_nearest(*_grid(_scored(spark, sf))).select("customer_id", "product_name", "cluster")


@query(
    "cluster_names",
    _seg_chain_sql(
        "SELECT product_name, cluster, CAST(median_frequency AS DOUBLE) AS median_frequency, cluster_name FROM medians"
    ),
)
def q_cluster_names(spark: SparkSession, sf: str) -> DataFrame:
    """Median frequency per (product, cluster) and its name."""
    from custlens.operators.segment import assign_nearest, cluster_medians

    return cluster_medians(assign_nearest(*_grid(_scored(spark, sf))))


_C8_SQL = """,
provinces AS (SELECT DISTINCT customer_id, province_id FROM kept),
products AS (SELECT DISTINCT product_name, product_id FROM kept)
SELECT n.customer_id,
       CASE WHEN n.segment_name = 'Potential Loyal' AND n.funnel = 'Cold' THEN 'Hibernate' ELSE n.segment_name END AS cluster,
       n.funnel, n.product_name, p.product_id, n.last_shipment_date, n.product_qty,
       CASE WHEN n.frequency IN (1, 2, 3, 4, 5) THEN CAST(n.frequency - 1 AS INTEGER) ELSE 5 END AS repeat_order,
       v.province_id
FROM named n LEFT JOIN provinces v ON n.customer_id = v.customer_id
LEFT JOIN products p ON n.product_name = p.product_name"""


@query("customer_segments", _seg_chain_sql(_C8_SQL))
def q_customer_segments(spark: SparkSession, sf: str) -> DataFrame:
    """C8 with deterministic seeds (M2b): the 9-column segment table
    (C3, C6, C7, J3, J4, U1, A9, P3, P4)."""
    from custlens.plans.segments import customer_segments

    return customer_segments(
        fx.sales(spark, sf), _as_of(), fx.unit_days(spark, sf), fx.pack_days(spark, sf), method="grid", packs=fx.PACKS
    )


@query(
    "kmeans_segments",
    _seg_chain_sql("SELECT customer_id, product_name, cluster_id, segment_name AS cluster, funnel FROM named", _KMEANS_SQL),
)
def q_kmeans_segments(spark: SparkSession, sf: str) -> DataFrame:
    """K-Means (k = 5) per product by k-means|| starts, named by median frequency."""
    from custlens.operators.segment import segment

    seg = segment(_scored(spark, sf), k=5)
    return seg.select("customer_id", "product_name", "cluster_id", "cluster", "funnel")


@query(
    "kmeans_check",
    _seg_chain_sql(
        f"""
SELECT p.product_name, count(*) AS rows_in, count(*) AS rows_assigned, 0::BIGINT AS misplaced,
       true AS not_worse_than_grid FROM pts p GROUP BY p.product_name""",
        _KMEANS_SQL,
    ),
)
def q_kmeans_check(spark: SparkSession, sf: str) -> DataFrame:
    """M2 checked by what K-Means promises, per product: every row is assigned, none of
    all the product's centres is nearer than its own, and the squared distances add up to no more
    than around the grid seeds."""
    from custlens.operators.kmeans import fixed_point
    from custlens.operators.segment import FEATURES, assign_nearest, grid_centroids, group_statistics, kmeans_fit, scale_features
    from custlens.session import staged

    scored = _scored(spark, sf)
    stats = group_statistics(scored)
    fixed, centres = kmeans_fit(scale_features(scored, stats=stats), stats, 5)
    zs = [f"z_{f}" for f in FEATURES]
    assigned = staged(assign_nearest(fixed, centres), "kmeans-assigned")
    # Each row against each of its product's centres, not only the chosen one. The centres of
    # a product come as one array, so that the rows stay where they are.
    all_centres = staged(centres.groupBy("product_name").agg(F.collect_list(F.struct("cluster", *zs)).alias("_all")), "kmeans-all-centres")

    def least(of):
        return F.array_min(F.transform(of, lambda c: sum(((F.col(z) - c[z]) * (F.col(z) - c[z]) for z in zs), F.lit(0.0))))

    chosen = F.filter("_all", lambda c: c["cluster"] == F.col("cluster"))
    each = assigned.join(all_centres, "product_name").select("product_name", least("_all").alias("least"), least(chosen).alias("own"))
    checked = each.groupBy("product_name").agg(
        F.count("own").alias("rows_assigned"), F.count_if(F.col("own") > F.col("least")).alias("misplaced"), F.sum("own").alias("within")
    )
    around_seeds = assign_nearest(fixed, fixed_point(grid_centroids(stats, 5), zs))
    grid = around_seeds.groupBy("product_name").agg(F.count(F.lit(1)).alias("rows_in"), F.sum("distance").alias("around_grid"))
    not_worse = (F.col("within") <= F.col("around_grid")).alias("not_worse_than_grid")
    return checked.join(grid, "product_name").select("product_name", "rows_in", "rows_assigned", "misplaced", not_worse)


@query("customer_segments_kmeans", _seg_chain_sql(_C8_SQL, _KMEANS_SQL))
def q_customer_segments_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    """C8 with K-Means segments, the default method."""
    from custlens.plans.segments import customer_segments

    return customer_segments(fx.sales(spark, sf), _as_of(), fx.unit_days(spark, sf), fx.pack_days(spark, sf), packs=fx.PACKS)


_CANON_RULES = [("brand#1", "Brand#1x"), ("brand#2", "Brand#2x")]


@query(
    "rfm_canonical",
    _seg_sql(
        ",\n"
        + _with(
            _KEPT_SQL,
            _PREP_SQL.replace(
                "product_name AS given_product_name",
                "CASE WHEN starts_with(product_name, 'Brand#1') THEN 'Brand#1x' "
                "WHEN starts_with(product_name, 'Brand#2') THEN 'Brand#2x' ELSE product_name END AS given_product_name",
            ),
            _RFM_SQL,
        )
        + "\nSELECT customer_id, product_name, last_shipment_date, frequency, round(monetary, 2) AS monetary, product_qty FROM rfm"
    ),
)
def q_rfm_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """C2 with F13: C1 by the raw product names, RFM by the canonical ones."""
    out = rfm_excluding_returns(fx.sales(spark, sf, geo=False), _as_of(), _CANON_RULES)
    return out.select(
        "customer_id", "product_name", "last_shipment_date", "frequency", F.round("monetary", 2).alias("monetary"), "product_qty"
    )
