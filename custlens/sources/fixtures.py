"""Driver tables → the reference's input shapes.

The reference reads redacted database queries and CSV folders; the driver gives
TPC-H-like parquet instead. Each builder below states the mapping once, as a
Spark plan, and ``FIXTURE_SQL`` states the very same mapping for the DuckDB
oracle. Every builder of rows reads whole tables; the modulo rules there only
*corrupt* chosen values, to exercise the invalid paths. Two lookups leave keys
out on purpose, to exercise the defaults: ``eta`` lacks five regions and
``unit_days`` one product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.dates import format_ymd
from custlens.sources.tables import read_table

# As-of instants used by the registered queries (the reference
# used "now", which makes every run different).
SEGMENT_AS_OF = "2001-08-01 00:00:00"
CHURN_AS_OF = "2001-06-01 00:00:00"
# The configuration tables' rules.
PACK_DAYS = (("small", 6), ("large", 10))
PACKS = sorted(p for p, _ in PACK_DAYS)
TARGET_BONUS = 10
KPI_PRODUCTS = 5


def _product_id(brand: F.Column) -> F.Column:
    return F.regexp_extract(brand, r"(\d+)$", 1).cast("int")


def _ymd(ts: F.Column) -> F.Column:
    return format_ymd(ts)


def _orders_lines_parts(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(
        spark,
        base,
        "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    orders = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    part = read_table(spark, base, "part", ["p_partkey", "p_brand", "p_size"])
    # lineitem ⋈ orders is the one large-large join: both sides shuffle on the
    # order key (or co-locate if the lake is bucketed by it). part is joined
    # after; AQE turns it into a broadcast when the pruned side is small.
    return li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)


def _with_geo(spark: SparkSession, base: str, df: DataFrame) -> DataFrame:
    # Lines to customers, then to nations: each side's size is that of its scan,
    # where a joined lookup would be estimated at the product of both.
    customer = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, base, "nation", ["n_nationkey", "n_name"])
    placed = df.join(customer, df.o_custkey == customer.c_custkey, "left")
    return placed.join(nation, placed.c_nationkey == nation.n_nationkey, "left")


def sales(spark: SparkSession, base: str, geo: bool = True) -> DataFrame:
    """Sales lines of the segmentation ETL (FIXTURES §2). ``geo=False`` leaves
    out the customer/nation lookup (province_id and region are NULL) for
    queries that never read them: Catalyst cannot drop an unused outer join
    by itself because it does not know the customer key is unique."""
    df = _orders_lines_parts(spark, base)
    if geo:
        df = _with_geo(spark, base, df)
    else:
        df = df.withColumn("c_nationkey", F.lit(None).cast("int")).withColumn("n_name", F.lit(None).cast("string"))
    return df.select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_shipdate")).alias("last_shipment_date"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("l_extendedprice").alias("product_sales_total"),
        F.col("p_brand").alias("product_name"),
        _product_id(F.col("p_brand")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("product_qty"),
        F.col("c_nationkey").alias("province_id"),
        F.col("n_name").alias("region"),
        F.when(F.col("l_returnflag") == "R", F.lit(3)).otherwise(F.lit(1)).alias("sale_status"),
        F.col("l_orderkey").cast("string").alias("tracking_number"),
        F.when(F.col("p_size") <= 25, F.lit("small")).otherwise(F.lit("large")).alias("pack"),
    )


def cohort_sales(spark: SparkSession, base: str) -> DataFrame:
    """Sales lines of the cohort notebook: invoice date kept as text with the
    ``0000-00-00`` sentinel."""
    df = _orders_lines_parts(spark, base)
    raw = F.when(F.col("o_orderkey") % 97 == 0, F.lit("0000-00-00")).otherwise(_ymd(F.col("o_orderdate")))
    return df.select(
        F.col("o_custkey").alias("id"),
        raw.alias("invoice_date"),
        F.col("p_brand").alias("product_name"),
        F.col("l_extendedprice").alias("product_sales_total"),
        F.col("l_orderkey").cast("string").alias("tracking_number"),
    )


def churn_customers(spark: SparkSession, base: str) -> DataFrame:
    """Customer dataset of the churn notebook, with named columns. The invoice
    date text carries three corruption rules: sentinel, NULL, impossible date."""
    df = _with_geo(spark, base, _orders_lines_parts(spark, base))
    k = F.col("o_orderkey")
    raw = (
        F.when(k % 97 == 0, F.lit("0000-00-00"))
        .when(k % 101 == 0, F.lit(None).cast("string"))
        .when(k % 103 == 0, F.lit("2001-13-45"))
        .otherwise(_ymd(F.col("o_orderdate")))
    )
    return df.select(
        F.col("p_brand").alias("product"),
        F.col("l_quantity").cast("int").alias("quantity"),
        raw.alias("invoice_date"),
        F.col("l_orderkey").cast("string").alias("tracking_code"),
        F.col("n_name").alias("region"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("boxes"),
        F.col("l_extendedprice").alias("monetary"),
    )


def returns(spark: SparkSession, base: str) -> DataFrame:
    """Return list: one tracking code per order with a returned, finished line;
    some codes are mistyped and match no sale."""
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_returnflag", "l_linestatus"])
    key = F.col("l_orderkey")
    code = F.when(key % 211 == 0, F.concat(F.lit("R"), key.cast("string"))).otherwise(key.cast("string"))
    return li.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).select(code.alias("AWB")).distinct()


def eta(spark: SparkSession, base: str) -> DataFrame:
    """Regional delivery-time lookup (Region, ETA, file-order priority)."""
    nation = read_table(spark, base, "nation", ["n_nationkey", "n_name"])
    return nation.filter(F.col("n_nationkey") < 20).select(
        F.col("n_name").alias("region"),
        (F.lit(2) + F.col("n_nationkey") % 5).alias("eta_days"),
        F.col("n_nationkey").alias("priority"),
    )


def _brands(spark: SparkSession, base: str) -> DataFrame:
    part = read_table(spark, base, "part", ["p_brand"])
    return part.select(F.col("p_brand").alias("product_name")).distinct()


def unit_days(spark: SparkSession, base: str) -> DataFrame:
    """Days one unit lasts, per product; product 25 deliberately has none."""
    b = _brands(spark, base)
    pid = _product_id(F.col("product_name"))
    return b.filter(pid != 25).select("product_name", (F.lit(5) + pid % 6).alias("days_per_unit"))


def pack_days(spark: SparkSession, base: str) -> DataFrame:
    """Days per unit for each pack size of each product."""
    b = _brands(spark, base)
    packs = F.array(*[F.struct(F.lit(p).alias("pack"), F.lit(d).alias("days_per_unit")) for p, d in PACK_DAYS])
    return b.select("product_name", F.inline(packs))


def prices(spark: SparkSession, base: str) -> DataFrame:
    b = _brands(spark, base)
    return b.select("product_name", (_product_id(F.col("product_name")) * 100).cast("double").alias("price"))


def staff_activity(spark: SparkSession, base: str) -> DataFrame:
    """Staff activity log: events with staff = user, product from props.k. A few
    rows lack the time, the staff, the type or the product (rules G2)."""
    ev = read_table(spark, base, "events")
    k = F.col("event_id")
    product = F.get_json_object("props", "$.k").cast("int") % KPI_PRODUCTS
    return ev.select(
        "event_id",
        F.when(k % 97 != 0, F.col("ts")).alias("ts"),
        F.when(k % 89 != 0, F.col("user_id")).alias("staff_id"),
        F.when(k % 83 != 0, F.col("event_type")).alias("event_type"),
        F.when(k % 79 != 0, product).alias("product"),
        "value",
        "props",
    )


def staff_directory(spark: SparkSession, base: str) -> DataFrame:
    """Employee table: the customer master doubles as the staff directory."""
    cu = read_table(spark, base, "customer", ["c_custkey", "c_name"])
    return cu.select(F.col("c_custkey").alias("staff_id"), F.col("c_name").alias("staff_name"))


def customers_named(spark: SparkSession, base: str) -> DataFrame:
    """Customers, some of whom share a name."""
    k = F.col("c_custkey")
    shared = F.concat(F.lit(" customer  SHARED "), (k % 7).cast("string"))
    return read_table(spark, base, "customer", ["c_custkey", "c_name"]).select(
        "c_custkey", F.when(k % 40 == 0, shared).otherwise(F.col("c_name")).alias("c_name")
    )


def order_labels(spark: SparkSession, base: str) -> DataFrame:
    """Orders with their shipping label, some malformed or used twice."""
    k = F.col("o_orderkey")
    label = (
        F.when(k % 97 == 0, F.concat(F.lit("X-"), k.cast("string")))
        .when(k % 89 == 0, F.floor(k / 1000).cast("bigint").cast("string"))
        .otherwise(k.cast("string"))
    )
    return read_table(spark, base, "orders", ["o_orderkey"]).select("o_orderkey", label.alias("label"))


def chat_turns(spark: SparkSession, base: str) -> DataFrame:
    """Conversations, some of whose replies are empty (C17)."""
    empty = (F.col("conv_id") % 3 == 0) & (F.col("role") == "assistant")
    return read_table(spark, base, "conversations", ["conv_id", "turn", "role", "text"]).withColumn(
        "text", F.when(empty, F.lit("")).otherwise(F.col("text"))
    )


def targets(spark: SparkSession) -> DataFrame:
    """Per-product daily purchase targets, point weights and bonus (config)."""
    rows = [(p, 1 + p % 2, p + 1, TARGET_BONUS) for p in range(KPI_PRODUCTS)]
    return spark.createDataFrame(rows, "product int, target int, weight int, bonus int")


def instructions(spark: SparkSession, base: str) -> DataFrame:
    """Instruction rows from documents: language → instruction, whole text →
    input, source → output."""
    docs = read_table(spark, base, "documents", ["doc_id", "text", "lang", "source"])
    return docs.select(
        "doc_id",
        F.col("lang").alias("instruction"),
        F.col("text").alias("input"),
        F.col("source").alias("output"),
    )


# ---------------------------------------------------------------------------
# The same mapping for the DuckDB oracle.
# ---------------------------------------------------------------------------

_OLP = """
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey"""
_GEO = """
    LEFT JOIN (SELECT c_custkey, c_nationkey, n_name FROM customer
               LEFT JOIN nation ON c_nationkey = n_nationkey) g ON o_custkey = g.c_custkey"""

FIXTURE_SQL: dict[str, str] = {
    "sales": f"""
    SELECT o_custkey AS customer_id,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS last_shipment_date,
           o_orderdate AS invoice_date,
           l_extendedprice AS product_sales_total,
           p_brand AS product_name,
           CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS product_id,
           CAST(trunc(l_quantity) AS INTEGER) AS product_qty,
           c_nationkey AS province_id,
           n_name AS region,
           CASE WHEN l_returnflag = 'R' THEN 3 ELSE 1 END AS sale_status,
           CAST(l_orderkey AS VARCHAR) AS tracking_number,
           CASE WHEN p_size <= 25 THEN 'small' ELSE 'large' END AS pack
    {_OLP} {_GEO}""",
    "cohort_sales": f"""
    SELECT o_custkey AS id,
           CASE WHEN o_orderkey % 97 = 0 THEN '0000-00-00' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS invoice_date,
           p_brand AS product_name,
           l_extendedprice AS product_sales_total,
           CAST(l_orderkey AS VARCHAR) AS tracking_number
    {_OLP}""",
    "churn_customers": f"""
    SELECT p_brand AS product,
           CAST(trunc(l_quantity) AS INTEGER) AS quantity,
           CASE WHEN o_orderkey % 97 = 0 THEN '0000-00-00'
                WHEN o_orderkey % 101 = 0 THEN NULL
                WHEN o_orderkey % 103 = 0 THEN '2001-13-45'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS invoice_date,
           CAST(l_orderkey AS VARCHAR) AS tracking_code,
           n_name AS region,
           CAST(ceil(l_quantity / 10) AS INTEGER) AS boxes,
           l_extendedprice AS monetary
    {_OLP} {_GEO}""",
    "returns": """
    SELECT DISTINCT CASE WHEN l_orderkey % 211 = 0 THEN 'R' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS AWB
    FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "eta": """
    SELECT n_name AS region, 2 + n_nationkey % 5 AS eta_days, n_nationkey AS priority
    FROM nation WHERE n_nationkey < 20""",
    "unit_days": """
    SELECT product_name, 5 + pid % 6 AS days_per_unit FROM (
      SELECT DISTINCT p_brand AS product_name,
             CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS pid FROM part)
    WHERE pid <> 25""",
    "pack_days": """
    SELECT DISTINCT p_brand AS product_name, 'small' AS pack, 6 AS days_per_unit FROM part
    UNION ALL
    SELECT DISTINCT p_brand AS product_name, 'large' AS pack, 10 AS days_per_unit FROM part""",
    "prices": """
    SELECT DISTINCT p_brand AS product_name,
           CAST(CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) * 100 AS DOUBLE) AS price
    FROM part""",
    "staff_activity": """
    SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts,
           CASE WHEN event_id % 89 <> 0 THEN user_id END AS staff_id,
           CASE WHEN event_id % 83 <> 0 THEN event_type END AS event_type,
           CASE WHEN event_id % 79 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 END AS product,
           value, props
    FROM events""",
    "customers_named": """
    SELECT c_custkey, CASE WHEN c_custkey % 40 = 0 THEN ' customer  SHARED ' || CAST(c_custkey % 7 AS VARCHAR)
                           ELSE c_name END AS c_name FROM customer""",
    "order_labels": """
    SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X-' || CAST(o_orderkey AS VARCHAR)
                            WHEN o_orderkey % 89 = 0 THEN CAST(o_orderkey // 1000 AS VARCHAR)
                            ELSE CAST(o_orderkey AS VARCHAR) END AS label FROM orders""",
    "chat_turns": """
    SELECT conv_id, turn, role, CASE WHEN conv_id % 3 = 0 AND role = 'assistant' THEN '' ELSE text END AS text
    FROM conversations""",
    "staff_directory": "SELECT c_custkey AS staff_id, c_name AS staff_name FROM customer",
    "targets": """
    SELECT CAST(p AS INTEGER) AS product, CAST(1 + p % 2 AS INTEGER) AS target,
           CAST(p + 1 AS INTEGER) AS weight, 10 AS bonus
    FROM range(5) t(p)""",
    "instructions": """
    SELECT doc_id, lang AS instruction, text AS input, source AS output FROM documents""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the fixture CTEs it uses."""
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{sql}"
