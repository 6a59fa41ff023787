"""The driver's tables seen as raw retail tables, in Spark and in SQL.

Keys, amounts and times are the tables' own columns. The defects a cleaning job
is for (repeated keys, nulls, bad references, bad quantities, broken e-mails) are
not in them, so they are put in by integer arithmetic on the keys, the same in
both engines. Every view is a projection of one table, so filters and column
choices still reach its scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the retail model that appear below: the store regions north, south,
# east, west, central, and the discount codes SUMMER10, WELCOME5, FLASH20, VIP15.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_copies(df: DataFrame, repeated: str) -> DataFrame:
    """Each row once as copy 0, and the ``repeated`` ones again as copy 1."""
    return df.withColumn("copy", F.explode(F.expr(f"CASE WHEN {repeated} THEN array(0, 1) ELSE array(0) END")))


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; some come twice, some lack customer, time or status. From 1998-06-01
    on they carry discount codes."""
    copies = _with_copies(table(spark, sf_dir, "orders"), "o_orderkey % 50 = 7")
    return copies.selectExpr(
        "cast(o_orderkey AS string) AS order_id",
        "CASE WHEN o_orderkey % 157 <> 0 THEN o_custkey END AS customer_id",
        "CASE WHEN o_orderkey % 211 <> 0 THEN cast(date_add(o_orderdate, -copy) AS timestamp) END AS order_ts",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'north' WHEN '2' THEN 'south' WHEN '3' THEN 'east'"
        " WHEN '4' THEN 'west' ELSE 'central' END AS store_region",
        "CASE WHEN o_orderkey % 97 <> 0 THEN o_orderstatus END AS status",
        "CASE WHEN o_orderdate >= timestamp_ntz'1998-06-01 00:00:00' THEN CASE o_orderkey % 7 WHEN 0 THEN 'SUMMER10'"
        " WHEN 1 THEN 'WELCOME5' WHEN 2 THEN 'FLASH20' WHEN 3 THEN 'VIP15' END END AS discount_code",
    )


def items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; some with an unknown or no product, a quantity of 0 or less, or
    no total. (order_id, product_id) repeats."""
    marked = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "CASE (l_orderkey * 31 + l_linenumber) % 100 WHEN 0 THEN 0 WHEN 1 THEN -1 - l_linenumber % 3"
        " ELSE cast(l_quantity AS int) END AS quantity",
        "cast(l_extendedprice AS decimal(10,2)) AS unit_price",
    )
    return marked.selectExpr(
        "cast(l_orderkey AS string) AS order_id",
        "CASE WHEN (l_orderkey + l_linenumber * 7) % 200 = 0 THEN 900000000000 + l_partkey % 20"
        " WHEN (l_orderkey + l_linenumber) % 500 <> 3 THEN l_partkey END AS product_id",
        "quantity",
        "unit_price",
        "CASE WHEN (l_orderkey * 13 + l_linenumber) % 300 <> 0"
        " THEN cast(quantity * unit_price AS decimal(12,2)) END AS line_total",
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products; some come twice under another name, some lack id, price or flag."""
    copies = _with_copies(table(spark, sf_dir, "part"), "p_partkey % 100 = 9 OR p_partkey % 500 = 1")
    return copies.selectExpr(
        "CASE WHEN copy = 0 OR p_partkey % 500 <> 1 THEN p_partkey END AS product_id",
        "CASE WHEN copy = 0 THEN p_name ELSE 'aaa ' || p_name END AS product_name",
        "p_type AS category",
        "CASE WHEN p_partkey % 40 <> 3 THEN cast(p_retailprice AS decimal(10,2)) END AS unit_price",
        "CASE WHEN p_partkey % 60 <> 5 THEN p_size % 20 <> 0 END AS active_flag",
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; some come twice with other values, and e-mails are missing, empty,
    padded, or lack the @ or the domain. 25 nations serve as cities."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    copies = _with_copies(table(spark, sf_dir, "customer"), "c_custkey % 100 = 50")
    named = copies.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "*", "lower(replace(c_name, '#', '.')) AS lp"
    )
    return named.selectExpr(
        "c_custkey AS customer_id",
        "substr(c_name, 1, 8) AS first_name",
        "substr(c_name, 10) AS last_name",
        "CASE WHEN copy = 1 THEN 'Second.' || lp || '@example.com' ELSE CASE c_custkey % 100 WHEN 0 THEN NULL"
        " WHEN 1 THEN lp || '_example.com' WHEN 2 THEN lp || '@' WHEN 3 THEN '  ' || lp || '@example.com '"
        " WHEN 4 THEN '' ELSE lp || '@example.com' END END AS email",
        "date_add(date'2020-01-01', cast(c_custkey % 700 AS int) + copy * 10) AS signup_date",
        "city",
        "CASE WHEN copy = 0 THEN c_mktsegment ELSE 'second' END AS segment",
    )


def clicks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events of January 2024; every fourth without a customer."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 4 <> 0 THEN user_id END AS customer_id",
        "event_type",
        "cast(ts AS timestamp) AS event_ts",
        "cast(value AS decimal(10,2)) AS value",
        "cast(ts AS date) AS event_date",
    )


# name: (the table expressions it selects from, its SELECT)
SQL_TABLES: dict[str, tuple[list[str], str]] = {
    "orders_raw": (
        [],
        """
SELECT cast(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderkey % 157 <> 0 THEN o_custkey END AS customer_id,
  CASE WHEN o_orderkey % 211 <> 0 THEN o_orderdate - to_days(copy) END AS order_ts,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'north' WHEN '2' THEN 'south' WHEN '3' THEN 'east'
    WHEN '4' THEN 'west' ELSE 'central' END AS store_region,
  CASE WHEN o_orderkey % 97 <> 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN CASE o_orderkey % 7 WHEN 0 THEN 'SUMMER10'
    WHEN 1 THEN 'WELCOME5' WHEN 2 THEN 'FLASH20' WHEN 3 THEN 'VIP15' END END AS discount_code
FROM orders, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR o_orderkey % 50 = 7""",
    ),
    "items_raw": (
        [],
        """
SELECT cast(l_orderkey AS VARCHAR) AS order_id,
  CASE WHEN (l_orderkey + l_linenumber * 7) % 200 = 0 THEN 900000000000 + l_partkey % 20
    WHEN (l_orderkey + l_linenumber) % 500 <> 3 THEN l_partkey END AS product_id,
  quantity, unit_price,
  CASE WHEN (l_orderkey * 13 + l_linenumber) % 300 <> 0
    THEN cast(quantity * unit_price AS DECIMAL(12,2)) END AS line_total
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
    CASE (l_orderkey * 31 + l_linenumber) % 100 WHEN 0 THEN 0 WHEN 1 THEN -1 - l_linenumber % 3
      ELSE cast(l_quantity AS INTEGER) END AS quantity,
    cast(l_extendedprice AS DECIMAL(10,2)) AS unit_price
  FROM lineitem)""",
    ),
    "products_raw": (
        [],
        """
SELECT CASE WHEN copy = 0 OR p_partkey % 500 <> 1 THEN p_partkey END AS product_id,
  CASE WHEN copy = 0 THEN p_name ELSE 'aaa ' || p_name END AS product_name,
  p_type AS category,
  CASE WHEN p_partkey % 40 <> 3 THEN cast(p_retailprice AS DECIMAL(10,2)) END AS unit_price,
  CASE WHEN p_partkey % 60 <> 5 THEN p_size % 20 <> 0 END AS active_flag
FROM part, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR p_partkey % 100 = 9 OR p_partkey % 500 = 1""",
    ),
    "customers_raw": (
        [],
        """
SELECT c_custkey AS customer_id, substr(c_name, 1, 8) AS first_name, substr(c_name, 10) AS last_name,
  CASE WHEN copy = 1 THEN 'Second.' || lp || '@example.com' ELSE CASE c_custkey % 100 WHEN 0 THEN NULL
    WHEN 1 THEN lp || '_example.com' WHEN 2 THEN lp || '@' WHEN 3 THEN '  ' || lp || '@example.com '
    WHEN 4 THEN '' ELSE lp || '@example.com' END END AS email,
  DATE '2020-01-01' + cast(c_custkey % 700 + copy * 10 AS INTEGER) AS signup_date,
  n_name AS city,
  CASE WHEN copy = 0 THEN c_mktsegment ELSE 'second' END AS segment
FROM (SELECT *, lower(replace(c_name, '#', '.')) AS lp FROM customer) JOIN nation ON c_nationkey = n_nationkey,
  (VALUES (0), (1)) c(copy) WHERE copy = 0 OR c_custkey % 100 = 50""",
    ),
    "clicks_raw": (
        [],
        """
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN user_id END AS customer_id, event_type, ts AS event_ts,
  cast(value AS DECIMAL(10,2)) AS value, cast(ts AS DATE) AS event_date
FROM events""",
    ),
    "customers_clean": (
        ["customers_raw"],
        """
SELECT customer_id, first_name, last_name, lower(trim(email)) AS email, signup_date, city, segment
FROM customers_raw WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY signup_date DESC NULLS LAST, first_name NULLS FIRST,
  last_name NULLS FIRST, customers_raw.email NULLS FIRST, city NULLS FIRST, segment NULLS FIRST) = 1""",
    ),
    "products_clean": (
        ["products_raw"],
        """
SELECT product_id, product_name, category, coalesce(unit_price, 0) AS unit_price,
  coalesce(active_flag, true) AS active_flag
FROM products_raw WHERE product_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS FIRST, category NULLS FIRST,
  products_raw.unit_price NULLS FIRST, products_raw.active_flag NULLS FIRST) = 1""",
    ),
    "orders_clean": (
        ["orders_raw"],
        """
SELECT order_id, customer_id, order_ts, store_region, coalesce(status, 'UNKNOWN') AS status, discount_code
FROM orders_raw WHERE order_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, order_ts NULLS FIRST,
  store_region NULLS FIRST, orders_raw.status NULLS FIRST, discount_code NULLS FIRST) = 1""",
    ),
    # Items as the gold path has them: negative quantities clamped, totals recomputed.
    "items_clean": (
        ["items_raw"],
        """
SELECT order_id, product_id, quantity, unit_price, cast(quantity * unit_price AS DECIMAL(12,2)) AS line_total
FROM (SELECT order_id, product_id, CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS quantity, unit_price
  FROM items_raw WHERE order_id IS NOT NULL AND product_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY items_raw.quantity NULLS FIRST,
    unit_price NULLS FIRST, line_total NULLS FIRST) = 1)""",
    ),
    # Items as the gated path has them: totals as delivered, 0 where absent.
    "items_curated": (
        ["items_raw"],
        """
SELECT order_id, product_id, quantity, unit_price, line_total
FROM (SELECT order_id, product_id, quantity, unit_price, coalesce(line_total, 0) AS line_total FROM items_raw
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY quantity NULLS FIRST,
  unit_price NULLS FIRST, line_total NULLS FIRST) = 1""",
    ),
    "orders_curated": (
        ["orders_raw", "items_curated"],
        """
SELECT o.*, coalesce(t.order_total, 0) AS order_total
FROM (SELECT *, cast(order_ts AS DATE) AS order_date FROM orders_raw WHERE order_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY cast(order_ts AS DATE) DESC NULLS LAST,
    customer_id NULLS FIRST, order_ts NULLS FIRST, store_region NULLS FIRST, status NULLS FIRST,
    discount_code NULLS FIRST) = 1) o
LEFT JOIN (SELECT order_id, sum(line_total) AS order_total FROM items_curated GROUP BY order_id) t
  ON o.order_id = t.order_id""",
    ),
    "orders_passed": (
        ["orders_curated"],
        """
SELECT * FROM orders_curated WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND status IS NOT NULL
  AND order_date IS NOT NULL AND order_total >= 0""",
    ),
    "gold_lines": (
        ["orders_clean", "items_clean", "products_clean"],
        """
SELECT i.order_id, i.product_id, i.quantity, i.line_total, p.category, cast(o.order_ts AS DATE) AS order_date,
  o.store_region
FROM items_clean i JOIN products_clean p ON i.product_id = p.product_id JOIN orders_clean o ON i.order_id = o.order_id""",
    ),
    "gold": (
        ["gold_lines"],
        """
SELECT order_date, category, store_region, sum(line_total) AS daily_revenue,
  cast(sum(quantity) AS BIGINT) AS total_items_sold, count(DISTINCT order_id) AS total_order_count
FROM gold_lines GROUP BY order_date, category, store_region""",
    ),
    "fact": (
        ["items_curated", "orders_passed"],
        """
SELECT i.order_id, o.customer_id, i.product_id, cast(strftime(o.order_ts, '%Y%m%d') AS INTEGER) AS date_key,
  i.quantity, i.unit_price, i.line_total, o.order_ts, o.store_region
FROM items_curated i JOIN orders_passed o ON i.order_id = o.order_id""",
    ),
}
