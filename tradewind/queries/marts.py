"""Joins, star schema, marts and dashboard tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts, quality
from ..session import workspace
from ..sinks import aggregate_dealt, deal_table, join_dealt
from .cleaning import items_curated, order_outcomes, orders_curated, star_fact
from .registry import query
from .tables import customers_raw, items_raw, orders_raw, products_raw, table

GOLD = "daily_regional_revenue"


def silver(spark, d):
    return (
        marts.clean_orders(orders_raw(spark, d)),
        marts.clean_items(items_raw(spark, d)),
        marts.clean_products(products_raw(spark, d)),
    )


def gold(spark, d):
    return marts.daily_regional_revenue(*silver(spark, d))


def calendar(spark, d):
    lo, hi = table(spark, d, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return marts.dim_date(spark, str(lo.date()), str(hi.date()))


# --- joins ------------------------------------------------------------------


@query(
    "j1_order_totals_left_join",
    "SELECT order_id, store_region, cast(order_total AS DOUBLE) AS order_total FROM orders_curated",
    "orders_curated",
)
def j1(spark, d):
    return orders_curated(spark, d).select("order_id", "store_region", "order_total")


@query(
    "j2_gold_source",
    """
SELECT order_id, product_id, cast(quantity AS BIGINT) AS quantity, cast(line_total AS DOUBLE) AS line_total, category,
  strftime(order_date, '%Y-%m-%d') AS order_date, store_region FROM gold_lines""",
    "gold_lines",
)
def j2(spark, d):
    return marts.gold_source(*silver(spark, d))


@query(
    "j3_build_fact",
    """
SELECT order_id, customer_id, product_id, date_key::BIGINT AS date_key, quantity::BIGINT AS quantity,
  unit_price::DOUBLE AS unit_price, line_total::DOUBLE AS line_total,
  strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS order_ts, store_region FROM fact""",
    "fact",
)
def j3(spark, d):
    return star_fact(spark, d)


@query(
    "j3_fact_of_passed_items",
    """
SELECT count(*) AS lines, sum(f.line_total)::DOUBLE AS revenue FROM fact f
WHERE f.product_id IN (SELECT product_id FROM products_clean) AND f.quantity IS NOT NULL""",
    "fact products_clean",
)
def j3_strict(spark, d):
    from ..plans.curation import item_rules

    products = marts.clean_products(products_raw(spark, d))
    items = quality.evaluate_rows(items_curated(spark, d), item_rules(products))
    fact = marts.build_fact(items, order_outcomes(spark, d), require_item_pass=True)
    return fact.agg(F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue"))


@query(
    "j4_star_join",
    """
SELECT c.segment, p.category, year(f.order_ts)::BIGINT AS calendar_year, count(*) AS lines,
  sum(f.line_total)::DOUBLE AS revenue
FROM fact f JOIN products_clean p ON f.product_id = p.product_id JOIN customers_clean c ON f.customer_id = c.customer_id
GROUP BY 1, 2, 3""",
    "fact products_clean customers_clean",
)
def j4(spark, d):
    joined = marts.star(
        star_fact(spark, d).select("date_key", "product_id", "customer_id", "line_total"),
        (calendar(spark, d), "date_key"),
        (marts.clean_products(products_raw(spark, d)).select("product_id", "category"), "product_id"),
        (marts.clean_customers(customers_raw(spark, d)).select("customer_id", "segment"), "customer_id"),
    )
    return joined.groupBy("segment", "category", "calendar_year").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue")
    )


@query(
    "j5_referential_fail",
    """
SELECT order_id, product_id, quantity::BIGINT AS quantity FROM items_curated
WHERE product_id NOT IN (SELECT product_id FROM products_clean)""",
    "items_curated products_clean",
)
def j5(spark, d):
    products = products_raw(spark, d).dropna(subset=["product_id"])
    bad = quality.referential_fail(items_curated(spark, d), products, "product_id")
    return bad.select("order_id", "product_id", "quantity")


@query(
    "j6_items_with_category",
    """
SELECT i.order_id, i.product_id, p.category, i.line_total::DOUBLE AS line_total
FROM items_raw i LEFT JOIN products_clean p ON i.product_id = p.product_id""",
    "items_raw products_clean",
)
def j6(spark, d):
    joined = marts.items_with_category(items_raw(spark, d), marts.clean_products(products_raw(spark, d)))
    return joined.select("order_id", "product_id", "category", "line_total")


@query(
    "j7_bucketed_join",
    """
SELECT c.segment, count(*) AS lines, sum(f.line_total)::DOUBLE AS revenue
FROM fact f JOIN customers_clean c ON f.customer_id = c.customer_id GROUP BY c.segment""",
    "fact customers_clean",
)
def j7(spark, d):
    fact, customers = _dealt(spark, d, star_fact(spark, d))
    joined = join_dealt(fact, customers)
    return joined.groupBy("segment").agg(F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue"))


def _dealt(spark, d, fact):
    root = workspace(spark, "bucketed")
    tag = root.rsplit("-", 1)[1]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = deal_table(fact, f"fact_{tag}", "customer_id", n, ["customer_id", "date_key"], path=f"{root}/fact")
    people = marts.dim_customer(marts.clean_customers(customers_raw(spark, d)))
    customers = deal_table(people.select("customer_id", "segment"), f"customer_{tag}", "customer_id", n, path=f"{root}/customer")
    return lines, customers


HOT_FACT = """(SELECT order_id, line_total, CASE WHEN order_id::BIGINT % 3 = 0 THEN 1
  WHEN order_id::BIGINT % 3 = 1 AND order_id::BIGINT % 7 <> 0 THEN customer_id
  WHEN order_id::BIGINT % 3 = 2 THEN -customer_id END AS customer_id FROM fact)"""


def _hot_fact(spark, d):
    """A third of the lines is one customer's; some have none, others one that is not known."""
    key = F.col("order_id").cast("bigint")
    known = F.when(key % 3 == 0, 1).when((key % 3 == 1) & (key % 7 != 0), F.col("customer_id")).when(key % 3 == 2, -F.col("customer_id"))
    return star_fact(spark, d).withColumn("customer_id", known.cast("bigint"))


@query(
    "j7_hot_key_join",
    f"""
SELECT coalesce(c.segment, 'unknown') AS segment, count(*) AS lines, sum(f.line_total)::DOUBLE AS revenue
FROM {HOT_FACT} f LEFT JOIN customers_clean c ON f.customer_id = c.customer_id GROUP BY 1""",
    "fact customers_clean",
)
def j7_hot_key(spark, d):
    joined = join_dealt(*_dealt(spark, d, _hot_fact(spark, d)), "left")
    segment = F.coalesce("segment", F.lit("unknown")).alias("segment")
    return joined.groupBy(segment).agg(F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue"))


@query(
    "j7_hot_key_totals",
    f"SELECT customer_id, count(*) AS lines, sum(line_total)::DOUBLE AS revenue FROM {HOT_FACT} GROUP BY customer_id",
    "fact",
)
def j7_hot_totals(spark, d):
    fact, _ = _dealt(spark, d, _hot_fact(spark, d))
    return aggregate_dealt(fact, F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue"))


# --- aggregates -------------------------------------------------------------


@query(
    "a1_order_totals",
    "SELECT order_id, sum(line_total)::DOUBLE AS order_total FROM items_curated GROUP BY order_id",
    "items_curated",
)
def a1(spark, d):
    return marts.order_totals(items_curated(spark, d))


@query(
    "a2_daily_revenue",
    """
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, coalesce(round(sum(order_total), 2), 0)::DOUBLE AS total_revenue
FROM orders_passed GROUP BY 1""",
    "orders_passed",
)
def a2(spark, d):
    return marts.daily_revenue(quality.only_passed(order_outcomes(spark, d)))


GOLD_SQL = """
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, category, store_region, daily_revenue::DOUBLE AS daily_revenue,
  total_items_sold, total_order_count FROM gold"""


@query("a3_daily_regional_revenue", GOLD_SQL, "gold")
def a3(spark, d):
    return gold(spark, d)


@query(
    "a4_daily_revenue_by_category",
    """
SELECT strftime(f.order_ts, '%Y-%m-%d') AS order_date, p.category AS product_category,
  sum(f.line_total)::DOUBLE AS daily_revenue, sum(f.quantity)::BIGINT AS total_items_sold
FROM fact f JOIN products_clean p ON f.product_id = p.product_id GROUP BY 1, 2""",
    "fact products_clean",
)
def a4(spark, d):
    products = marts.clean_products(products_raw(spark, d))
    return marts.daily_revenue_by_category(star_fact(spark, d), calendar(spark, d), products)


@query(
    "a5_tile_daily",
    """
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, sum(daily_revenue)::DOUBLE AS global_revenue
FROM gold GROUP BY 1 ORDER BY 1""",
    "gold",
)
def a5(spark, d):
    return marts.tile_daily(gold(spark, d))


@query(
    "a6_tile_category",
    "SELECT category, sum(daily_revenue)::DOUBLE AS categorical_revenue FROM gold GROUP BY 1 ORDER BY 2 DESC, 1",
    "gold",
)
def a6(spark, d):
    return marts.tile_category(gold(spark, d))


@query(
    "a7_tile_region",
    """
SELECT store_region, sum(daily_revenue)::DOUBLE AS regional_revenue, sum(total_order_count)::BIGINT AS aggregate_orders
FROM gold GROUP BY 1 ORDER BY 2 DESC, 1""",
    "gold",
)
def a7(spark, d):
    return marts.tile_region(gold(spark, d))


@query("a8_tile_orders", "SELECT sum(total_order_count)::BIGINT AS total_processed_orders FROM gold", "gold")
def a8(spark, d):
    return marts.tile_orders(gold(spark, d))


@query("a8b_distinct_orders", "SELECT count(DISTINCT order_id) AS distinct_orders FROM gold_lines", "gold_lines")
def a8b(spark, d):
    return marts.distinct_orders(marts.gold_source(*silver(spark, d)))


@query(
    "a8b_distinct_orders_by_region",
    "SELECT store_region, count(DISTINCT order_id) AS distinct_orders FROM gold_lines GROUP BY 1",
    "gold_lines",
)
def a8b_region(spark, d):
    return marts.distinct_orders(marts.gold_source(*silver(spark, d)), "store_region")


@query(
    "a9_segment_revenue",
    """
SELECT c.segment, sum(f.line_total)::DOUBLE AS total_revenue, count(DISTINCT f.order_id) AS order_count
FROM fact f JOIN customers_clean c ON f.customer_id = c.customer_id
WHERE cast(f.order_ts AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'
GROUP BY 1 ORDER BY 2 DESC, 1""",
    "fact customers_clean",
)
def a9(spark, d):
    customers = marts.clean_customers(customers_raw(spark, d))
    return marts.segment_revenue(star_fact(spark, d), customers, calendar(spark, d), "1998-06-01", "1998-06-30")


@query(
    "a10_orders_per_day",
    """
SELECT strftime(order_ts, '%Y-%m-%d') AS order_date, count(*) AS orders FROM orders_raw
WHERE order_ts IS NOT NULL GROUP BY 1""",
    "orders_raw",
)
def a10(spark, d):
    return marts.orders_per_day(orders_raw(spark, d))


@query(
    "a11_category_revenue",
    """
SELECT p.category, sum(i.line_total)::DOUBLE AS revenue FROM items_raw i
LEFT JOIN products_clean p ON i.product_id = p.product_id WHERE p.category IS NOT NULL GROUP BY 1""",
    "items_raw products_clean",
)
def a11(spark, d):
    return marts.category_revenue(items_raw(spark, d), marts.clean_products(products_raw(spark, d)))


@query(
    "a12_run_counts",
    """
SELECT 'customers' AS source, count(*) AS rows FROM customers_clean UNION ALL
SELECT 'order_items', count(*) FROM items_curated UNION ALL
SELECT 'orders', count(*) FROM orders_curated UNION ALL
SELECT 'products', count(*) FROM products_clean""",
    "customers_clean items_curated orders_curated products_clean",
)
def a12(spark, d):
    return marts.run_counts(
        order_items=items_curated(spark, d),
        orders=orders_curated(spark, d),
        customers=marts.clean_customers(customers_raw(spark, d)),
        products=marts.clean_products(products_raw(spark, d)),
    )
