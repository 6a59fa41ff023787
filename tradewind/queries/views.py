"""Views kept up to date from row changes, and the star that keeps them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..operators import changes, marts
from ..plans import warehouse
from ..session import several_tasks_a_core, workspace
from .cleaning import items_curated, order_outcomes, star_fact
from .marts import calendar
from .registry import query
from .tables import customers_raw, products_raw

CATEGORY_SQL = """
SELECT strftime(f.order_ts, '%Y-%m-%d') AS order_date, p.category AS product_category,
  sum(f.line_total)::DOUBLE AS daily_revenue, sum(f.quantity)::BIGINT AS total_items_sold
FROM fact f JOIN products_clean p ON f.product_id = p.product_id GROUP BY 1, 2"""

REGIONAL_SQL = """
SELECT strftime(f.order_ts, '%Y-%m-%d') AS order_date, p.category, f.store_region,
  sum(f.line_total)::DOUBLE AS daily_revenue, sum(f.quantity)::BIGINT AS total_items_sold,
  count(DISTINCT f.order_id) AS total_order_count
FROM fact f JOIN products_clean p ON f.product_id = p.product_id GROUP BY 1, 2, 3"""


def _kept(spark, d, view):
    """The view of an earlier fact, brought up to date by the changes since. That fact lacks
    lines, has others with another total, on another day or twice, and orders that are gone."""
    fact = sinks.stored(star_fact(spark, d), "fact")
    products = sinks.stored(marts.clean_products(products_raw(spark, d)), "products")
    key = F.col("order_id").cast("bigint")
    older = fact.where((key + F.col("product_id")) % 5 != 0)
    older = older.withColumn("line_total", F.when(key % 7 == 1, F.col("line_total") + 1).otherwise(F.col("line_total")).cast("decimal(12,2)"))
    older = older.withColumn("order_ts", F.when(key % 11 == 2, F.date_add(F.col("order_ts"), 400).cast("timestamp")).otherwise(F.col("order_ts")))
    gone = fact.where(key % 13 == 3).withColumn("order_id", F.concat(F.lit("gone"), "order_id"))
    feed = changes.change_feed(older.unionByName(gone), fact, ["order_id", "product_id"], 1)
    sinks.build_view(warehouse.view_lines(older.unionByName(gone), products), view)
    for _ in range(2):  # a version that comes again changes nothing
        sinks.apply_changes(warehouse.view_lines(feed, products), view, 1)
    return sinks.read_view(spark, view).drop("order_month")


@query("k8_kept_category_view", CATEGORY_SQL, "fact products_clean")
def k8_kept_category(spark, d):
    return _kept(spark, d, warehouse.category_view(workspace(spark, "kept")))


@query("k8_kept_regional_view", REGIONAL_SQL, "fact products_clean")
def k8_kept_regional(spark, d):
    return _kept(spark, d, warehouse.regional_view(workspace(spark, "kept")))


@query("k8_star_views", CATEGORY_SQL, "fact products_clean")
def k8_star_views(spark, d):
    """The star is loaded with some orders and with other categories, then with all; its own
    category view follows."""
    root = workspace(spark, "warehouse")
    products = marts.clean_products(products_raw(spark, d))
    other = products.withColumn("category", F.when(F.col("product_id") % 3 == 0, "other").otherwise(F.col("category")))
    with several_tasks_a_core(spark):
        items = sinks.stored(items_curated(spark, d), "items")
        orders = sinks.stored(order_outcomes(spark, d, items), "order-outcomes")
    customers = marts.clean_customers(customers_raw(spark, d))
    prefix = f"v{root.rsplit('-', 1)[1]}_"
    some = items.where("cast(order_id AS bigint) % 4 <> 0")
    # Products that the first load does not know yet, too.
    warehouse.load_star(spark, prefix, root, customers, other.where("product_id % 10 <> 7"), orders, some, version=0)
    warehouse.load_star(spark, prefix, root, customers, products, orders, items, version=1)
    return sinks.read_view(spark, warehouse.category_view(root)).drop("order_month")


@query(
    "k7_load_curated",
    """
SELECT 'rows' AS measure, count(*)::DOUBLE AS value FROM fact UNION ALL
SELECT 'revenue', sum(line_total)::DOUBLE FROM fact UNION ALL
SELECT 'highest number', count(*) FROM fact UNION ALL
SELECT 'different numbers', count(*) FROM fact UNION ALL
SELECT 'first load has the lowest', count(*) FILTER (order_id::BIGINT % 4 <> 0) FROM fact""",
    "fact",
)
def k7_load_curated(spark, d):
    """Curated files to the star in one go, two of them by manifest; lines that come with a
    second load get the numbers after those of the first, which keep theirs."""
    root = workspace(spark, "curated")
    prefix = f"m{root.rsplit('-', 1)[1]}_"
    items, late = sinks.stored(items_curated(spark, d), "items"), F.col("order_id").cast("bigint") % 4 == 0
    curated = {
        "customers": sinks.publish_snapshot(marts.clean_customers(customers_raw(spark, d)), f"{root}/customers"),
        "orders": sinks.publish_snapshot(order_outcomes(spark, d, items), f"{root}/orders"),
        "products": f"{root}/products",
        "items": f"{root}/items",
    }
    sinks.append(marts.clean_products(products_raw(spark, d)), curated["products"])
    sinks.append(items.where(~late), curated["items"])
    warehouse.load_curated(spark, prefix, root, curated)
    sinks.append(items.where(late), curated["items"])
    fact = spark.read.table(warehouse.load_curated(spark, prefix, root, curated)["fact_order_items"])
    number, known = F.col("order_item_id"), F.count_if(~late)
    # Different numbers as bitmaps of some 30,000 each; a number lies in one bitmap only.
    first = fact.agg(known.alias("known")).select("known").scalar()
    marked = fact.select("line_total", number.alias("number"), (~late & (number <= first)).alias("lowest"), F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
    parts = marked.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("line_total").alias("revenue"), F.max("number").alias("highest"),
        F.bitmap_count(F.bitmap_construct_agg("bit")).alias("different"), F.count_if("lowest").alias("lowest"),
    )
    found = parts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("double").alias("rows"), F.sum("revenue").cast("double").alias("revenue"),
        F.max("highest").cast("double").alias("highest number"), F.coalesce(F.sum("different"), F.lit(0)).cast("double").alias("different numbers"),
        F.coalesce(F.sum("lowest"), F.lit(0)).cast("double").alias("first load has the lowest"),
    )
    return found.unpivot([], found.columns, "measure", "value")


@query(
    "a9_clustered_fact",
    """
SELECT c.segment, sum(f.line_total)::DOUBLE AS total_revenue, count(DISTINCT f.order_id) AS order_count
FROM fact f JOIN customers_clean c ON f.customer_id = c.customer_id
WHERE cast(f.order_ts AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'
GROUP BY 1 ORDER BY 2 DESC, 1""",
    "fact customers_clean",
)
def a9_clustered(spark, d):
    """Segments over a fact that lies along the curve through day and customer."""
    root = workspace(spark, "clustered")
    fact = sinks.clustered_table(star_fact(spark, d), f"z{root.rsplit('-', 1)[1]}_fact", ["date_key", "customer_id"], 16, f"{root}/fact")
    customers = marts.clean_customers(customers_raw(spark, d))
    return marts.segment_revenue(fact, customers, calendar(spark, d), "1997-03-01", "1997-05-31")
