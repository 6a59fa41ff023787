"""Joins and aggregates behind the revenue marts and the dashboard.

No join carries a hint. Spark broadcasts a side whose known size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise. Where a
key of the larger side may be hot (a product, a customer), ``split_join`` lets AQE
split it. Joins on the order stay plain: after deduplication an order has at most
one line per product, and the aggregates above use the join's partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clamp_non_negative, date_key, fill, money, normalize_email, order_day
from .joins import split_join
from .quality import only_passed
from .rows import between_dates, dedup, fill_defaults, latest_by, require_keys

# --- cleaning for the marts -------------------------------------------------


def clean_customers(customers: DataFrame) -> DataFrame:
    """The latest sign-up per customer, e-mail normalised."""
    latest = latest_by(customers, ["customer_id"], [F.col("signup_date").desc_nulls_last()])
    return latest.withColumn("email", normalize_email("email"))


def clean_products(products: DataFrame) -> DataFrame:
    """The first name per product; price 0 and active where unknown."""
    return fill_defaults(
        latest_by(products, ["product_id"], [F.col("product_name")]), {"unit_price": 0.0, "active_flag": True}
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """One row per order, status ``UNKNOWN`` where absent."""
    return fill_defaults(dedup(orders, ["order_id"]), {"status": "UNKNOWN"})


def line_total(items: DataFrame) -> DataFrame:
    return items.withColumn("line_total", (F.col("quantity") * F.col("unit_price")).cast(_amount(items)))


def _amount(df: DataFrame) -> str:
    """The type of a line total over ``df``: exact for exact prices."""
    return "decimal(12,2)" if dict(df.dtypes)["unit_price"].startswith("decimal") else "double"


def clean_items(items: DataFrame) -> DataFrame:
    """One row per (order, product), no negative quantity, total recomputed."""
    kept = dedup(require_keys(items, ["order_id", "product_id"]), ["order_id", "product_id"])
    return line_total(kept.withColumn("quantity", clamp_non_negative("quantity")))


# --- joins ------------------------------------------------------------------


def order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum("line_total").alias("order_total"))


def with_order_total(orders: DataFrame, items: DataFrame) -> DataFrame:
    """``orders`` with the sum of their items' totals, 0 for an order without items."""
    joined = orders.join(order_totals(items), "order_id", "left")
    return joined.withColumn("order_total", fill("order_total", 0))


def gold_source(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with their order's day and region and their product's category.

    Only the columns the marts need are joined. A partition column the items may
    bring along (``order_date``) stays out: the order's own day counts.
    """
    o = orders.select("order_id", order_day("order_ts").alias("order_date"), "store_region")
    i = items.select("order_id", "product_id", "quantity", "line_total")
    p = products.select("product_id", "category")
    return split_join(i, p, "product_id").join(o, "order_id")


def build_fact(items: DataFrame, orders: DataFrame, require_item_pass: bool = False) -> DataFrame:
    """Order lines of the orders that passed their quality gate, in warehouse types.

    Items that failed their own gate stay in unless ``require_item_pass``.
    """
    if require_item_pass:
        items = only_passed(items)
    o = only_passed(orders).select(
        "order_id", F.col("customer_id").cast("long").alias("customer_id"), "order_ts", "store_region"
    )
    i = items.select("order_id", "product_id", "quantity", "unit_price", "line_total")
    return i.join(o, "order_id").select(
        "order_id",
        "customer_id",
        "product_id",
        date_key("order_ts").alias("date_key"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("line_total").cast("decimal(12,2)").alias("line_total"),
        "order_ts",
        "store_region",
    )


def star(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """``fact`` inner-joined with each ``(dimension, key)``; of a dimension's columns
    that the fact also has, the fact's are kept."""
    for dim, key in dims:
        taken = [c for c in dim.columns if c != key and c in fact.columns]
        fact = split_join(fact, dim.drop(*taken), key)
    return fact


def items_with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """All items, with the category of those whose product is known."""
    return split_join(items, products.select("product_id", "category"), "product_id", "left")


# --- dimensions and warehouse types -----------------------------------------


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").try_cast("long").alias("customer_id"),
        "first_name",
        "last_name",
        "email",
        "signup_date",
        "city",
        "segment",
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_name",
        "category",
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        "active_flag",
    )


def dim_date(spark, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("calendar_date")
    )
    return days.select(
        date_key("calendar_date").alias("date_key"),
        "calendar_date",
        F.date_format("calendar_date", "EEEE").alias("day_of_week"),
        F.date_format("calendar_date", "MMMM").alias("calendar_month"),
        F.year("calendar_date").alias("calendar_year"),
    )


# --- aggregates -------------------------------------------------------------


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Revenue per day over every status, cancelled and returned included."""
    daily = orders.groupBy("order_date").agg(money(F.sum("order_total")).alias("total_revenue"))
    return daily.withColumn("total_revenue", fill("total_revenue", 0))


def daily_regional_revenue(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, items and distinct orders per day, category and region."""
    return (
        gold_source(orders, items, products)
        .groupBy("order_date", "category", "store_region")
        .agg(
            F.sum("line_total").alias("daily_revenue"),
            F.sum("quantity").alias("total_items_sold"),
            F.countDistinct("order_id").alias("total_order_count"),
        )
    )


def daily_revenue_by_category(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and items per calendar day and category, over the star.

    The fact is summed per date and product before it meets the dimensions, so
    their joins see one row per pair instead of one per line.
    """
    per_pair = fact.groupBy("date_key", "product_id").agg(
        F.sum("line_total").alias("_revenue"), F.sum("quantity").alias("_items")
    )
    return (
        per_pair.join(products.select("product_id", "category"), "product_id")
        .join(dates.select("date_key", "calendar_date"), "date_key")
        .groupBy(F.col("calendar_date").alias("order_date"), F.col("category").alias("product_category"))
        .agg(F.sum("_revenue").alias("daily_revenue"), F.sum("_items").alias("total_items_sold"))
    )


def tile_daily(gold: DataFrame) -> DataFrame:
    return gold.groupBy("order_date").agg(F.sum("daily_revenue").alias("global_revenue")).orderBy("order_date")


def tile_category(gold: DataFrame) -> DataFrame:
    revenue = gold.groupBy("category").agg(F.sum("daily_revenue").alias("categorical_revenue"))
    return revenue.orderBy(F.desc("categorical_revenue"), "category")


def tile_region(gold: DataFrame) -> DataFrame:
    """An order with lines in two categories counts twice; see :func:`distinct_orders`."""
    revenue = gold.groupBy("store_region").agg(
        F.sum("daily_revenue").alias("regional_revenue"), F.sum("total_order_count").alias("aggregate_orders")
    )
    return revenue.orderBy(F.desc("regional_revenue"), "store_region")


def tile_orders(gold: DataFrame) -> DataFrame:
    """Order count as the dashboard has it: re-summed over categories."""
    return gold.agg(F.sum("total_order_count").alias("total_processed_orders"))


def distinct_orders(source: DataFrame, by: str | None = None) -> DataFrame:
    """Orders counted once each, overall or per ``by``, from :func:`gold_source`."""
    counted = F.countDistinct("order_id").alias("distinct_orders")
    return source.groupBy(by).agg(counted) if by else source.agg(counted)


def segment_revenue(fact: DataFrame, customers: DataFrame, dates: DataFrame, lo: Any, hi: Any) -> DataFrame:
    """Revenue and distinct orders per customer segment from ``lo`` to ``hi``.

    The window is also put on the fact's own ``date_key``, where a scan can skip
    row groups or partitions by it.
    """
    day_lo, day_hi = (date_key(F.lit(d).cast("date")) for d in (lo, hi))
    window = between_dates(dates, "calendar_date", lo, hi).select("date_key")
    lines = fact.where(F.col("date_key").between(day_lo, day_hi)).select(
        "date_key", "customer_id", "order_id", "line_total"
    )
    in_window = split_join(lines, window, "date_key")
    return (
        split_join(in_window, customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(F.sum("line_total").alias("total_revenue"), F.countDistinct("order_id").alias("order_count"))
        .orderBy(F.desc("total_revenue"), "segment")
    )


def orders_per_day(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(order_day("order_ts").alias("order_date"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .where("order_date IS NOT NULL")
    )


def category_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category; items of unknown products have none and drop out."""
    per_product = items.groupBy("product_id").agg(F.sum("line_total").alias("line_total"))
    return (
        items_with_category(per_product, products)
        .where("category IS NOT NULL")
        .groupBy("category")
        .agg(F.sum("line_total").alias("revenue"))
    )


def run_counts(**sources: DataFrame) -> DataFrame:
    """(source, rows) for each named frame, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        for name, df in sources.items()
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def select_columns(df: DataFrame, cols: Sequence[str], **renamed: str) -> DataFrame:
    """``cols`` as they are, then ``new_name="old_name"`` pairs."""
    return df.select(*cols, *[F.col(old).alias(new) for new, old in renamed.items()])
