"""Projections, filters, deduplication, sorts and unions on the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    clamp_non_negative,
    date_key,
    money,
    normalize_email,
    order_day,
    parse_date,
    parse_ts,
    valid_email,
)
from ..operators import marts, quality, rows
from ..operators.identity import with_identity
from ..sinks import stored
from .registry import query
from .tables import clicks_raw, customers_raw, items_raw, orders_raw, products_raw, table


@query(
    "p1_safe_select",
    """
SELECT try_cast(event_id AS BIGINT) AS session_id, customer_id, event_type, cast(NULL AS VARCHAR) AS page_url,
  strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, cast(NULL AS VARCHAR) AS device_type,
  try_cast(event_type AS BIGINT) AS type_number
FROM clicks_raw""",
    "clicks_raw",
)
def p1(spark, d):
    clicks = clicks_raw(spark, d).selectExpr(
        "cast(event_id AS string) AS session_id", "customer_id", "event_type", "event_ts", "event_type AS type_number"
    )
    return rows.safe_select(
        clicks,
        [
            ("session_id", "bigint"),
            ("customer_id", "bigint"),
            ("event_type", "string"),
            ("page_url", "string"),
            ("event_ts", "timestamp"),
            ("device_type", "string"),
            ("type_number", "bigint"),
        ],
    )


@query(
    "p2_require_keys",
    """
SELECT order_id, product_id, cast(quantity AS BIGINT) AS quantity, cast(line_total AS DOUBLE) AS line_total
FROM items_raw WHERE order_id IS NOT NULL AND product_id IS NOT NULL""",
    "items_raw",
)
def p2(spark, d):
    kept = rows.require_keys(items_raw(spark, d), ["order_id", "product_id"])
    return kept.select("order_id", "product_id", "quantity", "line_total")


@query(
    "p3_fill_defaults",
    """
SELECT product_id, product_name, cast(coalesce(unit_price, 0) AS DOUBLE) AS unit_price,
  coalesce(active_flag, true) AS active_flag FROM products_raw""",
    "products_raw",
)
def p3(spark, d):
    filled = rows.fill_defaults(products_raw(spark, d), {"unit_price": 0.0, "active_flag": True})
    return filled.select("product_id", "product_name", "unit_price", "active_flag")


@query("p3_fill_status", "SELECT order_id, coalesce(status, 'UNKNOWN') AS status FROM orders_raw", "orders_raw")
def p3_status(spark, d):
    return rows.fill_defaults(orders_raw(spark, d).select("order_id", "status"), {"status": "UNKNOWN"})


@query("p4_normalize_email", "SELECT customer_id, lower(trim(email)) AS email FROM customers_raw", "customers_raw")
def p4(spark, d):
    return customers_raw(spark, d).select("customer_id", normalize_email("email").alias("email"))


@query(
    "p5_parse_times",
    """
SELECT order_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS order_ts, strftime(order_ts, '%Y-%m-%d') AS order_date,
  strftime(order_ts, '%Y-%m-%d') AS parsed_date, cast(NULL AS VARCHAR) AS unreadable
FROM orders_raw""",
    "orders_raw",
)
def p5(spark, d):
    as_text = orders_raw(spark, d).select(
        "order_id", F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), "status"
    )
    return as_text.select(
        "order_id",
        parse_ts("iso").alias("order_ts"),
        order_day(parse_ts("iso")).alias("order_date"),
        parse_date(F.substr("iso", F.lit(1), F.lit(10))).alias("parsed_date"),
        parse_ts("status").alias("unreadable"),
    )


@query(
    "p6_clamp_quantity",
    """
SELECT order_id, product_id, cast(CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS BIGINT) AS quantity
FROM items_raw""",
    "items_raw",
)
def p6(spark, d):
    return items_raw(spark, d).select("order_id", "product_id", clamp_non_negative("quantity").alias("quantity"))


@query(
    "p7_line_total",
    """
SELECT order_id, product_id, cast(cast(quantity * unit_price AS DECIMAL(12,2)) AS DOUBLE) AS line_total
FROM items_raw""",
    "items_raw",
)
def p7(spark, d):
    return marts.line_total(items_raw(spark, d)).select("order_id", "product_id", "line_total")


@query(
    "p8_warehouse_types",
    """
SELECT product_id, product_name, category, cast(unit_price AS DOUBLE) AS unit_price, active_flag
FROM products_clean""",
    "products_clean",
)
def p8(spark, d):
    return marts.dim_product(marts.clean_products(products_raw(spark, d)))


@query(
    "p9_date_key",
    "SELECT order_id, cast(strftime(order_ts, '%Y%m%d') AS BIGINT) AS date_key FROM orders_raw",
    "orders_raw",
)
def p9(spark, d):
    return orders_raw(spark, d).select("order_id", date_key("order_ts").alias("date_key"))


@query(
    "p10_reason_column",
    "SELECT order_id, 'missing_status' AS dq_failure_reason FROM orders_raw WHERE status IS NULL",
    "orders_raw",
)
def p10(spark, d):
    missing = orders_raw(spark, d).where("status IS NULL").select("order_id")
    return rows.with_reason(missing, "missing_status")


@query(
    "p11_drop_prefixed",
    "SELECT count(*) AS n, sum(customer_id)::BIGINT AS customers FROM orders_curated",
    "orders_curated",
)
def p11(spark, d):
    outcomes = quality.evaluate_rows(orders_curated(spark, d), [quality.is_complete("status")])
    kept = rows.drop_prefixed(outcomes, "DataQuality")
    if any(c.startswith("DataQuality") for c in kept.columns):
        raise AssertionError("helper columns left")
    return kept.agg(F.count(F.lit(1)).alias("n"), F.sum("customer_id").alias("customers"))


@query(
    "p12_valid_email",
    """
SELECT coalesce(email LIKE '%_@__%.__%', false) AS valid, count(*) AS customers FROM customers_raw GROUP BY 1""",
    "customers_raw",
)
def p12(spark, d):
    tested = F.coalesce(valid_email("email"), F.lit(False)).alias("valid")
    return customers_raw(spark, d).groupBy(tested).agg(F.count(F.lit(1)).alias("customers"))


@query(
    "p13_no_failed_rules",
    """
SELECT CASE WHEN customer_id IS NULL AND status IS NULL THEN 2 WHEN customer_id IS NULL OR status IS NULL THEN 1 ELSE 0
  END::BIGINT AS failed_rules, count(*) AS orders FROM orders_raw GROUP BY 1""",
    "orders_raw",
)
def p13(spark, d):
    rules = [quality.is_complete("customer_id"), quality.is_complete("status")]
    outcomes = quality.evaluate_rows(orders_raw(spark, d), rules)
    return outcomes.groupBy(F.size(quality.FAILED_RULES).alias("failed_rules")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "p14_between_dates",
    """
SELECT order_id, store_region FROM orders_raw
WHERE cast(order_ts AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'""",
    "orders_raw",
)
def p14(spark, d):
    # The bounds are on the raw column, so the scan gets them as row-group filters.
    orders = orders_raw(spark, d)
    return rows.between_dates(orders, order_day("order_ts"), "1998-06-01", "1998-06-30").select(
        "order_id", "store_region"
    )


@query(
    "p15_only_passed",
    "SELECT store_region, count(*) AS orders FROM orders_passed GROUP BY store_region",
    "orders_passed",
)
def p15(spark, d):
    passed = quality.only_passed(order_outcomes(spark, d))
    return passed.groupBy("store_region").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "p16_dim_date",
    """
SELECT cast(strftime(day, '%Y%m%d') AS BIGINT) AS date_key, strftime(day, '%Y-%m-%d') AS calendar_date,
  dayname(day) AS day_of_week, monthname(day) AS calendar_month, cast(year(day) AS BIGINT) AS calendar_year
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders)""",
)
def p16(spark, d):
    lo, hi = table(spark, d, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return marts.dim_date(spark, str(lo.date()), str(hi.date()))


@query(
    "p17_select_alias",
    "SELECT order_id, store_region AS region, status AS state FROM orders_raw",
    "orders_raw",
)
def p17(spark, d):
    return marts.select_columns(orders_raw(spark, d), ["order_id"], region="store_region", state="status")


@query(
    "p18_round_money",
    """
SELECT store_region, cast(round(sum(order_total), 2) AS DOUBLE) AS revenue FROM orders_curated GROUP BY store_region""",
    "orders_curated",
)
def p18(spark, d):
    return orders_curated(spark, d).groupBy("store_region").agg(money(F.sum("order_total")).alias("revenue"))


# --- deduplication and keys -------------------------------------------------


@query(
    "w1_latest_customer",
    """
SELECT customer_id, first_name, last_name, email, strftime(signup_date, '%Y-%m-%d') AS signup_date, city, segment
FROM customers_clean""",
    "customers_clean",
)
def w1(spark, d):
    return marts.clean_customers(customers_raw(spark, d))


@query(
    "w2_first_product",
    """
SELECT product_id, product_name, category, cast(unit_price AS DOUBLE) AS unit_price, active_flag
FROM products_clean""",
    "products_clean",
)
def w2(spark, d):
    return marts.clean_products(products_raw(spark, d))


@query(
    "w3_latest_order",
    """
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, store_region, status, discount_code
FROM orders_curated""",
    "orders_curated",
)
def w3(spark, d):
    typed = orders_raw(spark, d).withColumn("order_date", order_day("order_ts"))
    latest = rows.latest_by(typed, ["order_id"], [F.col("order_date").desc_nulls_last()])
    return latest.select("order_id", "customer_id", "order_date", "store_region", "status", "discount_code")


@query(
    "w4_identity",
    """
SELECT row_number() OVER (ORDER BY order_id, product_id) AS order_item_id, order_id, customer_id, product_id,
  date_key::BIGINT AS date_key, quantity::BIGINT AS quantity, unit_price::DOUBLE AS unit_price,
  line_total::DOUBLE AS line_total, strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS order_ts, store_region FROM fact""",
    "fact",
)
def w4(spark, d):
    return with_identity(star_fact(spark, d), ["order_id", "product_id"], "order_item_id")


@query(
    "w5_dedup_items",
    """
SELECT order_id, product_id, cast(quantity AS BIGINT) AS quantity, cast(unit_price AS DOUBLE) AS unit_price,
  cast(line_total AS DOUBLE) AS line_total FROM items_curated""",
    "items_curated",
)
def w5(spark, d):
    return items_curated(spark, d)


@query(
    "w5_dropped_rows",
    """
SELECT sum(n)::BIGINT AS rows, count(*) AS kept, (sum(n) - count(*))::BIGINT AS dropped
FROM (SELECT count(*) AS n FROM items_raw WHERE order_id IS NOT NULL AND product_id IS NOT NULL
  GROUP BY order_id, product_id)""",
    "items_raw",
)
def w5_dropped(spark, d):
    return rows.dropped_by_dedup(items_raw(spark, d), ["order_id", "product_id"])


# --- sorts, limits, unions --------------------------------------------------


@query(
    "o1_sorted_regions",
    "SELECT store_region, count(*) AS orders FROM orders_raw GROUP BY store_region ORDER BY orders DESC, store_region",
    "orders_raw",
)
def o1(spark, d):
    counted = orders_raw(spark, d).groupBy("store_region").agg(F.count(F.lit(1)).alias("orders"))
    return counted.orderBy(F.desc("orders"), "store_region")


@query(
    "o2_top_orders",
    """
SELECT order_id, cast(order_total AS DOUBLE) AS order_total FROM orders_curated
ORDER BY orders_curated.order_total DESC, order_id LIMIT 5""",
    "orders_curated",
)
def o2(spark, d):
    totals = orders_curated(spark, d).select("order_id", "order_total")
    return rows.top_k(totals, [F.desc("order_total"), "order_id"], 5)


@query(
    "o3_preview_customers",
    "SELECT customer_id, first_name, email FROM customers_clean ORDER BY customer_id, first_name, email LIMIT 5",
    "customers_clean",
)
def o3(spark, d):
    return rows.preview(marts.clean_customers(customers_raw(spark, d)).select("customer_id", "first_name", "email"), 5)


@query(
    "u1_union_evolving",
    """
SELECT order_id, customer_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS order_ts, store_region, status,
  CASE WHEN order_ts < TIMESTAMP '1998-06-01' THEN NULL ELSE discount_code END AS discount_code FROM orders_raw""",
    "orders_raw",
)
def u1(spark, d):
    """Orders without a date are of the newer shape, whose columns stand in another order."""
    orders = orders_raw(spark, d)
    is_older = "coalesce(order_ts < timestamp'1998-06-01', false)"
    older = orders.where(is_older).drop("discount_code")
    newer = orders.where(f"NOT {is_older}")
    return rows.union_evolving(older, newer.select(*reversed(newer.columns)))


# --- frames other query modules build on ------------------------------------


def items_curated(spark, d):
    filled = rows.fill_defaults(items_raw(spark, d), {"line_total": 0.0})
    return rows.dedup(rows.require_keys(filled, ["order_id", "product_id"]), ["order_id", "product_id"])


def orders_curated(spark, d, items=None):
    typed = orders_raw(spark, d).withColumn("order_date", order_day("order_ts"))
    latest = rows.latest_by(typed, ["order_id"], [F.col("order_date").desc_nulls_last()])
    return marts.with_order_total(latest, items_curated(spark, d) if items is None else items)


def order_outcomes(spark, d, items=None):
    from ..plans.curation import order_rules

    # The uniqueness rule counts the orders and joins them with the count: written once, and so
    # are orders found twice, of which there should be few.
    return quality.evaluate_rows(stored(orders_curated(spark, d, items), "orders"), order_rules(), lambda found: stored(found, "repeated"))


def star_fact(spark, d):
    """The items, written once, make up both the lines and the order totals."""
    items = stored(items_curated(spark, d), "items")
    return marts.build_fact(items, order_outcomes(spark, d, items))
