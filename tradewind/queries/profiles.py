"""Table profiles and defect reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts, profile
from .registry import query
from .tables import customers_raw, items_raw, orders_raw, products_raw


def _unpivot(table: str, cols: list[str], expression: str) -> str:
    """One SELECT per column, with ``{c}`` standing for it."""
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {expression.format(c=c)} FROM {table}" for c in cols)


CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "email", "signup_date", "city", "segment"]


@query(
    "a13a_profile_shape",
    """
SELECT v.c AS "column", v.t AS type, n AS rows, 5::BIGINT AS columns FROM (SELECT count(*) AS n FROM items_raw),
  (VALUES ('order_id', 'string'), ('product_id', 'bigint'), ('quantity', 'int'), ('unit_price', 'decimal(10,2)'),
    ('line_total', 'decimal(12,2)')) v(c, t)""",
    "items_raw",
)
def a13a(spark, d):
    return profile.profile_shape(items_raw(spark, d))


@query(
    "a13b_profile_nulls",
    _unpivot(
        "customers_raw",
        CUSTOMER_COLS,
        "count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct",
    ),
    "customers_raw",
)
def a13b(spark, d):
    return profile.profile_nulls(customers_raw(spark, d))


@query(
    "a13c_profile_duplicates",
    "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_raw)) AS duplicate_rows FROM orders_raw",
    "orders_raw",
)
def a13c(spark, d):
    """Orders without a time that were delivered twice are alike in every column."""
    return profile.profile_duplicates(orders_raw(spark, d))


@query(
    "a13d_profile_ranges",
    _unpivot(
        "items_raw",
        ["product_id", "quantity", "unit_price", "line_total"],
        "min({c})::DOUBLE AS minimum, max({c})::DOUBLE AS maximum,"
        " round(sum({c})::DOUBLE / count({c}), 2) AS mean",
    ),
    "items_raw",
)
def a13d(spark, d):
    return profile.profile_ranges(items_raw(spark, d))


@query(
    "a13e_profile_top_values",
    """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, value) AS rank FROM (
  SELECT 'order_id' AS "column", order_id AS value, count(*) AS rows FROM orders_raw GROUP BY order_id UNION ALL
  SELECT 'store_region', store_region, count(*) FROM orders_raw GROUP BY store_region UNION ALL
  SELECT 'status', status, count(*) FROM orders_raw GROUP BY status UNION ALL
  SELECT 'discount_code', discount_code, count(*) FROM orders_raw GROUP BY discount_code)
  WHERE value IS NOT NULL) WHERE rank <= 10""",
    "orders_raw",
)
def a13e(spark, d):
    return profile.common_values(orders_raw(spark, d), 10)


@query(
    "a13e_common_products",
    """
SELECT 'product_id' AS "column", value, rows, rank FROM (
  SELECT value, rows, row_number() OVER (ORDER BY rows DESC, value) AS rank FROM (
    SELECT CASE WHEN product_id::BIGINT % 4 = 0 THEN 'lot ' || product_id::BIGINT % 12 ELSE 'line ' || order_id || '.' || product_id END AS value,
      count(*) AS rows FROM items_raw GROUP BY 1) WHERE value IS NOT NULL) WHERE rank <= 3""",
    "items_raw",
)
def a13e_products(spark, d):
    """A column of almost as many values as rows, of which three are common."""
    key = F.col("product_id").cast("bigint")
    value = F.when(key % 4 == 0, F.concat(F.lit("lot "), key % 12)).otherwise(F.concat(F.lit("line "), "order_id", F.lit("."), "product_id"))
    return profile.common_values(items_raw(spark, d).select(value.alias("product_id")), 3)


HISTOGRAM_SQL = """
SELECT b.bin::BIGINT AS bin, lo + b.bin * ((hi - lo) / 40) AS lower,
  CASE WHEN b.bin = 39 THEN hi ELSE lo + (b.bin + 1) * ((hi - lo) / 40) END AS upper, count(v) AS rows
FROM (SELECT min(line_total)::DOUBLE AS lo, max(line_total)::DOUBLE AS hi FROM items_raw)
CROSS JOIN range(40) b(bin)
LEFT JOIN (SELECT line_total::DOUBLE AS v FROM items_raw WHERE line_total IS NOT NULL)
  ON v >= lo + b.bin * ((hi - lo) / 40) AND (v < lo + (b.bin + 1) * ((hi - lo) / 40) OR b.bin = 39)
GROUP BY ALL"""


@query("a14_histogram", HISTOGRAM_SQL, "items_raw")
def a14(spark, d):
    return profile.histogram(items_raw(spark, d), "line_total", 40)


@query(
    "a14b_kde",
    """
SELECT g.point::BIGINT AS point, round(lo + g.point * (hi - lo) / 49, 6) AS x,
  round(sum(w * exp(-0.5 * pow((v - (lo + g.point * (hi - lo) / 49)) / h, 2))) / (n * h * sqrt(2 * pi())) * 1e6, 6)
    AS density_per_million
FROM (SELECT count(line_total) AS n, min(line_total)::DOUBLE AS lo, max(line_total)::DOUBLE AS hi,
    stddev_samp(line_total::DOUBLE) * pow(count(line_total), -0.2) AS h FROM items_raw),
  (SELECT line_total::DOUBLE AS v, count(*) AS w FROM items_raw WHERE line_total IS NOT NULL GROUP BY 1),
  range(50) g(point) GROUP BY g.point, lo, hi, n, h""",
    "items_raw",
)
def a14b(spark, d):
    # Sums of doubles differ in their last digits with the order of the rows.
    curve = profile.kde(items_raw(spark, d), "line_total", 50)
    return curve.select(
        "point", F.round("x", 6).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density_per_million")
    )


@query(
    "a15_null_map",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", block, count(*) AS rows, (count(*) - count({c})) / count(*) AS null_rate
FROM (SELECT *, ((customer_id - lo) * 20 // (hi - lo + 1))::BIGINT AS block FROM customers_raw,
  (SELECT min(customer_id) AS lo, max(customer_id) AS hi FROM customers_raw)) GROUP BY block"""
        for c in CUSTOMER_COLS
    ),
    "customers_raw",
)
def a15(spark, d):
    return profile.null_map(customers_raw(spark, d), "customer_id", 20)


@query(
    "a16_duplicate_keys",
    """
SELECT sum(n)::BIGINT AS rows, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,
  (sum(n) - count(*))::BIGINT AS extra_rows, round((sum(n) - count(*)) / sum(n) * 100, 2)::DOUBLE AS extra_pct
FROM (SELECT count(*) AS n FROM customers_raw WHERE customer_id IS NOT NULL GROUP BY customer_id)""",
    "customers_raw",
)
def a16(spark, d):
    return profile.duplicate_keys(customers_raw(spark, d), "customer_id")


@query(
    "a17_email_defects",
    """
SELECT CASE WHEN email IS NULL THEN 'null' WHEN trim(email) = '' THEN 'empty' WHEN NOT contains(email, '@') THEN 'no_at'
  WHEN trim(email) LIKE '%@' THEN 'no_domain' WHEN trim(email) <> email THEN 'padded' ELSE 'ok' END AS email_class,
  count(*) AS rows FROM customers_raw GROUP BY 1""",
    "customers_raw",
)
def a17(spark, d):
    return profile.email_defects(customers_raw(spark, d))


@query(
    "a18_item_defects",
    """
SELECT count(*) AS rows,
  count(*) FILTER (product_id IS NULL OR product_id NOT IN (SELECT product_id FROM products_clean)) AS unknown_product,
  count(*) FILTER (quantity = 0) AS zero_quantity, count(*) FILTER (quantity < 0) AS negative_quantity
FROM items_raw""",
    "items_raw products_clean",
)
def a18(spark, d):
    return profile.item_defects(items_raw(spark, d), marts.clean_products(products_raw(spark, d)))
