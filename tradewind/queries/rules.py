"""Data-quality rules, outcomes, quarantine and expectations."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ..functions import valid_email
from ..operators import marts, quality
from ..plans.curation import ITEMS_CHECK, ITEMS_REASON, ORDERS_CHECK, ORDERS_REASON, item_rules, order_rules
from ..plans.expectations import ExpectationFailed, update_tables, violations
from ..plans.lakehouse import expected_customers, expected_items, silver_tables
from ..session import workspace
from ..sinks import append
from .cleaning import items_curated, order_outcomes, orders_curated
from .marts import gold
from .registry import query
from .tables import customers_raw, items_raw, orders_raw, products_raw



def item_outcomes(spark, d):
    products = marts.clean_products(products_raw(spark, d))
    return quality.evaluate_rows(items_curated(spark, d), item_rules(products))


@query(
    "q1_is_complete",
    """
SELECT order_id, customer_id, CASE WHEN customer_id IS NULL THEN 'Failed' ELSE 'Passed' END AS result FROM orders_raw""",
    "orders_raw",
)
def q1(spark, d):
    outcomes = quality.evaluate_rows(orders_raw(spark, d), [quality.is_complete("customer_id")])
    return outcomes.select("order_id", "customer_id", F.col(quality.RESULT).alias("result"))


@query(
    "q2_is_unique",
    """
SELECT order_id, status, CASE WHEN count(*) OVER (PARTITION BY order_id) = 1 THEN 'Passed' ELSE 'Failed' END AS result
FROM orders_raw""",
    "orders_raw",
)
def q2(spark, d):
    outcomes = quality.evaluate_rows(orders_raw(spark, d), [quality.is_unique("order_id")])
    return outcomes.select("order_id", "status", F.col(quality.RESULT).alias("result"))


@query(
    "q3_column_values",
    """
SELECT order_id, product_id, CASE WHEN line_total >= 0 THEN 'Passed' ELSE 'Failed' END AS result FROM items_raw""",
    "items_raw",
)
def q3(spark, d):
    outcomes = quality.evaluate_rows(items_raw(spark, d), [quality.column_values("line_total", ">=", 0)])
    return outcomes.select("order_id", "product_id", F.col(quality.RESULT).alias("result"))


@query(
    "q4_referential",
    """
SELECT order_id, product_id, CASE WHEN product_id IN (SELECT product_id FROM products_clean) THEN 'Passed'
  ELSE 'Failed' END AS result FROM items_raw""",
    "items_raw products_clean",
)
def q4(spark, d):
    rule = quality.referential("product_id", products_raw(spark, d), "product_id")
    outcomes = quality.evaluate_rows(items_raw(spark, d), [rule])
    return outcomes.select("order_id", "product_id", F.col(quality.RESULT).alias("result"))


@query(
    "q5_order_outcomes",
    """
SELECT order_id,
  array_to_string(list_sort([r.name FOR r IN rules IF r.ok]), '; ') AS passed_rules,
  array_to_string(list_sort([r.name FOR r IN rules IF NOT r.ok]), '; ') AS failed_rules,
  CASE WHEN len([r FOR r IN rules IF NOT r.ok]) = 0 THEN 'Passed' ELSE 'Failed' END AS result
FROM (SELECT order_id, [
    {'name': 'IsComplete "order_id"', 'ok': order_id IS NOT NULL},
    {'name': 'IsComplete "customer_id"', 'ok': customer_id IS NOT NULL},
    {'name': 'IsComplete "status"', 'ok': status IS NOT NULL},
    {'name': 'IsComplete "order_total"', 'ok': order_total IS NOT NULL},
    {'name': 'IsComplete "order_date"', 'ok': order_date IS NOT NULL},
    {'name': 'IsUnique "order_id"', 'ok': count(*) OVER (PARTITION BY order_id) = 1},
    {'name': 'ColumnValues "order_total" >= 0', 'ok': order_total >= 0}] AS rules
  FROM orders_curated)""",
    "orders_curated",
)
def q5(spark, d):
    return order_outcomes(spark, d).select(
        "order_id",
        F.col(quality.PASSED_RULES).alias("passed_rules"),
        F.col(quality.FAILED_RULES).alias("failed_rules"),
        F.col(quality.RESULT).alias("result"),
    )


@query(
    "q5_item_outcomes",
    """
SELECT i.order_id, i.product_id, CASE WHEN p.product_id IS NULL
  THEN 'ReferentialIntegrity "product_id" "products_ref.{product_id}" = 1.0' ELSE '' END AS failed_rules,
  CASE WHEN p.product_id IS NULL THEN 'Failed' ELSE 'Passed' END AS result
FROM items_curated i LEFT JOIN products_clean p ON i.product_id = p.product_id""",
    "items_curated products_clean",
)
def q5_items(spark, d):
    return item_outcomes(spark, d).select(
        "order_id",
        "product_id",
        F.col(quality.FAILED_RULES).alias("failed_rules"),
        F.col(quality.RESULT).alias("result"),
    )


@query(
    "q6_rule_outcomes",
    """
SELECT rule, CASE WHEN ok = n THEN 'Passed' ELSE 'Failed' END AS outcome, ok / n AS ratio FROM (
  SELECT count(*) AS n, count(order_id) AS a, count(customer_id) AS b, count(status) AS c, count(order_total) AS d,
    count(order_date) AS e, count(DISTINCT order_id) AS f, count(*) FILTER (order_total >= 0) AS g
  FROM orders_curated), LATERAL (VALUES ('IsComplete "order_id"', a), ('IsComplete "customer_id"', b),
    ('IsComplete "status"', c), ('IsComplete "order_total"', d), ('IsComplete "order_date"', e),
    ('IsUnique "order_id"', f), ('ColumnValues "order_total" >= 0', g)) v(rule, ok)""",
    "orders_curated",
)
def q6(spark, d):
    return quality.evaluate_rules(orders_curated(spark, d), order_rules())


@query(
    "q6_item_rule_outcomes",
    """
SELECT rule, CASE WHEN ok = n THEN 'Passed' ELSE 'Failed' END AS outcome, ok / n AS ratio FROM (
  SELECT count(*) AS n, count(i.order_id) AS a, count(i.product_id) AS b, count(quantity) AS c, count(line_total) AS d,
    count(p.product_id) AS e FROM items_curated i LEFT JOIN products_clean p ON i.product_id = p.product_id),
  LATERAL (VALUES ('IsComplete "order_id"', a), ('IsComplete "product_id"', b), ('IsComplete "quantity"', c),
    ('IsComplete "line_total"', d),
    ('ReferentialIntegrity "product_id" "products_ref.{product_id}" = 1.0', e)) v(rule, ok)""",
    "items_curated products_clean",
)
def q6_items(spark, d):
    products = marts.clean_products(products_raw(spark, d))
    return quality.evaluate_rules(items_curated(spark, d), item_rules(products))


@query(
    "q7_split_quarantine",
    f"""
SELECT order_id, customer_id, order_total::DOUBLE AS order_total,
  CASE WHEN order_id IN (SELECT order_id FROM orders_passed) THEN NULL ELSE '{ORDERS_REASON}' END AS dq_failure_reason
FROM orders_curated""",
    "orders_curated orders_passed",
)
def q7(spark, d):
    # The outcomes are written once and both sides read them back.
    path = workspace(spark, "outcomes")
    outcomes = order_outcomes(spark, d)
    append(outcomes, path)
    passed, failed = quality.split_quarantine(spark.read.schema(outcomes.schema).parquet(path), ORDERS_REASON)
    both = passed.unionByName(failed.drop(quality.PASSED_RULES, quality.FAILED_RULES), allowMissingColumns=True)
    return both.select("order_id", "customer_id", "order_total", "dq_failure_reason")


@query(
    "q7_quarantined_items",
    f"""
SELECT order_id, product_id, '{ITEMS_REASON}' AS dq_failure_reason FROM items_curated
WHERE product_id NOT IN (SELECT product_id FROM products_clean)""",
    "items_curated products_clean",
)
def q7_items(spark, d):
    _, failed = quality.split_quarantine(item_outcomes(spark, d), ITEMS_REASON)
    return failed.select("order_id", "product_id", "dq_failure_reason")


SCORE_SQL = """passed, failed, total, CASE WHEN total = 0 THEN 100 ELSE round(passed / total * 100, 2) END::DOUBLE AS score"""


@query(
    "q8_quality_score",
    f"""
SELECT {SCORE_SQL} FROM (SELECT (SELECT count(*) FROM orders_passed) AS passed,
  (SELECT count(*) FROM orders_curated) - (SELECT count(*) FROM orders_passed) AS failed,
  (SELECT count(*) FROM orders_curated) AS total)""",
    "orders_curated orders_passed",
)
def q8(spark, d):
    return quality.quality_score(order_outcomes(spark, d))


@query(
    "q9_expect_warn",
    """
SELECT 'valid_customer_id' AS expectation, count(*) AS rows, count(*) FILTER (customer_id IS NULL) AS violations
FROM orders_raw UNION ALL
SELECT 'known_status', count(*), count(*) FILTER (status IS NULL OR status NOT IN ('F', 'O')) FROM orders_raw""",
    "orders_raw",
)
def q9(spark, d):
    conditions = {"valid_customer_id": "customer_id IS NOT NULL", "known_status": "status IN ('F', 'O')"}
    return quality.expectation_report(orders_raw(spark, d), **conditions)


@query(
    "q10_expect_or_drop",
    """
SELECT customer_id, email FROM (
  SELECT customer_id, lower(trim(email)) AS email FROM customers_raw
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY first_name, last_name, customers_raw.email NULLS FIRST,
    signup_date, city, segment) = 1) WHERE email LIKE '%_@__%.__%'""",
    "customers_raw",
)
def q10(spark, d):
    kept, _ = expected_customers(customers_raw(spark, d))
    return kept.select("customer_id", "email")


@query(
    "q10_dropped_emails",
    "SELECT count(*) AS dropped FROM customers_raw WHERE NOT coalesce(email LIKE '%_@__%.__%', false)",
    "customers_raw",
)
def q10_dropped(spark, d):
    customers = customers_raw(spark, d)
    kept = quality.expect_or_drop(customers, valid_email("email")).agg(F.count(F.lit(1)).alias("kept"))
    return customers.agg(F.count(F.lit(1)).alias("rows")).select((F.col("rows") - kept.scalar()).alias("dropped"))


@query(
    "q11_expect_or_fail",
    """
SELECT order_id, product_id, quantity::BIGINT AS quantity FROM items_raw WHERE quantity > 0
QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY quantity, unit_price, line_total NULLS FIRST) = 1""",
    "items_raw",
)
def q11(spark, d):
    # Bad quantities are dropped first; on the raw items this query would fail its run.
    sound = quality.expect_or_drop(items_raw(spark, d), "quantity > 0")
    return expected_items(sound).select("order_id", "product_id", "quantity")


@query(
    "q11_failed_run",
    """
SELECT 'raw items' AS run, bad > 0 AS failed, CASE WHEN bad > 0 THEN 0 ELSE n END AS rows
FROM (SELECT count(*) AS n, count(*) FILTER (coalesce(quantity, 0) <= 0) AS bad FROM items_raw)
UNION ALL SELECT 'clamped to one', false, count(*) FROM items_raw""",
    "items_raw",
)
def q11_failed(spark, d):
    """All items, written under the expectation: the run fails and leaves nothing. With every
    quantity one or more it goes through."""
    raw = items_raw(spark, d)
    lines = []
    for run, items in (("raw items", raw), ("clamped to one", raw.withColumn("quantity", F.greatest("quantity", F.lit(1))))):
        path = workspace(spark, "expected")
        failed = False
        try:
            quality.expect_or_fail(items, "positive_quantity", "quantity > 0").write.parquet(path)
        except PySparkException as e:
            if "expectation positive_quantity violated" not in str(e):
                raise
            failed = True
        rows = 0 if failed else spark.read.parquet(path).count()
        lines.append((run, failed, rows))
    return spark.createDataFrame(lines, "run string, failed boolean, rows bigint")


@query(
    "q12_dq_metrics",
    f"""
SELECT context, {SCORE_SQL} FROM (
  SELECT '{ORDERS_CHECK}' AS context, (SELECT count(*) FROM orders_passed) AS passed,
    (SELECT count(*) FROM orders_curated) - (SELECT count(*) FROM orders_passed) AS failed,
    (SELECT count(*) FROM orders_curated) AS total
  UNION ALL SELECT '{ITEMS_CHECK}', count(*) FILTER (p.product_id IS NOT NULL),
    count(*) FILTER (p.product_id IS NULL), count(*)
  FROM items_curated i LEFT JOIN products_clean p ON i.product_id = p.product_id)""",
    "orders_curated orders_passed items_curated products_clean",
)
def q12(spark, d):
    path = workspace(spark, "dq_metrics")
    append(quality.dq_metrics(order_outcomes(spark, d), ORDERS_CHECK), path)
    append(quality.dq_metrics(item_outcomes(spark, d), ITEMS_CHECK), path)
    return spark.read.parquet(path)


@query(
    "q14_kpi_alert",
    """
SELECT 'total_processed_orders' AS metric, sum(total_order_count)::DOUBLE AS value, 150::DOUBLE AS threshold,
  sum(total_order_count) < 150 AS triggered FROM gold""",
    "gold",
)
def q14(spark, d):
    return quality.kpi_alert(marts.tile_orders(gold(spark, d)), "total_processed_orders", "<", 150)


@query(
    "q14_kpi_alert_per_region",
    """
SELECT store_region, sum(total_order_count) < 3000 AS triggered FROM gold GROUP BY store_region""",
    "gold",
)
def q14_regions(spark, d):
    per_region = marts.tile_region(gold(spark, d))
    alerts = quality.kpi_alert(per_region, "aggregate_orders", "<", 3000, by=["store_region"])
    return alerts.select("store_region", "triggered")


@query(
    "q2_unique_email",
    """
SELECT customer_id, segment, CASE WHEN count(*) OVER (PARTITION BY email) = 1 THEN 'Passed' ELSE 'Failed' END AS result
FROM customers_raw""",
    "customers_raw",
)
def q2_email(spark, d):
    """All customers without an e-mail fail: null is one value here."""
    outcomes = quality.evaluate_rows(customers_raw(spark, d), [quality.is_unique("email")])
    return outcomes.select("customer_id", "segment", F.col(quality.RESULT).alias("result"))


@query(
    "q5_raw_items_all_rules",
    """
SELECT (product_id IS NOT NULL)::BIGINT + (line_total IS NOT NULL)::BIGINT + (coalesce(quantity > 0, false))::BIGINT
  AS rules_passed, count(*) AS lines FROM items_raw GROUP BY 1""",
    "items_raw",
)
def q5_raw(spark, d):
    rules = [
        quality.is_complete("product_id"),
        quality.is_complete("line_total"),
        quality.column_values("quantity", ">", 0),
    ]
    outcomes = quality.evaluate_rows(items_raw(spark, d), rules)
    return outcomes.groupBy(F.size(quality.PASSED_RULES).alias("rules_passed")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "q9_declared_tables",
    """
SELECT * FROM (
WITH c AS (SELECT * FROM customers_raw QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY first_name NULLS FIRST,
    last_name NULLS FIRST, email NULLS FIRST, signup_date NULLS FIRST, city NULLS FIRST, segment NULLS FIRST) = 1),
  i AS (SELECT * FROM items_raw QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY quantity NULLS FIRST,
    unit_price NULLS FIRST, line_total NULLS FIRST) = 1),
  sound AS (SELECT * FROM items_raw WHERE quantity > 0 QUALIFY row_number() OVER (PARTITION BY order_id, product_id
    ORDER BY quantity NULLS FIRST, unit_price NULLS FIRST, line_total NULLS FIRST) = 1)
SELECT 0::BIGINT AS run, 'silver_customers' AS "table", 'valid_customer_id' AS expectation, 'warn' AS action, count(*) AS rows,
  count(*) FILTER (customer_id IS NULL) AS violations, true AS written,
  count(*) FILTER (lower(trim(email)) LIKE '%_@__%.__%') AS table_rows FROM c
UNION ALL SELECT 0, 'silver_customers', 'valid_email', 'drop', count(*),
  count(*) FILTER (NOT coalesce(lower(trim(email)) LIKE '%_@__%.__%', false)), true,
  count(*) FILTER (lower(trim(email)) LIKE '%_@__%.__%') FROM c
UNION ALL SELECT 0, 'silver_order_items', 'positive_quantity_enforced', 'fail', count(*), 0, true, count(*) FROM sound
UNION ALL SELECT 1, 'silver_customers', 'valid_customer_id', 'warn', count(*),
  count(*) FILTER (customer_id IS NULL), true, count(*) FILTER (lower(trim(email)) LIKE '%_@__%.__%') FROM c
UNION ALL SELECT 1, 'silver_customers', 'valid_email', 'drop', count(*),
  count(*) FILTER (NOT coalesce(lower(trim(email)) LIKE '%_@__%.__%', false)), true,
  count(*) FILTER (lower(trim(email)) LIKE '%_@__%.__%') FROM c
UNION ALL SELECT 1, 'silver_order_items', 'positive_quantity_enforced', 'fail', count(*),
  count(*) FILTER (NOT coalesce(quantity > 0, false)), false, (SELECT count(*) FROM sound) FROM i)""",
    "customers_raw items_raw",
)
def q9_declared(spark, d):
    """Two runs: the second meets items that miss their condition, and their table keeps the
    rows of the first."""
    root = workspace(spark, "declared")
    prefix = f"d{root.rsplit('-', 1)[1]}_"
    customers, items = customers_raw(spark, d), items_raw(spark, d)
    update_tables(spark, silver_tables(), {"customers": customers, "order_items": items.where("quantity > 0")}, prefix, root, 0)
    try:
        update_tables(spark, silver_tables(), {"customers": customers, "order_items": items}, prefix, root, 1)
    except ExpectationFailed:
        pass
    counts = None
    for t in silver_tables():
        line = spark.read.table(prefix + t.name).agg(F.count(F.lit(1)).alias("table_rows")).withColumn("table", F.lit(t.name))
        counts = line if counts is None else counts.unionByName(line)
    return violations(spark, root).join(counts, "table")
