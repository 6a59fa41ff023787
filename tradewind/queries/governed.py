"""Masks, tag-based column access and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mask_email, mask_email_strict, mask_for_role
from ..operators import governance, marts
from .registry import query
from .tables import customers_raw, orders_raw

# Tags and grants of the access example.
TABLE = "raw.customers"
TAGS: list[governance.Tag] = [
    ("raw.customers.email", "sensitivity", "PII"),
    ("raw.customers", "sensitivity", "Public"),
    ("raw", "department", "engineering"),
    ("curated", "sensitivity", "Confidential"),
    ("curated", "department", "analytics"),
]
GRANTS = [
    governance.Grant("data_analyst", "sensitivity", "Public"),
    governance.Grant(
        "data_engineer", "department", "engineering", frozenset({"SELECT", "DESCRIBE", "ALTER", "INSERT"})
    ),
]

# DuckDB has no look-behind: with p the place of the last @, keep the first
# character and the rest from p on.
MASK_SQL = """
SELECT customer_id, CASE WHEN email IS NULL THEN NULL WHEN p <= 2 OR NOT contains(email, '@') THEN email
  ELSE left(email, 1) || repeat('*', (p - 2)::BIGINT) || substr(email, p) END AS email
FROM (SELECT customer_id, email, length(email) - strpos(reverse(email), '@') + 1 AS p FROM customers_raw)"""


@query("g1_mask_email", MASK_SQL, "customers_raw")
def g1(spark, d):
    customers = customers_raw(spark, d).select("customer_id", "email")
    return governance.mask_by_group(customers, "email", ["data_readers"], "data_admins")


@query("g1_mask_email_admin", "SELECT customer_id, email FROM customers_raw", "customers_raw")
def g1_admin(spark, d):
    customers = customers_raw(spark, d).select("customer_id", "email")
    return governance.mask_by_group(customers, "email", ["data_admins"], "data_admins")


@query(
    "g1_mask_email_strict",
    """
SELECT customer_id, CASE WHEN email IS NULL THEN NULL WHEN NOT contains(email, '@') THEN repeat('*', length(email))
  ELSE left(email, 1) || repeat('*', (p - 2)::BIGINT) || substr(email, p) END AS email
FROM (SELECT customer_id, email, length(email) - strpos(reverse(email), '@') + 1 AS p FROM customers_raw)""",
    "customers_raw",
)
def g1_strict(spark, d):
    return customers_raw(spark, d).select("customer_id", mask_email_strict("email").alias("email"))


@query(
    "g2_mask_constant",
    "SELECT customer_id, last_name, 'XXXX@XXXX.com' AS email FROM customers_clean",
    "customers_clean",
)
def g2(spark, d):
    customers = marts.clean_customers(customers_raw(spark, d)).select("customer_id", "last_name", "email")
    return governance.mask_constant(customers, "email", ["bi_analyst_role"], "compliance_officer_role")


@query("g2_mask_constant_officer", "SELECT customer_id, last_name, email FROM customers_clean", "customers_clean")
def g2_officer(spark, d):
    customers = marts.clean_customers(customers_raw(spark, d)).select("customer_id", "last_name", "email")
    return governance.mask_constant(customers, "email", ["compliance_officer_role"], "compliance_officer_role")


@query(
    "g2_mask_by_row_role",
    """
SELECT customer_id, CASE WHEN segment = 'MACHINERY' THEN email ELSE 'XXXX@XXXX.com' END AS email FROM customers_raw""",
    "customers_raw",
)
def g2_row(spark, d):
    """The reader is entitled to one segment only: the role test is a column."""
    shown = mask_for_role("email", F.col("segment") == "MACHINERY")
    return customers_raw(spark, d).select("customer_id", shown.alias("email"))


@query(
    "g3_secure_select_analyst",
    """
SELECT customer_id, first_name, last_name, strftime(signup_date, '%Y-%m-%d') AS signup_date, city, segment
FROM customers_raw""",
    "customers_raw",
)
def g3_analyst(spark, d):
    return governance.secure_select(customers_raw(spark, d), TABLE, TAGS, GRANTS, "data_analyst", deny="omit")


@query(
    "g3_secure_select_engineer",
    "SELECT customer_id, first_name, last_name, email, city FROM customers_raw",
    "customers_raw",
)
def g3_engineer(spark, d):
    cols = ["customer_id", "first_name", "last_name", "email", "city"]
    return governance.secure_select(customers_raw(spark, d), TABLE, TAGS, GRANTS, "data_engineer", cols)


@query(
    "g4_row_filter",
    "SELECT order_id, store_region, status FROM orders_raw WHERE store_region = 'north'",
    "orders_raw",
)
def g4(spark, d):
    seen = governance.row_filter(orders_raw(spark, d), F.col("store_region") == "north")
    return seen.select("order_id", "store_region", "status")


@query("f1_mask_function", MASK_SQL, "customers_raw")
def f1(spark, d):
    name = governance.create_mask_function(spark)
    return customers_raw(spark, d).selectExpr("customer_id", f"{name}(email, false) AS email")


@query(
    "f2_masked_view",
    f"SELECT m.customer_id, m.email, 'XXXX@XXXX.com' AS last_name FROM ({MASK_SQL.strip()}) m",
    "customers_raw",
)
def f2(spark, d):
    customers = customers_raw(spark, d).select("customer_id", "email", "last_name")
    masks = {"email": mask_email, "last_name": lambda c: mask_for_role(c, False)}
    return governance.masked_view(spark, customers, "customers_masked", masks)
