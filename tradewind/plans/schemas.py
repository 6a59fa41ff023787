"""Declared schemas of the raw tables, and the types silver is cast to."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _table(columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, columns.split(","))])


# Names, order and types of the raw files' columns. Times are text until they
# are parsed.
CUSTOMERS = _table(
    "customer_id bigint, first_name string, last_name string, email string, signup_date string, city string, segment string"
)
PRODUCTS = _table("product_id string, product_name string, category string, unit_price double, active_flag boolean")
ORDERS = _table(
    "order_id string, customer_id bigint, order_ts string, store_region string, status string, discount_code string"
)
ORDER_ITEMS = _table("order_id string, product_id string, quantity int, unit_price double, line_total double")
CLICKSTREAM = _table(
    "session_id string, customer_id bigint, event_type string, page_url string, event_ts string, device_type string"
)


def _silver(raw: T.StructType, **working: str) -> list[tuple[str, str]]:
    """The columns of ``raw`` with their types, but for those of ``working``."""
    return [(f.name, working.get(f.name, f.dataType.simpleString())) for f in raw]


CUSTOMERS_SILVER = _silver(CUSTOMERS, signup_date="date")
PRODUCTS_SILVER = _silver(PRODUCTS)
ORDERS_SILVER = _silver(ORDERS, order_ts="timestamp")
ORDER_ITEMS_SILVER = _silver(ORDER_ITEMS)
