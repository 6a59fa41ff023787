"""Raw files to bronze, silver and gold tables, replaced as a whole on each run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize_email, parse_date, parse_ts, valid_email
from ..operators import marts, quality
from ..operators.rows import dedup
from ..sinks import VersionedTable, describe_table, save_table, save_version, version_feed
from ..sources import read_csv, read_partitioned
from . import schemas as S
from .expectations import Declared

# The gold path declares no discount_code; its orders come without one.
ORDERS_RAW = T.StructType([f for f in S.ORDERS.fields if f.name != "discount_code"])


def load_bronze(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """The raw tables as declared. The directories' ``order_date`` is dropped: on both
    orders and items it would be ambiguous after their join."""
    return {
        "customers": read_csv(spark, f"{raw}/customers", S.CUSTOMERS),
        "products": read_csv(spark, f"{raw}/products", S.PRODUCTS),
        "orders": read_partitioned(spark, f"{raw}/orders", "json", ORDERS_RAW).drop("order_date"),
        "order_items": read_partitioned(spark, f"{raw}/order_items", "json", S.ORDER_ITEMS).drop("order_date"),
    }


def to_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    customers = bronze["customers"].withColumn("signup_date", parse_date("signup_date"))
    orders = bronze["orders"].withColumn("order_ts", parse_ts("order_ts"))
    return {
        "customers": marts.clean_customers(customers),
        "products": marts.clean_products(bronze["products"]),
        "orders": marts.clean_orders(orders),
        "order_items": marts.clean_items(bronze["order_items"]),
    }


# What tells the rows of a silver table apart.
KEYS = {"customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"], "order_items": ["order_id", "product_id"]}


def history(root: str, table: str, buckets: int) -> VersionedTable:
    """The versions of a silver table that :func:`run` keeps."""
    return VersionedTable(f"{root}/history/{table}", KEYS[table], buckets)


def silver_feed(spark: SparkSession, root: str, table: str, old: int, new: int, buckets: int = 64) -> DataFrame:
    """The row changes of a silver table between two runs."""
    return version_feed(spark, history(root, table, buckets), old, new)


def run(spark: SparkSession, raw: str, prefix: str, root: str, version: int | None = None, buckets: int = 64) -> DataFrame:
    """All tiers as tables ``{prefix}bronze_…``, ``silver_…`` and the gold aggregate.

    With a ``version``, counted up from run to run, the silver tables' rows are kept as
    well, in ``buckets`` each, for :func:`silver_feed`.
    """

    def stored(tier: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {n: save_table(df, f"{prefix}{tier}_{n}", f"{root}/{tier}/{n}") for n, df in frames.items()}

    bronze = stored("bronze", load_bronze(spark, raw))
    silver = stored("silver", to_silver(bronze))
    if version is not None:
        for table, df in silver.items():
            # Without its key a row is in no version.
            save_version(df.dropna(subset=KEYS[table]), history(root, table, buckets), version)
    gold = marts.daily_regional_revenue(silver["orders"], silver["order_items"], silver["products"])
    name = f"{prefix}gold_daily_regional_revenue"
    saved = save_table(gold, name, f"{root}/gold/daily_regional_revenue")
    describe_table(spark, name, "Revenue, items and orders per day, category and region.")
    return saved


def expected_customers(bronze_customers: DataFrame) -> tuple[DataFrame, object]:
    """Customers with a well-formed e-mail, and the count of rows without an id.

    The e-mail is tested after it was normalised; padding alone drops no row.
    """
    one_each = dedup(bronze_customers, ["customer_id"], null_keys=True).withColumn("email", normalize_email("email"))
    counted, seen = quality.expect(one_each, valid_customer_id="customer_id IS NOT NULL")
    return quality.expect_or_drop(counted, valid_email("email")), seen


def silver_tables() -> list[Declared]:
    """Customers and items with their expectations, as tables over bronze customers and items."""
    customers = Declared(
        "silver_customers", ["customers"],
        lambda c: dedup(c, ["customer_id"], null_keys=True).withColumn("email", normalize_email("email")),
        "Customers with a well-formed e-mail.", {"quality": "silver"},
        warn={"valid_customer_id": "customer_id IS NOT NULL"}, drop={"valid_email": "email LIKE '%_@__%.__%'"},
    )
    items = Declared(
        "silver_order_items", ["order_items"], lambda i: dedup(i, ["order_id", "product_id"], null_keys=True),
        "Order lines with a positive quantity.", {"quality": "silver"},
        fail={"positive_quantity_enforced": "quantity > 0"},
    )
    return [customers, items]


def expected_items(bronze_items: DataFrame) -> DataFrame:
    """Items, or a failed job if a quantity is not positive."""
    one_each = dedup(bronze_items, ["order_id", "product_id"], null_keys=True)
    return quality.expect_or_fail(one_each, "positive_quantity_enforced", F.col("quantity") > 0)
