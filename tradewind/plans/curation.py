"""Raw files to curated tables, quarantine and daily revenue, run by run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize_email, order_day
from ..operators import marts, quality
from ..operators.joins import split_join
from ..operators.rows import dedup, fill_defaults, latest_by, require_keys, safe_select
from ..sinks import overwrite_partitions, replace_partitions, stored
from ..sources import read_reference
from ..sources.fs import exists
from ..streaming import Source, run_incremental
from ..streaming.incremental import RUN
from . import schemas as S

# The reasons quarantined rows carry and the names of the checks.
ORDERS_REASON = "failed_orders_completeness_or_uniqueness"
ITEMS_REASON = "failed_completeness_or_referential_integrity"
ORDERS_CHECK = "orders_dq_check"
ITEMS_CHECK = "order_items_dq_check"


@dataclass(frozen=True)
class Layout:
    """Where the job reads and writes.

    Curated orders, current orders and daily revenue lie in one directory per ``grain``: ``day``,
    or ``month`` or ``year`` where a day is too little for a file of its own.
    """

    raw: str
    root: str
    grain: str = "day"

    @property
    def period(self) -> str:
        return "order_date" if self.grain == "day" else f"order_{self.grain}"

    def with_period(self, df: DataFrame) -> DataFrame:
        return df if self.grain == "day" else df.withColumn(self.period, F.trunc("order_date", self.grain))

    def raw_table(self, name: str) -> str:
        return f"{self.raw}/{name}"

    def curated(self, name: str) -> str:
        return f"{self.root}/curated/{name}"

    def current(self, name: str) -> str:
        return f"{self.root}/current/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    @property
    def daily_revenue(self) -> str:
        return f"{self.root}/consumption/daily_revenue"

    @property
    def metrics(self) -> str:
        return f"{self.root}/control/dq_metrics"


def order_rules() -> list[quality.Rule]:
    # The columns and bounds of the orders gate.
    complete = [quality.is_complete(c) for c in ("order_id", "customer_id", "status", "order_total", "order_date")]
    return [*complete, quality.is_unique("order_id"), quality.column_values("order_total", ">=", 0)]


def item_rules(products: DataFrame) -> list[quality.Rule]:
    # The columns of the items gate.
    complete = [quality.is_complete(c) for c in ("order_id", "product_id", "quantity", "line_total")]
    return [*complete, quality.referential("product_id", products, "product_id", "products_ref")]


def curate_items(raw: DataFrame) -> DataFrame:
    """Typed items, total 0 where absent, one row per (order, product)."""
    typed = fill_defaults(safe_select(raw, S.ORDER_ITEMS_SILVER), {"line_total": 0.0})
    return dedup(require_keys(typed, ["order_id", "product_id"]), ["order_id", "product_id"])


def curate_orders(raw: DataFrame, items: DataFrame) -> DataFrame:
    """Typed orders with their day and total, the latest row per order."""
    typed = safe_select(raw, S.ORDERS_SILVER).withColumn("order_date", order_day("order_ts"))
    latest = latest_by(typed, ["order_id"], [F.col("order_date").desc_nulls_last()])
    return marts.with_order_total(latest, items)


def curate_customers(raw: DataFrame) -> DataFrame:
    typed = safe_select(raw, S.CUSTOMERS_SILVER)
    latest = latest_by(typed, ["customer_id"], [F.col("signup_date").desc_nulls_last()])
    return latest.withColumn("email", normalize_email("email"))


def curate_products(raw: DataFrame) -> DataFrame:
    return dedup(safe_select(raw, S.PRODUCTS_SILVER), ["product_id"])


def sources(layout: Layout) -> list[Source]:
    # A header in another order than the schema stops the run instead of mixing columns.
    header = {"header": "true", "enforceSchema": "false"}
    return [
        Source("orders", layout.raw_table("orders"), S.ORDERS),
        Source("order_items", layout.raw_table("order_items"), S.ORDER_ITEMS),
        Source("customers", layout.raw_table("customers"), S.CUSTOMERS, "csv", header),
        Source("products", layout.raw_table("products"), S.PRODUCTS, "csv", header),
    ]


def run(spark: SparkSession, layout: Layout) -> int | None:
    """Curate all files that arrived since the last run; the run's number or None."""

    def step(frames: Mapping[str, DataFrame], number: int) -> None:
        curate(spark, layout, frames, number)

    return run_incremental(spark, sources(layout), layout.root, step)


def curate(spark: SparkSession, layout: Layout, frames: Mapping[str, DataFrame], number: int) -> None:
    """One run's rows through both gates. Every output is a partition ``run_id=number``
    that a repeated run overwrites."""

    def tagged(df: DataFrame) -> DataFrame:
        return df.withColumn(RUN, F.lit(number))

    # Items feed the order totals and their own gate, orders a count and a join, outcomes
    # two sinks and a score: each is written once.
    items = stored(curate_items(frames["order_items"]), "items")
    orders = stored(curate_orders(frames["orders"], items), "orders")
    orders = stored(quality.evaluate_rows(orders, order_rules()), "order-outcomes")
    passed, failed = (layout.with_period(df) for df in quality.split_quarantine(orders, ORDERS_REASON))
    overwrite_partitions(tagged(passed), layout.curated("orders"), layout.period, RUN)
    overwrite_partitions(tagged(failed), layout.quarantine("orders"), layout.period, RUN)
    refresh_daily_revenue(spark, layout, tagged(passed))

    products = curate_products(read_reference(spark, layout.raw_table("products"), S.PRODUCTS))
    item_outcomes = stored(quality.evaluate_rows(items, item_rules(products)), "item-outcomes")
    passed_items, failed_items = quality.split_quarantine(item_outcomes, ITEMS_REASON)
    overwrite_partitions(tagged(passed_items), layout.curated("order_items"), RUN)
    overwrite_partitions(tagged(failed_items), layout.quarantine("order_items"), RUN)

    overwrite_partitions(tagged(curate_customers(frames["customers"])), layout.curated("customers"), RUN)
    overwrite_partitions(tagged(curate_products(frames["products"])), layout.curated("products"), RUN)

    metrics = quality.dq_metrics(orders, ORDERS_CHECK).unionByName(quality.dq_metrics(item_outcomes, ITEMS_CHECK))
    overwrite_partitions(tagged(metrics), layout.metrics, RUN)


def latest_orders(orders: DataFrame) -> DataFrame:
    """One row per order over all runs: the latest day, then the latest run."""
    return latest_by(orders, ["order_id"], [F.col("order_date").desc_nulls_last(), F.col(RUN).desc()])


def current_customers(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per customer over all runs: the latest sign-up, then the latest run."""
    rows = spark.read.parquet(layout.curated("customers"))
    return latest_by(rows, ["customer_id"], [F.col("signup_date").desc_nulls_last(), F.col(RUN).desc()])


def refresh_daily_revenue(spark: SparkSession, layout: Layout, passed: DataFrame) -> None:
    """Bring current orders and daily revenue up to date with one run's ``passed`` orders.

    An order that came before counts once, with its latest row; the periods of all rows
    it ever had are computed again, from the current orders of these periods. The others
    stay as they are. Curated orders keep every run's rows, so a repeated run finds the
    same periods.
    """
    if passed.isEmpty():
        return
    period, path = layout.period, layout.current("orders")
    history = spark.read.schema(passed.schema).parquet(layout.curated("orders"))
    if exists(spark, f"{path}/_SUCCESS"):
        known = spark.read.schema(passed.schema).parquet(path)
        again = split_join(history.select("order_id", period), passed.select("order_id"), "order_id", "left_semi")
        touched = stored(again.select(period).distinct(), "periods")
        lo, hi = touched.agg(F.min(period), F.max(period)).first()
        known = split_join(known.where(F.col(period).between(lo, hi)), touched, period, "left_semi")
        rows = stored(latest_orders(known.unionByName(passed)), "current")
        replace_partitions(rows, path, period, touched)
    else:
        touched = history.select(period).distinct()
        rows = latest_orders(history)
        rows.hint("rebalance", period).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(period).parquet(path)
        rows = spark.read.schema(passed.schema).parquet(path)
    # A day's total grows with the orders: it has room beyond the single amounts' digits.
    exact = marts.daily_revenue(rows).withColumn("total_revenue", F.col("total_revenue").cast("decimal(38,2)"))
    replace_partitions(stored(layout.with_period(exact), "revenue"), layout.daily_revenue, period, touched)
