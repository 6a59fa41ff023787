"""Curated Parquet to staging, star schema and the views kept on it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, marts
from ..operators.quality import only_passed
from ..session import several_tasks_a_core, side_by_side, small_sides_hashed
from ..sinks import KeptView, apply_sums, by_group, coarser, insert_new, reload_staging, save_table, stored, summed, upsert_partitions, upsert_rows, version_of
from ..sources import read_manifest, read_prefix

# The fact lies in one directory a month: a day's lines are too few for files of their own.
MONTH = "date_month"
ITEM_ID = "order_item_id"


def category_view(root: str) -> KeptView:
    """Revenue and items per day and category, in one directory a month."""
    sums = {"daily_revenue": "line_total", "total_items_sold": "quantity"}
    return KeptView(f"{root}/views/category", ("order_month", "order_date", "product_category"), "order_month", sums)


def regional_view(root: str) -> KeptView:
    """Revenue, items and distinct orders per day, category and region."""
    sums = {"daily_revenue": "line_total", "total_items_sold": "quantity"}
    groups = ("order_month", "order_date", "category", "store_region")
    return KeptView(f"{root}/views/regional", groups, "order_month", sums, {"total_order_count": "order_id"})


def view_lines(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of the views from the fact or from its changes: those whose order has a day and
    whose product is known."""
    return _dated(marts.star(_with_day(fact), (products.select("product_id", "category"), "product_id")))


def _with_day(fact: DataFrame) -> DataFrame:
    day = F.to_date("order_ts")
    return fact.where(day.isNotNull()).withColumn("order_date", day)


def _dated(lines: DataFrame) -> DataFrame:
    return lines.withColumn("order_month", F.trunc("order_date", "month")).withColumn("product_category", F.col("category"))


def line_changes(fact: DataFrame, products: DataFrame, fact_feed: DataFrame, product_feed: DataFrame, fresh: Column | None = None) -> DataFrame:
    """What the changes of the fact and of the products mean for the lines of the views.

    Lines that changed count with the products as they were; then all lines, changed
    or not, of products that changed move from the old category to the new one. Only those
    products' lines are read from the ``fact``, and none if no category changed. Lines that
    came with these changes and are known by ``fresh``, a condition that no other line meets,
    count with the products as they are, once.
    """
    fresh = F.lit(False) if fresh is None else fresh
    came = (F.col("_change_type") == "insert") & fresh
    before = changes.apply_changes(products, changes.reversed_feed(product_feed), ["product_id"])
    moved = product_feed.groupBy("product_id").agg(
        F.max(F.when(F.col("_change_type").isin("delete", "update_preimage"), F.col("category"))).alias("_old"),
        F.max(F.when(F.col("_change_type").isin("insert", "update_postimage"), F.col("category"))).alias("_new"),
        F.count_if(F.col("_change_type").isin("delete", "update_preimage")).alias("_was"),
        F.count_if(F.col("_change_type").isin("insert", "update_postimage")).alias("_is"),
    )
    moved = moved.where(~(F.col("_old").eqNullSafe(F.col("_new")) & (F.col("_was") == F.col("_is"))))
    goes = F.when(F.col("_was") > 0, F.struct(F.lit("delete").alias("_change_type"), F.col("_old").alias("category")))
    comes = F.when(F.col("_is") > 0, F.struct(F.lit("insert").alias("_change_type"), F.col("_new").alias("category")))
    # Written, so that its size is known when it is joined: a few products need no shuffle of the fact.
    moved = stored(moved.select("product_id", F.array_compact(F.array(goes, comes)).alias("_moves")), "moved")
    feed = fact_feed.drop("_commit_version")
    lines = view_lines(feed.where(~came), before).unionByName(view_lines(feed.where(came), products))
    if moved.isEmpty():
        return lines
    both = marts.star(_with_day(fact.where(~fresh)), (moved, "product_id")).select("*", F.inline("_moves")).select(*lines.columns[:-2])
    return lines.unionByName(_dated(both))


def load_curated(spark: SparkSession, prefix: str, root: str, curated: Mapping[str, str], version: int | None = None) -> dict[str, str]:
    """:func:`load_star` from files: for customers, products, orders and items a manifest
    (``….json``) or a folder of Parquet files."""
    frames = {t: read_manifest(spark, p) if p.endswith(".json") else read_prefix(spark, p) for t, p in curated.items()}
    return load_star(spark, prefix, root, frames["customers"], frames["products"], frames["orders"], frames["items"], version)


def load_star(
    spark: SparkSession, prefix: str, root: str, customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame,
    version: int | None = None,
) -> dict[str, str]:
    """Stage the curated frames and fill dimensions and fact; the tables' names.

    ``orders`` carries the quality outcome the fact is filtered by. Staging is
    emptied first. A row replaces the one with its key in dimensions and fact, so changed
    rows arrive and a load that is run again changes nothing; of the fact, only the months
    concerned are written. A line of the fact has a number of its own (``order_item_id``),
    which it keeps.

    With a ``version``, counted up from load to load, the changes are kept, and the category
    and regional views are brought up to date by them. A load that was cut off is repeated
    with its version.
    """
    staged = {"customers": customers, "products": products, "orders": orders, "items": items}
    with several_tasks_a_core(spark):
        return _load(spark, prefix, root, staged, version)


def _stage(df: DataFrame, name: str, path: str) -> None:
    if not df.sparkSession.catalog.tableExists(name):
        save_table(df.limit(0), name, path)
    reload_staging(df, name)


def _load(spark: SparkSession, prefix: str, root: str, staged: Mapping[str, DataFrame], version: int | None) -> dict[str, str]:
    side_by_side(*[partial(_stage, df, f"{prefix}stg_{table}", f"{root}/staging/{table}") for table, df in staged.items()])
    staged = {table: spark.read.table(f"{prefix}stg_{table}") for table in staged}
    month = F.coalesce(F.floor(F.col("date_key") / 100).cast("int"), F.lit(0))
    fact = marts.build_fact(staged["items"], staged["orders"]).withColumn(MONTH, month)
    # The calendar runs over the days of the passed orders: two values read on the driver.
    day = F.to_date("order_ts")
    lo, hi = only_passed(staged["orders"]).agg(F.min(day), F.max(day)).first()
    # Without a passed order there is no day to add.
    days = marts.dim_date(spark, str(lo), str(hi)) if lo else marts.dim_date(spark, "2000-01-01", "2000-01-01").limit(0)
    targets = {
        "dim_customer": (marts.dim_customer(staged["customers"]), ["customer_id"]),
        "dim_product": (marts.dim_product(staged["products"]), ["product_id"]),
        "dim_date": (days, ["date_key"]),
        "fact_order_items": (fact, ["order_id", "product_id"]),
    }
    names = {table: f"{prefix}{table}" for table in targets}

    def fill(table: str, df: DataFrame, keys: list[str]) -> None:
        name, path = names[table], f"{root}/analytics/{table}"
        is_fact = table == "fact_order_items"
        feed = None if version is None else (f"{root}/changes/{table}/{version}", version)
        if not spark.catalog.tableExists(name):
            empty = df.limit(0)
            save_table(empty.withColumn(ITEM_ID, F.lit(None).cast("long")) if is_fact else empty, name, path, [MONTH] if is_fact else ())
        if is_fact:
            upsert_partitions(df, name, path, keys, MONTH, feed, ITEM_ID)
        elif table == "dim_date":
            insert_new(df, name, keys)  # a day does not change
        else:
            upsert_rows(df, name, keys, feed if table == "dim_product" else None)

    side_by_side(*[partial(fill, table, df, keys) for table, (df, keys) in targets.items()])
    if version is not None:
        _keep_views(spark, root, names, version)
    return names


def _keep_views(spark: SparkSession, root: str, names: Mapping[str, str], version: int) -> None:
    """Bring the category and regional views to ``version`` by the changes kept under it."""
    category, regional = category_view(root), regional_view(root)
    if version <= min(version_of(spark, category), version_of(spark, regional)):
        return
    lines, products = (spark.read.parquet(f"{root}/changes/{t}/{version}") for t in ("fact_order_items", "dim_product"))
    # New lines have the numbers from the least on that came with this version.
    first = lines.where("_change_type = 'insert'").agg(F.min(ITEM_ID)).first()[0]
    fresh = F.lit(False) if first is None else F.col(ITEM_ID) >= first
    changed = line_changes(spark.read.table(names["fact_order_items"]), spark.read.table(names["dim_product"]), lines, products, fresh)
    # The lines are joined and summed once: the days' categories are sums over their regions.
    with small_sides_hashed(spark):
        sums = summed(changed, regional)
    groups = by_group(sums, regional)
    days = coarser(groups, regional, category, {"product_category": "category"})
    side_by_side(partial(apply_sums, sums, regional, version, groups), partial(apply_sums, days, category, version))
