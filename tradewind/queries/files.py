"""Sources and sinks. Each query writes the tables as raw files of some layout to a
fresh place below the shared folder and reads them back through the operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks, sources
from ..operators import changes, marts
from ..plans import schemas as S
from ..plans import lakehouse, warehouse
from ..session import workspace
from ..sources.fs import rename_into
from .cleaning import items_curated, order_outcomes
from .marts import GOLD_SQL, gold
from .registry import query
from .tables import clicks_raw, customers_raw, items_raw, orders_raw, products_raw

CLICKS = "event_id bigint, customer_id bigint, event_type string, event_ts timestamp, value decimal(10,2)"
CLICKS_BY_DAY = f"{CLICKS}, event_date date"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def write_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    """With a header, blanks kept, empty text written as nothing."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    df.write.mode(mode).option("header", True).options(**kept).csv(path)
    return path


def clicks_by_day(spark: SparkSession, d: str, label: str) -> str:
    """The clicks as Parquet below event_date=… directories; the root of them."""
    root = workspace(spark, label)
    sinks.append_partitioned(clicks_raw(spark, d), root, "event_date")
    return root


def orders_text(spark: SparkSession, d: str) -> DataFrame:
    return orders_raw(spark, d).withColumn("order_ts", F.date_format("order_ts", ISO))


# --- sources ----------------------------------------------------------------


@query(
    "s1_csv_scan",
    """
SELECT customer_id, first_name, last_name, nullif(email, '') AS email,
  strftime(signup_date, '%Y-%m-%d') AS signup_date, city, segment FROM customers_raw""",
    "customers_raw",
)
def s1(spark, d):
    path = write_csv(customers_raw(spark, d), workspace(spark, "csv"))
    return sources.read_csv(spark, path, S.CUSTOMERS)


@query(
    "s2_jsonl_scan",
    """
SELECT order_id, customer_id, strftime(order_ts, '%Y-%m-%dT%H:%M:%SZ') AS order_ts, store_region, status, discount_code
FROM orders_raw""",
    "orders_raw",
)
def s2(spark, d):
    path = workspace(spark, "jsonl")
    orders_text(spark, d).write.json(path)
    return sources.read_jsonl(spark, path, S.ORDERS)


@query(
    "s2_jsonl_scan_inferred",
    """
SELECT event_id, customer_id, event_type, strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, value::DOUBLE AS value,
  strftime(event_date, '%Y-%m-%d') AS event_date FROM clicks_raw""",
    "clicks_raw",
)
def s2_inferred(spark, d):
    path = workspace(spark, "jsonl")
    clicks = clicks_raw(spark, d).withColumn("event_ts", F.date_format("event_ts", ISO))
    clicks.write.json(path)
    return sources.read_jsonl(spark, path)


@query(
    "s3_partitioned_scan",
    """
SELECT event_id, customer_id, event_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, value::DOUBLE AS value,
  strftime(event_date, '%Y-%m-%d') AS event_date FROM clicks_raw""",
    "clicks_raw",
)
def s3(spark, d):
    root = workspace(spark, "by_day")
    by_day = clicks_raw(spark, d).hint("rebalance", "event_date")
    # Spark's JSON writer rounds times to milliseconds unless told otherwise.
    fmt = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    by_day.write.options(**fmt).partitionBy("event_date").json(root)
    return sources.read_partitioned(spark, root, "json", CLICKS, **fmt)


@query(
    "s4_merged_schema",
    """
SELECT order_id, customer_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS order_ts, store_region, status,
  CASE WHEN order_ts < TIMESTAMP '1998-06-01' THEN NULL ELSE discount_code END AS discount_code FROM orders_raw""",
    "orders_raw",
)
def s4(spark, d):
    """Files of older orders lack a column; orders without a date come with the newer ones."""
    path = workspace(spark, "merged")
    orders = orders_raw(spark, d)
    older = "coalesce(order_ts < timestamp'1998-06-01', false)"
    sinks.append(orders.where(older).drop("discount_code"), path)
    sinks.append(orders.where(f"NOT {older}"), path)
    return sources.read_merged(spark, path)


@query(
    "s5_schema_drift",
    """
SELECT * FROM (VALUES ('customer_id', 'string', 'bigint', 'retyped'), ('discount_code', NULL, 'string', 'added'),
  ('channel', 'string', NULL, 'removed')) v("column", declared, found, change)
WHERE (SELECT count(discount_code) > 0 AND count(customer_id) > 0 FROM orders_raw)""",
    "orders_raw",
)
def s5(spark, d):
    path = workspace(spark, "drift")
    orders_text(spark, d).write.json(path)
    declared = "order_id string, customer_id string, order_ts string, store_region string, status string, channel string"
    return sources.schema_drift(sources.read_jsonl(spark, path), declared)


@query(
    "s7_reference_scan",
    "SELECT product_id, product_name, category, unit_price::DOUBLE AS unit_price, active_flag FROM products_raw",
    "products_raw",
)
def s7(spark, d):
    path = write_csv(products_raw(spark, d), workspace(spark, "reference"))
    return sources.read_reference(
        spark, path, "product_id bigint, product_name string, category string, unit_price double, active_flag boolean"
    )


@query("s9_manifest_load", GOLD_SQL, "gold")
def s9(spark, d):
    manifest = sinks.publish_snapshot(gold(spark, d), workspace(spark, "manifest"))
    return sources.read_manifest(spark, manifest)


@query(
    "s9_manifest_check",
    "SELECT 'ok' AS status, true AS mandatory, count(*) > 0 AS files FROM clicks_raw",
    "clicks_raw",
)
def s9_check(spark, d):
    manifest = sinks.publish_snapshot(clicks_raw(spark, d), workspace(spark, "manifest"))
    checked = sources.manifest_check(spark, manifest)
    return checked.groupBy("status", "mandatory").agg((F.count(F.lit(1)) > 0).alias("files"))


@query(
    "s10_prefix_load",
    """
SELECT customer_id, first_name, last_name, email, strftime(signup_date, '%Y-%m-%d') AS signup_date, city, segment
FROM customers_raw""",
    "customers_raw",
)
def s10(spark, d):
    path = workspace(spark, "prefix")
    sinks.append(customers_raw(spark, d), path)
    return sources.read_prefix(spark, path)


@query(
    "s11_external_table",
    """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, sum(value)::DOUBLE AS total_value FROM clicks_raw GROUP BY 1""",
    "clicks_raw",
)
def s11(spark, d):
    root = workspace(spark, "external")
    name = f"ext_daily_{root.rsplit('-', 1)[1]}"
    per_day = clicks_raw(spark, d).groupBy("event_date").agg(F.sum("value").cast("decimal(12,2)").alias("total_value"))
    sinks.overwrite_partitions(per_day, root, "event_date")
    schema = "total_value decimal(12,2), event_date date"
    return sources.register_external(spark, name, root, schema, ["event_date"])


RANGE_SQL = """
SELECT event_id, event_type, strftime(event_date, '%Y-%m-%d') AS event_date FROM clicks_raw
WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"""


@query("s12_pruned_scan", RANGE_SQL + " AND event_type = 'purchase' ORDER BY event_id", "clicks_raw")
def s12(spark, d):
    root = clicks_by_day(spark, d, "pruned")
    clicks = sources.read_partitioned(spark, root, "parquet", CLICKS_BY_DAY)
    found = sources.pruned_scan(
        clicks, "event_date", "2024-01-10", "2024-01-12", "event_type = 'purchase'", ["event_id"]
    )
    return found.select("event_id", "event_type", "event_date")


@query(
    "s12_unpruned_scan",
    """
SELECT event_id, event_type, strftime(event_date, '%Y-%m-%d') AS event_date FROM clicks_raw
WHERE event_type = 'purchase' ORDER BY event_id""",
    "clicks_raw",
)
def s12_unpruned(spark, d):
    """The same condition and order without a range: every directory is read."""
    root = clicks_by_day(spark, d, "unpruned")
    clicks = sources.read_partitioned(spark, root, "parquet", CLICKS_BY_DAY)
    return clicks.where("event_type = 'purchase'").select("event_id", "event_type", "event_date").orderBy("event_id")


@query("s13_projected_scan", RANGE_SQL.replace("2024-01-12", "2024-02-12"), "clicks_raw")
def s13(spark, d):
    root = clicks_by_day(spark, d, "projected")
    found = sources.projected_scan(spark, root, "event_date", "2024-01-10", "2024-02-12", CLICKS_BY_DAY)
    return found.select("event_id", "event_type", "event_date")


@query(
    "s13b_partition_gaps",
    """
SELECT strftime(day, '%Y-%m-%d') AS event_date
FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-10', INTERVAL 1 DAY)) AS day)
WHERE day NOT IN (SELECT event_date FROM clicks_raw)""",
    "clicks_raw",
)
def s13b(spark, d):
    return sources.partition_gaps(clicks_raw(spark, d), "event_date", "2023-12-25", "2024-02-10")


@query("s14_read_table", "SELECT store_region, count(*) AS orders FROM orders_clean GROUP BY 1", "orders_clean")
def s14(spark, d):
    root = workspace(spark, "table")
    name = f"orders_{root.rsplit('-', 1)[1]}"
    sinks.save_table(marts.clean_orders(orders_raw(spark, d)), name, root)
    return sources.read_table(spark, name).groupBy("store_region").agg(F.count(F.lit(1)).alias("orders"))


CHANGE_SQL = """
SELECT 'delete' AS _change_type, customer_id, email, 2::BIGINT AS _commit_version
FROM customers_clean WHERE customer_id % 10 = 3
UNION ALL SELECT 'update_preimage', customer_id, email, 2 FROM customers_clean WHERE customer_id % 10 = 4
UNION ALL SELECT 'update_postimage', customer_id, 'new.' || coalesce(email, ''), 2 FROM customers_clean
  WHERE customer_id % 10 = 4
UNION ALL SELECT 'insert', customer_id + 1000000000000, email, 2 FROM customers_clean WHERE customer_id % 10 = 5"""


def _two_versions(spark, d):
    old = marts.clean_customers(customers_raw(spark, d)).select("customer_id", "email", "segment")
    changed = F.when(F.col("customer_id") % 10 == 4, F.concat(F.lit("new."), F.coalesce("email", F.lit(""))))
    kept = old.where("customer_id % 10 <> 3").withColumn("email", F.coalesce(changed, "email"))
    come = old.where("customer_id % 10 = 5").withColumn("customer_id", F.col("customer_id") + 1000000000000)
    return old, kept.unionByName(come)


@query("s15_change_feed", CHANGE_SQL, "customers_clean")
def s15(spark, d):
    feed = changes.change_feed(*_two_versions(spark, d), ["customer_id"], 2)
    return feed.select("_change_type", "customer_id", "email", "_commit_version")


@query(
    "s15_apply_changes",
    """
SELECT customer_id, CASE WHEN customer_id % 10 = 4 THEN 'new.' || coalesce(email, '') ELSE email END AS email
FROM customers_clean WHERE customer_id % 10 <> 3
UNION ALL SELECT customer_id + 1000000000000, email FROM customers_clean WHERE customer_id % 10 = 5""",
    "customers_clean",
)
def s15_apply(spark, d):
    old, new = _two_versions(spark, d)
    feed = changes.change_feed(old, new, ["customer_id"], 2)
    return changes.apply_changes(old, feed, ["customer_id"]).select("customer_id", "email")


@query(
    "s16_file_inventory",
    """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS rows, true AS has_bytes FROM clicks_raw GROUP BY 1""",
    "clicks_raw",
)
def s16(spark, d):
    root = clicks_by_day(spark, d, "inventory")
    files = sources.file_inventory(sources.read_partitioned(spark, root, "parquet", CLICKS_BY_DAY))
    day = F.regexp_extract("file_path", "event_date=([^/]+)", 1)
    return files.groupBy(day.alias("event_date")).agg(
        F.sum("rows").alias("rows"), (F.min("file_size") > 0).alias("has_bytes")
    )


@query(
    "s16b_scan_cost",
    """
SELECT 'unpruned' AS scan, count(*) AS rows, false AS fewer_bytes FROM clicks_raw UNION ALL
SELECT 'pruned', count(*), true FROM clicks_raw WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "clicks_raw",
)
def s16b(spark, d):
    root = clicks_by_day(spark, d, "cost")
    clicks = sources.read_partitioned(spark, root, "parquet", CLICKS_BY_DAY)
    full = sources.scan_cost(clicks)
    part = sources.scan_cost(sources.pruned_scan(clicks, "event_date", "2024-01-10", "2024-01-12"))
    both = full.withColumn("scan", F.lit("unpruned")).unionByName(part.withColumn("scan", F.lit("pruned")))
    fewer = F.col("bytes") < full.select("bytes").scalar()
    return both.select("scan", "rows", fewer.alias("fewer_bytes"))


@query(
    "s17_landing",
    """
SELECT CASE WHEN day(event_date) <> 13 THEN strftime(event_date, '%Y-%m-%d') END AS date, count(*) AS rows,
  CASE WHEN day(event_date) <> 13 THEN strftime(event_date, 'clicks_%Y%m%d') ELSE 'clicks_undated' END AS file
FROM clicks_raw GROUP BY ALL""",
    "clicks_raw",
)
def s17(spark, d):
    """One file set per day, the day only in the files' names; the 13th has none."""
    root = workspace(spark, "landing")
    clicks = clicks_raw(spark, d).withColumn("value", F.col("value").cast("double"))
    day = F.when(F.dayofmonth("event_date") == 13, "undated").otherwise(F.date_format("event_date", "yyyyMMdd"))
    clicks.withColumn("name", day).drop("event_date").hint("rebalance", "name").write.partitionBy("name").json(
        f"{root}/days"
    )
    rename_into(
        spark,
        f"{root}/days/name=*/*.json",
        f"{root}/named",
        lambda path, i: f"clicks_{path.split('name=')[1].split('/')[0]}_{i}.json",
    )
    raw = sources.read_jsonl(spark, f"{root}/named", "event_id bigint, event_type string, value double")
    landed, rejects = sources.land_by_filename_date(raw, f"{root}/landed")
    both = landed.unionByName(rejects, allowMissingColumns=True)
    name = F.regexp_extract("source_file", "^(clicks_[a-z0-9]+)_", 1)
    return both.groupBy("date", name.alias("file")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "s18_load_errors",
    """
SELECT reason, count(*) AS records FROM (SELECT CASE (l_orderkey + l_linenumber) % 40 WHEN 0 THEN 'bad value in quantity'
  WHEN 1 THEN 'bad value in quantity, unit_price' WHEN 2 THEN 'malformed record, expected 5 columns' END AS reason
  FROM lineitem) WHERE reason IS NOT NULL GROUP BY reason""",
)
def s18(spark, d):
    path = workspace(spark, "errors")
    lines = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr(
        "concat_ws(',', l_orderkey, l_partkey, CASE WHEN (l_orderkey + l_linenumber) % 40 IN (0, 1) THEN 'many'"
        " ELSE cast(cast(l_quantity AS int) AS string) END, CASE WHEN (l_orderkey + l_linenumber) % 40 = 1 THEN 'dear'"
        " ELSE cast(l_extendedprice AS string) END,"
        " CASE WHEN (l_orderkey + l_linenumber) % 40 = 2 THEN '1.0,surplus' ELSE '1.0' END) AS value"
    )
    lines.write.text(path)
    schema = "order_id string, product_id string, quantity int, unit_price double, line_total double"
    errors = sources.load_errors(spark, path, schema, n=None, header=False)
    return errors.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@query(
    "s18_parquet_audit",
    """
SELECT * FROM (WITH f AS (SELECT CASE WHEN order_id::BIGINT % 40 = 0 THEN 'retyped' WHEN order_id::BIGINT % 40 = 1 THEN 'short' ELSE 'good' END AS kind,
  count(*) AS rows FROM items_raw GROUP BY 1)
SELECT "column", declared, found, status, sum(rows)::BIGINT AS rows FROM (
  SELECT c."column", c.declared, c.declared AS found, 'ok' AS status, rows FROM f, (VALUES ('order_id', 'string'), ('product_id', 'bigint'),
    ('quantity', 'int'), ('unit_price', 'decimal(10,2)'), ('line_total', 'decimal(12,2)')) c("column", declared)
    WHERE NOT (kind = 'retyped' AND c."column" = 'quantity') AND NOT (kind = 'short' AND c."column" = 'line_total')
  UNION ALL SELECT 'quantity', 'int', 'string', 'other_type', rows FROM f WHERE kind = 'retyped'
  UNION ALL SELECT 'line_total', 'decimal(12,2)', NULL, 'missing', rows FROM f WHERE kind = 'short'
  UNION ALL SELECT 'note', NULL, 'string', 'undeclared', rows FROM f WHERE kind = 'short')
GROUP BY ALL)""",
    "items_raw",
)
def s18_parquet(spark, d):
    """Some files have a column of another type, some lack one and have one more."""
    path = workspace(spark, "audit")
    items = items_raw(spark, d)
    key = F.col("order_id").cast("bigint") % 40
    sinks.append(items.where(key == 0).withColumn("quantity", F.col("quantity").cast("string")), path)
    sinks.append(items.where(key == 1).drop("line_total").withColumn("note", F.lit("x")), path)
    sinks.append(items.where(key > 1), path)
    audit = sources.parquet_type_audit(spark, path, items.schema)
    return audit.groupBy("column", "declared", "found", "status").agg(F.sum("rows").alias("rows")).where("rows > 0")


# --- sinks ------------------------------------------------------------------


@query(
    "k1_append_partitioned",
    "SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS rows FROM clicks_raw GROUP BY 1",
    "clicks_raw",
)
def k1(spark, d):
    root = workspace(spark, "append")
    clicks = clicks_raw(spark, d)
    sinks.append_partitioned(clicks.where("event_id % 2 = 0"), root, "event_date")
    sinks.append_partitioned(clicks.where("event_id % 2 = 1"), root, "event_date")
    stored = sources.read_partitioned(spark, root, "parquet", CLICKS_BY_DAY)
    return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


@query("k2_append", "SELECT store_region, count(*) * 2 AS rows FROM orders_clean GROUP BY 1", "orders_clean")
def k2(spark, d):
    path = workspace(spark, "append")
    orders = marts.clean_orders(orders_raw(spark, d))
    sinks.append(orders, path)
    sinks.append(orders, path)
    return spark.read.schema(orders.schema).parquet(path).groupBy("store_region").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "k3_overwrite_partitions",
    """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date,
  (CASE WHEN day(event_date) > 20 THEN 2 ELSE 1 END * sum(value))::DOUBLE AS total_value
FROM clicks_raw GROUP BY event_date""",
    "clicks_raw",
)
def k3(spark, d):
    """The days after the 20th are written again with doubled values; the others stay."""
    root = workspace(spark, "overwrite")
    per_day = clicks_raw(spark, d).groupBy("event_date").agg(F.sum("value").cast("decimal(14,2)").alias("total_value"))
    sinks.overwrite_partitions(per_day, root, "event_date")
    late = per_day.where(F.dayofmonth("event_date") > 20)
    doubled = late.withColumn("total_value", (F.col("total_value") * 2).cast("decimal(14,2)"))
    sinks.overwrite_partitions(doubled, root, "event_date")
    return spark.read.schema("total_value decimal(14,2), event_date date").parquet(root)


@query("k4_save_table", GOLD_SQL, "gold")
def k4(spark, d):
    root = workspace(spark, "gold")
    return sinks.save_table(gold(spark, d), f"gold_{root.rsplit('-', 1)[1]}", root)


@query(
    "k6_reload_staging",
    "SELECT product_id, category, unit_price::DOUBLE AS unit_price FROM products_clean WHERE active_flag",
    "products_clean",
)
def k6(spark, d):
    """Loaded twice; only the second load is left."""
    root = workspace(spark, "staging")
    name = f"stg_products_{root.rsplit('-', 1)[1]}"
    products = marts.clean_products(products_raw(spark, d)).select("product_id", "category", "unit_price", "active_flag")
    sinks.save_table(products, name, root)
    sinks.reload_staging(products.where("active_flag"), name)
    return spark.read.table(name).drop("active_flag")


@query(
    "k7_load_star",
    """
SELECT 'fact_order_items' AS "table", count(*) AS rows, sum(line_total)::DOUBLE AS amount FROM fact UNION ALL
SELECT 'dim_customer', count(*), NULL FROM customers_clean UNION ALL
SELECT 'dim_product', count(*), sum(unit_price)::DOUBLE FROM products_clean UNION ALL
SELECT 'dim_date', date_diff('day', min(order_ts), max(order_ts)) + 1, NULL FROM orders_passed""",
    "fact customers_clean products_clean orders_passed",
)
def k7(spark, d):
    """Loaded twice; the second load finds every key there already."""
    root = workspace(spark, "warehouse")
    # The items make up the lines and the order totals of both loads, the orders' outcomes
    # the fact of both: each is written once.
    items = sinks.stored(items_curated(spark, d), "items")
    orders = sinks.stored(order_outcomes(spark, d, items), "order-outcomes")
    frames = (marts.clean_customers(customers_raw(spark, d)), marts.clean_products(products_raw(spark, d)), orders, items)
    for _ in range(2):
        names = warehouse.load_star(spark, f"w{root.rsplit('-', 1)[1]}_", root, *frames)
    amounts = {"fact_order_items": F.sum("line_total"), "dim_product": F.sum("unit_price")}
    out = None
    for table, name in names.items():
        amount = amounts.get(table, F.lit(None)).cast("double").alias("amount")
        line = spark.read.table(name).agg(F.count(F.lit(1)).alias("rows"), amount).withColumn("table", F.lit(table))
        out = line if out is None else out.unionByName(line)
    return out


@query(
    "k8_refresh_view",
    """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, event_type, count(DISTINCT customer_id) AS customers,
  sum(value)::DOUBLE AS total_value FROM clicks_raw GROUP BY ALL""",
    "clicks_raw",
)
def k8(spark, d):
    """The view is built without every third event of two days, then refreshed for those."""
    root = workspace(spark, "view")
    clicks = clicks_raw(spark, d)
    late = F.col("event_date").between("2024-01-10", "2024-01-11") & (F.col("event_id") % 3 == 0)

    def aggregate(df: DataFrame) -> DataFrame:
        return df.groupBy("event_date", "event_type").agg(
            F.countDistinct("customer_id").alias("customers"), F.sum("value").cast("decimal(14,2)").alias("total_value")
        )

    first = aggregate(clicks.where(~late))
    sinks.overwrite_partitions(first, root, "event_date")
    sinks.refresh_view(root, clicks, clicks.where(late), aggregate, "event_date", "event_date")
    return spark.read.schema(first.schema).parquet(root)


@query(
    "k8_refresh_after_delete",
    """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, event_type, count(DISTINCT customer_id) AS customers
FROM clicks_raw WHERE event_date NOT BETWEEN '2024-01-10' AND '2024-01-11' GROUP BY ALL""",
    "clicks_raw",
)
def k8_after_delete(spark, d):
    """Two days' clicks are deleted from the base; their groups leave the view."""
    root = workspace(spark, "view")
    clicks = clicks_raw(spark, d)
    gone = F.col("event_date").between("2024-01-10", "2024-01-11")

    def aggregate(df: DataFrame) -> DataFrame:
        return df.groupBy("event_date", "event_type").agg(F.countDistinct("customer_id").alias("customers"))

    first = aggregate(clicks)
    sinks.overwrite_partitions(first, root, "event_date")
    sinks.refresh_view(root, clicks.where(~gone), clicks.where(gone), aggregate, "event_date", "event_date")
    return spark.read.schema(first.schema).parquet(root)


@query(
    "s1_csv_by_name",
    """
SELECT customer_id, first_name, last_name, nullif(email, '') AS email,
  strftime(signup_date, '%Y-%m-%d') AS signup_date, city, segment FROM customers_raw""",
    "customers_raw",
)
def s1_by_name(spark, d):
    """The file's columns stand in another order than the schema's, with one more."""
    raw = customers_raw(spark, d)
    path = write_csv(raw.select(*reversed(raw.columns), F.lit("x").alias("note")), workspace(spark, "csv"))
    return sources.read_csv(spark, path, S.CUSTOMERS)


@query("k8_described_table", "SELECT 'Cleansed customers.' AS comment, 'silver' AS tier, count(*) AS rows FROM customers_clean", "customers_clean")
def k8_described(spark, d):
    root = workspace(spark, "described")
    name = f"customers_{root.rsplit('-', 1)[1]}"
    saved = sinks.save_table(marts.clean_customers(customers_raw(spark, d)), name, root)
    sinks.describe_table(spark, name, "Cleansed customers.", {"tier": "silver"})
    comment = spark.catalog.getTable(name).description
    tier = spark.sql(f"SHOW TBLPROPERTIES {name} ('tier')").first().value
    return saved.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(comment).alias("comment"), F.lit(tier).alias("tier"), "rows"
    )


@query("k9_publish_snapshot", "SELECT store_region, sum(daily_revenue)::DOUBLE AS revenue FROM gold GROUP BY 1", "gold")
def k9(spark, d):
    manifest = sinks.publish_snapshot(gold(spark, d), workspace(spark, "snapshot"))
    shared = sources.read_manifest(spark, manifest)
    return shared.groupBy("store_region").agg(F.sum("daily_revenue").alias("revenue"))


# --- whole way from raw files to gold ---------------------------------------


def write_raw(spark: SparkSession, d: str, root: str, part: str = "true") -> str:
    """Customers and products as CSV, orders and items as JSON lines; ``part`` selects
    the orders (and their items) of one delivery by their id."""
    write_csv(customers_raw(spark, d), f"{root}/customers")
    write_csv(products_raw(spark, d), f"{root}/products")
    deliver_orders(spark, d, root, part)
    return root


def deliver_orders(spark: SparkSession, d: str, root: str, part: str, days_later: int = 0) -> None:
    """Add the orders of ``part`` and their items to the raw files; with ``days_later`` the
    orders are dated so much later and are ``returned``."""
    # Whole days would be thousands of small files; a delivery directory per year
    # has the same layout.
    year = F.expr("coalesce(make_date(year(order_ts), 1, 1), date'1970-01-01')")
    orders = orders_raw(spark, d).where(part)
    if days_later:
        moved = F.expr(f"order_ts + INTERVAL {days_later} DAYS")
        orders = orders.withColumn("order_ts", moved).withColumn("status", F.when(F.col("status").isNotNull(), "returned"))
    orders = orders.withColumn("order_date", year)
    text = orders.withColumn("order_ts", F.date_format("order_ts", ISO))
    # Compressed, as raw files come; such a file is one task's work to read, so none grows large.
    packed = {"compression": "gzip", "maxRecordsPerFile": 500_000}
    text.hint("rebalance", "order_date").write.mode("append").options(**packed).partitionBy("order_date").json(f"{root}/orders")
    items_raw(spark, d).where(part).write.mode("append").options(**packed).json(f"{root}/order_items")


@query(
    "job_lakehouse_gold",
    GOLD_SQL,
    "gold",
)
def job_lakehouse(spark, d):
    root = workspace(spark, "lakehouse")
    raw = write_raw(spark, d, f"{root}/raw")
    saved = lakehouse.run(spark, raw, f"l{root.rsplit('-', 1)[1]}_", root)
    # Prices were read as doubles here; their sums are exact to the cent.
    return saved.withColumn("daily_revenue", F.round("daily_revenue", 2))


FEED_SQL = """
SELECT 'delete' AS _change_type, customer_id, email, 1::BIGINT AS _commit_version
FROM customers_csv WHERE customer_id % 1000 = 3
UNION ALL SELECT 'update_preimage', customer_id, email, 1 FROM customers_csv WHERE customer_id % 1000 = 4
UNION ALL SELECT 'update_postimage', customer_id, 'new.' || coalesce(email, ''), 1 FROM customers_csv
  WHERE customer_id % 1000 = 4
UNION ALL SELECT 'insert', customer_id + 1000000000000, email, 1 FROM customers_csv WHERE customer_id % 1000 = 5"""


@query(
    "s15_stored_table_feed",
    f"""
SELECT * FROM (WITH customers_csv AS (SELECT * REPLACE (nullif(email, '') AS email) FROM customers_clean) {FEED_SQL})""",
    "customers_clean",
)
def s15_stored(spark, d):
    """Two runs of the lakehouse; some customers are gone, changed or new in the second."""
    root = workspace(spark, "lakehouse")
    raw, prefix = write_raw(spark, d, f"{root}/raw"), f"f{root.rsplit('-', 1)[1]}_"
    lakehouse.run(spark, raw, prefix, root, version=0)
    first = marts.clean_customers(customers_raw(spark, d))
    changed = F.when(F.col("customer_id") % 1000 == 4, F.concat(F.lit("new."), F.coalesce("email", F.lit("")))).otherwise(F.col("email"))
    kept = first.where("customer_id % 1000 <> 3").withColumn("email", changed)
    come = first.where("customer_id % 1000 = 5").withColumn("customer_id", F.col("customer_id") + 1000000000000)
    write_csv(kept.unionByName(come), f"{raw}/customers", "overwrite")
    lakehouse.run(spark, raw, prefix, root, version=1)
    return lakehouse.silver_feed(spark, root, "customers", 0, 1).select("_change_type", "customer_id", "email", "_commit_version")
