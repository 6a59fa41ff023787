"""File streams, incremental runs, and the curation job over two deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import clickstream, curation
from ..session import workspace
from ..sources import fs
from ..streaming import Source, evolve_schema, ingest_stream, read_ingested, run_incremental, stream_to_table
from ..streaming.ingest import open_stream
from .files import deliver_orders, write_raw
from .registry import query
from .tables import clicks_raw

PER_TYPE = "SELECT event_type, count(*) AS rows, sum(value)::DOUBLE AS total_value FROM clicks_raw GROUP BY 1"

CLICKS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_ts", T.StringType()),
        T.StructField("value", T.DecimalType(10, 2)),
    ]
)


def deliver_clicks(spark: SparkSession, d: str, path: str, part: str = "true", *without: str) -> None:
    """Add the clicks selected by ``part`` to the JSON files at ``path``."""
    clicks = clicks_raw(spark, d).where(part).drop("event_date", *without)
    clicks.withColumn("event_ts", F.col("event_ts").cast("string")).write.mode("append").json(path)


def per_type(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").cast("decimal(18,2)").alias("total_value")
    )


@query("st1_ingest_stream", PER_TYPE, "clicks_raw")
def st1(spark, d):
    root = workspace(spark, "ingest")
    deliver_clicks(spark, d, f"{root}/raw")
    return per_type(ingest_stream(spark, f"{root}/raw", CLICKS, f"{root}/bronze", f"{root}/checkpoint"))


@query("st2_two_runs", PER_TYPE, "clicks_raw")
def st2(spark, d):
    """Each run takes the files delivered since the one before, then stops."""
    root = workspace(spark, "ingest")
    for half in (0, 1):
        deliver_clicks(spark, d, f"{root}/raw", f"event_id % 2 = {half}")
        out = ingest_stream(spark, f"{root}/raw", CLICKS, f"{root}/bronze", f"{root}/checkpoint")
    return per_type(out)


@query("st3_rerun_adds_nothing", PER_TYPE, "clicks_raw")
def st3(spark, d):
    root = workspace(spark, "ingest")
    deliver_clicks(spark, d, f"{root}/raw")
    for _ in range(2):
        out = ingest_stream(spark, f"{root}/raw", CLICKS, f"{root}/bronze", f"{root}/checkpoint")
    return per_type(out)


@query(
    "st4_schema_evolution",
    """
SELECT event_type, count(*) AS rows, count(*) FILTER (event_id % 2 = 1) AS with_value,
  sum(CASE WHEN event_id % 2 = 1 THEN value END)::DOUBLE AS total_value FROM clicks_raw GROUP BY 1""",
    "clicks_raw",
)
def st4(spark, d):
    """The first delivery has no ``value``; the second one brings it as a new column."""
    root = workspace(spark, "evolve")
    for half, without in ((0, ["value"]), (1, [])):
        deliver_clicks(spark, d, f"{root}/raw", f"event_id % 2 = {half}", *without)
        schema = evolve_schema(spark, f"{root}/raw", f"{root}/schema.json")
        out = ingest_stream(spark, f"{root}/raw", schema, f"{root}/bronze", f"{root}/checkpoint")
    value = F.col("value").cast("decimal(10,2)")
    return out.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("with_value"),
        F.sum(value).cast("decimal(18,2)").alias("total_value"),
    )


@query(
    "k5_stream_append",
    "SELECT event_type, count(*) AS rows FROM clicks_raw WHERE event_type <> 'error' GROUP BY 1",
    "clicks_raw",
)
def k5(spark, d):
    root = workspace(spark, "stream")
    deliver_clicks(spark, d, f"{root}/raw")
    stream = open_stream(spark, f"{root}/raw", CLICKS).where("event_type <> 'error'")
    stream_to_table(stream, f"{root}/bronze", f"{root}/checkpoint")
    out = read_ingested(spark, f"{root}/bronze", CLICKS)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


CLICKSTREAM_SQL = """
SELECT event_id, 'S' || user_id || '-' || strftime(ts, '%j') AS session_id,
  CASE WHEN event_id % 4 <> 0 THEN user_id END AS customer_id, event_type, '/' || event_type || '/' || event_id % 10 AS page_url,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
  CASE WHEN event_id % 3 = 1 THEN 'ref' || event_id % 5 END AS referrer
FROM events"""


def deliver_clickstream(spark: SparkSession, d: str, raw: str, part: str, *without: str) -> None:
    """Add the click-stream records of ``part`` to the raw JSON files, by day."""
    events = spark.read.parquet(f"{d}/events.parquet").where(part)
    records = events.selectExpr(
        "concat('S', user_id, '-', date_format(ts, 'DDD')) AS session_id",
        "CASE WHEN event_id % 4 <> 0 THEN user_id END AS customer_id",
        "event_type",
        "concat('/', event_type, '/', event_id % 10) AS page_url",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS event_ts",
        "CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type",
        "CASE WHEN event_id % 3 = 1 THEN concat('ref', event_id % 5) END AS referrer",
        "cast(ts AS date) AS event_date",
    )
    records.drop(*without).hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").json(f"{raw}/clickstream")


@query(
    "st1_clickstream_table",
    f"""
SELECT session_id, customer_id, event_type, page_url, event_ts, device_type, referrer,
  CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END::BIGINT AS run
FROM ({CLICKSTREAM_SQL})""",
)
def st1_clickstream(spark, d):
    """Two runs into the bronze table; the second delivery brings a new column. Some files
    make a batch, so a run has several."""
    root = workspace(spark, "clickstream")
    prefix = f"c{root.rsplit('-', 1)[1]}_"
    deliver_clickstream(spark, d, f"{root}/raw", "event_id % 3 <> 1", "referrer")
    first = clickstream.run(spark, f"{root}/raw", prefix, root, files_per_batch=20)
    batches = first.agg(F.max("_batch")).first()[0]
    deliver_clickstream(spark, d, f"{root}/raw", "event_id % 3 = 1")
    out = clickstream.run(spark, f"{root}/raw", prefix, root, files_per_batch=20)
    return out.drop("_rescued").withColumn("run", (F.col("_batch") > batches).cast("bigint")).drop("_batch")


@query(
    "s6_incremental_scan",
    "SELECT 1 + event_id % 2 AS run, count(*) AS rows FROM clicks_raw GROUP BY 1",
    "clicks_raw",
)
def s6(spark, d):
    """Two deliveries, two runs: each sees its own rows only."""
    root = workspace(spark, "incremental")
    source = Source("clicks", f"{root}/raw", CLICKS)

    def keep(frames, run):
        counted = frames["clicks"].agg(F.count(F.lit(1)).alias("rows")).withColumn("run", F.lit(run))
        counted.write.mode("overwrite").partitionBy("run").parquet(f"{root}/seen")

    for half in (0, 1):
        deliver_clicks(spark, d, source.path, f"event_id % 2 = {half}")
        run_incremental(spark, [source], root, keep)
    return spark.read.schema("rows bigint, run int").parquet(f"{root}/seen")


@query(
    "q13_skip_run",
    "SELECT 1::BIGINT AS run, count(*) AS rows FROM clicks_raw",
    "clicks_raw",
)
def q13(spark, d):
    """The second run finds nothing new and writes nothing."""
    root = workspace(spark, "skip")
    source = Source("clicks", f"{root}/raw", CLICKS)
    deliver_clicks(spark, d, source.path)

    def keep(frames, run):
        counted = frames["clicks"].agg(F.count(F.lit(1)).alias("rows")).withColumn("run", F.lit(run))
        counted.write.mode("append").parquet(f"{root}/seen")

    for _ in range(2):
        run_incremental(spark, [source], root, keep)
    return spark.read.schema("rows bigint, run int").parquet(f"{root}/seen")


@query(
    "job_curation",
    """
SELECT 'curated orders' AS "table", count(*) AS rows, sum(order_total)::DOUBLE AS amount FROM orders_passed UNION ALL
SELECT 'quarantined orders', count(*), sum(order_total)::DOUBLE FROM orders_curated
  WHERE order_id NOT IN (SELECT order_id FROM orders_passed) UNION ALL
SELECT 'curated order_items', count(*), sum(line_total)::DOUBLE FROM items_curated
  WHERE product_id IN (SELECT product_id FROM products_clean) UNION ALL
SELECT 'quarantined order_items', count(*), sum(line_total)::DOUBLE FROM items_curated
  WHERE product_id NOT IN (SELECT product_id FROM products_clean) UNION ALL
SELECT 'curated customers', count(*), NULL FROM customers_clean UNION ALL
SELECT 'curated products', count(*), NULL FROM products_clean UNION ALL
SELECT 'daily revenue', count(DISTINCT order_date), sum(order_total)::DOUBLE FROM orders_passed""",
    "orders_passed orders_curated items_curated products_clean customers_clean",
)
def job_curation(spark, d):
    """Two deliveries of orders with their items, curated in two runs."""
    root = workspace(spark, "curation")
    layout = curation.Layout(f"{root}/raw", f"{root}/lake", grain="year")
    write_raw(spark, d, layout.raw, "cast(order_id AS bigint) % 3 <> 0")
    curation.run(spark, layout)
    deliver_orders(spark, d, layout.raw, "cast(order_id AS bigint) % 3 = 0")
    curation.run(spark, layout)

    def line(label: str, path: str, amount: str | None = None) -> DataFrame:
        total = F.round(F.sum(amount), 2).cast("double") if amount else F.lit(None).cast("double")
        stored = spark.read.parquet(path)
        return stored.agg(F.count(F.lit(1)).alias("rows"), total.alias("amount")).withColumn("table", F.lit(label))

    out = line("curated orders", layout.curated("orders"), "order_total")
    for label, path, amount in (
        ("quarantined orders", layout.quarantine("orders"), "order_total"),
        ("curated order_items", layout.curated("order_items"), "line_total"),
        ("quarantined order_items", layout.quarantine("order_items"), "line_total"),
        ("curated customers", layout.curated("customers"), None),
        ("curated products", layout.curated("products"), None),
        ("daily revenue", layout.daily_revenue, "total_revenue"),
    ):
        if fs.exists(spark, path):
            out = out.unionByName(line(label, path, amount))
    return out


@query(
    "job_redelivered_orders",
    """
SELECT strftime(CASE WHEN order_id::BIGINT % 3 = 0 THEN order_date + INTERVAL 40 DAY ELSE order_date END, '%Y-%m-%d') AS order_date,
  count(*) AS orders, sum(order_total)::DOUBLE AS total_revenue
FROM orders_passed GROUP BY 1""",
    "orders_passed",
)
def job_redelivered_orders(spark, d):
    """Every third order comes again with a later day and another status; it counts once,
    on its new day, and its old day is corrected."""
    root = workspace(spark, "curation")
    layout = curation.Layout(f"{root}/raw", f"{root}/lake", grain="month")
    write_raw(spark, d, layout.raw)
    curation.run(spark, layout)
    deliver_orders(spark, d, layout.raw, "cast(order_id AS bigint) % 3 = 0", days_later=40)
    curation.run(spark, layout)
    revenue = spark.read.parquet(layout.daily_revenue).groupBy("order_date").agg(F.sum("total_revenue").alias("total_revenue"))
    current = spark.read.parquet(layout.current("orders")).groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))
    return revenue.join(current, "order_date", "full").withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query(
    "job_curation_scores",
    """
SELECT context, sum(passed)::BIGINT AS passed, sum(total)::BIGINT AS total FROM (
  SELECT 'orders_dq_check' AS context, (SELECT count(*) FROM orders_passed) AS passed, count(*) AS total
  FROM orders_curated
  UNION ALL SELECT 'order_items_dq_check',
    count(*) FILTER (product_id IN (SELECT product_id FROM products_clean)), count(*) FROM items_curated)
GROUP BY context""",
    "orders_passed orders_curated items_curated products_clean",
)
def job_curation_scores(spark, d):
    """The scores each run leaves behind, summed over two runs."""
    root = workspace(spark, "curation")
    layout = curation.Layout(f"{root}/raw", f"{root}/lake", grain="year")
    write_raw(spark, d, layout.raw, "cast(order_id AS bigint) % 2 = 0")
    curation.run(spark, layout)
    deliver_orders(spark, d, layout.raw, "cast(order_id AS bigint) % 2 = 1")
    curation.run(spark, layout)
    scores = spark.read.parquet(layout.metrics)
    return scores.groupBy("context").agg(F.sum("passed").alias("passed"), F.sum("total").alias("total"))
