from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from frames import final_plan, plan, rows
from pyspark.sql import functions as F

from tradewind import workspace
from tradewind.operators import marts, profile, quality
from tradewind.sinks import aggregate_dealt, bucketed_table, deal_table, dealt_table, join_dealt


@pytest.fixture
def shop(frame):
    """Orders, items and products with the traps in them."""
    ts = dt.datetime(2026, 6, 1, 12, 0)
    orders = frame(
        [("o1", 1, ts, "north", "placed"), ("o1", 1, ts, "north", "placed"), ("o2", 2, ts, "south", None), (None, 3, ts, "east", "x")],
        "order_id string, customer_id bigint, order_ts timestamp, store_region string, status string",
    )
    items = frame(
        [
            ("o1", "p1", 2, Decimal("1.50"), Decimal("3.00")),
            ("o1", "p1", 3, Decimal("1.50"), Decimal("4.50")),  # same key: one line is lost
            ("o1", "p2", 1, Decimal("10.00"), Decimal("10.00")),
            ("o2", "p1", -4, Decimal("1.50"), Decimal("-6.00")),
            ("o2", "p9", 1, Decimal("7.00"), Decimal("7.00")),  # unknown product
            ("o2", None, 1, Decimal("7.00"), Decimal("7.00")),
            ("o9", "p2", 1, Decimal("7.00"), Decimal("7.00")),  # unknown order
        ],
        "order_id string, product_id string, quantity int, unit_price decimal(10,2), line_total decimal(12,2)",
    )
    products = frame(
        [("p1", "b", "Toys", None, None), ("p1", "a", "Toys", 1.5, True), ("p2", "c", "Home", None, None), (None, "x", "y", 1.0, True)],
        "product_id string, product_name string, category string, unit_price double, active_flag boolean",
    )
    return marts.clean_orders(orders), marts.clean_items(items), marts.clean_products(products)


def test_clean_products(shop):
    assert rows(shop[2]) == [("p1", "a", "Toys", 1.5, True), ("p2", "c", "Home", 0.0, True)]


def test_gold(shop):
    day = dt.date(2026, 6, 1)
    assert rows(marts.daily_regional_revenue(*shop)) == [
        (day, "Home", "north", Decimal("10.00"), 1, 1),
        (day, "Toys", "north", Decimal("3.00"), 2, 1),
        (day, "Toys", "south", Decimal("0.00"), 0, 1),
    ]


def test_items_partition_column_is_not_ambiguous(shop):
    orders, items, products = shop
    items = items.withColumn("order_date", F.lit("2026-06-02").cast("date"))
    assert marts.daily_regional_revenue(orders, items, products).count() == 3


def test_tiles_resum_distinct_orders(shop):
    gold = marts.daily_regional_revenue(*shop)
    # o1 has lines in two categories: the dashboard counts it twice.
    assert marts.tile_orders(gold).first()[0] == 3
    assert marts.distinct_orders(marts.gold_source(*shop)).first()[0] == 2
    totals = [
        marts.tile_daily(gold).agg(F.sum("global_revenue")).first()[0],
        marts.tile_category(gold).agg(F.sum("categorical_revenue")).first()[0],
        gold.agg(F.sum("daily_revenue")).first()[0],
    ]
    assert len(set(totals)) == 1


def test_order_without_items_has_total_zero(shop):
    orders, items, _ = shop
    lone = orders.unionByName(orders.limit(1).withColumn("order_id", F.lit("o3")))
    got = {r.order_id: r.order_total for r in marts.with_order_total(lone, items).collect()}
    assert got["o3"] == 0 and got["o1"] == Decimal("13.00")


def test_daily_revenue_counts_every_status(frame):
    orders = frame([("d1", "cancelled", 5.0), ("d1", "placed", 2.555), ("d2", "returned", None)], "order_date string, status string, order_total double")
    got = {r.order_date: r.total_revenue for r in marts.daily_revenue(orders).collect()}
    assert got["d2"] == 0.0 and abs(got["d1"] - 7.56) < 0.011


def test_fact_takes_passed_orders_only(shop):
    orders, items, _ = shop
    outcomes = orders.withColumn(quality.RESULT, F.when(F.col("order_id") == "o1", "Passed").otherwise("Failed"))
    fact = marts.build_fact(items, outcomes)
    assert {r.order_id for r in fact.collect()} == {"o1"}
    types = dict(fact.dtypes)
    assert types["line_total"] == "decimal(12,2)" and types["customer_id"] == "bigint" and types["date_key"] == "int"


def test_dim_date(spark):
    days = marts.dim_date(spark, "2024-02-28", "2024-03-01")
    assert rows(days) == [
        (20240228, dt.date(2024, 2, 28), "Wednesday", "February", 2024),
        (20240229, dt.date(2024, 2, 29), "Thursday", "February", 2024),
        (20240301, dt.date(2024, 3, 1), "Friday", "March", 2024),
    ]


def test_bucketed_tables_join_without_exchange(spark):
    root = workspace(spark, "bucket-test")
    left = bucketed_table(spark.range(1_000).selectExpr("id % 100 AS k", "id AS v"), "bucket_l", "k", 4, path=f"{root}/l")
    right = bucketed_table(spark.range(100).selectExpr("id AS k", "id AS w"), "bucket_r", "k", 4, path=f"{root}/r")
    joined = left.hint("merge").join(right, "k")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 1_000


def hot_tables(spark, label, buckets=64):
    root = workspace(spark, label)
    tag = root.rsplit("-", 1)[1]
    key = "CASE WHEN id % 3 = 0 THEN -1 WHEN id % 10 = 1 THEN NULL ELSE id % 7000 END AS k"
    left = deal_table(spark.range(60_000).selectExpr(key, "id AS v"), f"hot_l_{tag}", "k", buckets, path=f"{root}/l")
    # The right side has a hot key of its own, one in common, and keys the left side lacks.
    other = "CASE WHEN id % 4 = 0 THEN 3 WHEN id % 4 = 1 THEN -1 WHEN id % 50 = 2 THEN NULL ELSE id END AS k"
    right = deal_table(spark.range(800).selectExpr(other, "id AS w"), f"hot_r_{tag}", "k", buckets, path=f"{root}/r")
    return left, right


def test_hot_key_lies_beside_the_buckets(spark):
    left, right = hot_tables(spark, "dealt")
    assert left.hot == (-1,) and right.hot == (-1, 3)
    assert left.head.where("k = -1").count() == 20_000 and left.tail.where("k = -1 OR k IS NULL").isEmpty()
    assert left.read().count() == spark.read.table(left.name).count() == 60_000
    described = spark.sql(f"DESCRIBE EXTENDED {left.name}_tail").collect()
    assert [r.data_type for r in described if r.col_name == "Num Buckets"] == ["64"]
    assert dealt_table(spark, left.name, "k").hot == left.hot


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dealt_join_equals_plain_join(spark, how):
    left, right = hot_tables(spark, "dealt")
    got, want = (df.groupBy(*df.columns).count().groupBy().agg(F.sum("count"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first() for df in (join_dealt(left, right, how), left.read().join(right.read(), "k", how)))
    assert got == want


def test_tails_join_and_aggregate_without_exchange(spark):
    left, right = hot_tables(spark, "dealt")
    assert "Exchange" not in plan(left.tail.where(~right.is_hot("k")).hint("merge").join(right.tail, "k"))
    assert "Exchange" not in plan(left.tail.groupBy("k").count())
    # Two exchanges of the head's partial sums, none of the tail.
    assert plan(aggregate_dealt(left, F.count(F.lit(1)).alias("n"))).count("Exchange hashpartitioning") == 1
    assert rows(aggregate_dealt(left, F.count(F.lit(1)).alias("n"))) == rows(left.read().groupBy("k").agg(F.count(F.lit(1)).alias("n")))


def test_no_hot_key_and_empty_table(spark):
    root = workspace(spark, "dealt")
    tag = root.rsplit("-", 1)[1]
    even = deal_table(spark.range(1000).selectExpr("id AS k"), f"even_{tag}", "k", 8, path=f"{root}/e")
    none = deal_table(spark.range(0).selectExpr("id AS k"), f"none_{tag}", "k", 8, path=f"{root}/n")
    assert even.hot == none.hot == () and none.read().isEmpty() and even.tail.count() == 1000
    assert join_dealt(even, none, "left_anti").count() == 1000


# --- profiles against brute force -------------------------------------------

VALUES = [1.0, 1.0, 2.5, 2.5, 4.0, 7.25, 9.0, 9.0, 11.0]


def test_histogram_equals_numpy(frame):
    np = pytest.importorskip("numpy")
    for bins in (1, 4, 40):
        counts, edges = np.histogram(VALUES, bins)
        got = sorted(profile.histogram(frame([(v,) for v in VALUES + [None]], "v double"), "v", bins).collect())
        assert [r.rows for r in got] == counts.tolist()
        assert [r.lower for r in got] == pytest.approx(edges[:-1].tolist())
        assert got[-1].upper == 11.0


def test_histogram_of_one_value(frame):
    got = profile.histogram(frame([(3.0,), (3.0,)], "v double"), "v", 4).collect()
    assert sum(r.rows for r in got) == 2


def test_kde_equals_brute_force(frame):
    n = len(VALUES)
    mean = sum(VALUES) / n
    width = math.sqrt(sum((v - mean) ** 2 for v in VALUES) / (n - 1)) * n ** (-0.2)
    got = sorted(profile.kde(frame([(v,) for v in VALUES], "v double"), "v", 11).collect())
    for r in got:
        want = sum(math.exp(-0.5 * ((v - r.x) / width) ** 2) for v in VALUES) / (n * width * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(want)
    assert [got[0].x, got[-1].x] == [1.0, 11.0]


def test_profile_of_small_table(frame):
    df = frame([("a", 1, None), ("a", 1, None), ("b", 3, "x"), (None, None, "x")], "k string, n int, s string")
    assert {r.column: (r.null_count, r.null_pct) for r in profile.profile_nulls(df).collect()} == {"k": (1, 25.0), "n": (1, 25.0), "s": (2, 50.0)}
    assert profile.profile_duplicates(df).first()[0] == 1
    assert rows(profile.profile_ranges(df)) == [("n", 1.0, 3.0, 1.67)]
    assert rows(profile.profile_top_values(df, 1)) == [("k", "a", 2, 1), ("s", "x", 2, 1)]
    assert rows(profile.profile_shape(df)) == [("k", "string", 4, 3), ("n", "int", 4, 3), ("s", "string", 4, 3)]
    assert rows(profile.duplicate_keys(df, "k")) == [(3, 2, 1, 1, 33.33)]


def test_top_values_limit_before_the_shuffle(spark):
    df = spark.range(1_000).selectExpr("cast(id % 7 AS string) AS k")
    text = plan(profile.profile_top_values(df, 2))
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("tracked", [16, 4096])
def test_common_values_equal_counting_all(spark, tracked):
    mixed = "CASE WHEN id % 3 = 0 THEN concat('hot', id % 2) WHEN id % 3 = 1 THEN cast(id AS string) END"
    df = spark.range(3_000).selectExpr(f"{mixed} AS mixed", "cast(id AS string) AS unique", "cast(id % 5 AS string) AS few", "cast(NULL AS string) AS none", "concat('z', cast(sqrt(id) AS int)) AS tied")
    for k in (1, 2, 5):
        assert rows(profile.common_values(df, k, tracked=tracked)) == rows(profile.profile_top_values(df, k))
    assert rows(profile.common_values(df.limit(0), 2, tracked=tracked)) == []


def test_settled_columns_shuffle_no_other_values(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN concat('hot', id % 4) ELSE cast(id AS string) END AS k")
    out = profile.common_values(df, 2)
    assert "Exchange" not in plan(out)  # settled: the rows are there
    assert rows(out) == [("k", "hot0", 5000, 1), ("k", "hot2", 5000, 2)]


def test_null_map_blocks(frame):
    df = frame([(i, None if i < 5 else "x") for i in range(10)], "id int, v string")
    got = {(r.column, r.block): (r.rows, r.null_rate) for r in profile.null_map(df, "id", 2).collect()}
    assert got == {("id", 0): (5, 0.0), ("id", 1): (5, 0.0), ("v", 0): (5, 1.0), ("v", 1): (5, 0.0)}


def test_email_classes(frame):
    df = frame([(None,), ("",), ("no_at",), ("x@",), (" a@b.com ",), ("a@b.com",), (" x@ ",)], "email string")
    got = {r.email_class: r.rows for r in profile.email_defects(df).collect()}
    assert got == {"null": 1, "empty": 1, "no_at": 1, "no_domain": 2, "padded": 1, "ok": 1}


def test_star_query_prunes_by_date_key(spark, shop):
    orders, items, _ = shop
    fact = marts.build_fact(items, orders.withColumn(quality.RESULT, F.lit("Passed")))
    customers = spark.createDataFrame([(1, "corporate"), (2, "consumer")], "customer_id bigint, segment string")
    dates = marts.dim_date(spark, "2026-05-01", "2026-07-01")
    out = marts.segment_revenue(fact, customers, dates, "2026-06-01", "2026-06-30")
    assert rows(out) == [("consumer", Decimal("7.00"), 1), ("corporate", Decimal("13.00"), 1)]
    assert marts.segment_revenue(fact, customers, dates, "2026-06-02", "2026-06-30").count() == 0
    assert "HashAggregate" in final_plan(out)
