from __future__ import annotations

import datetime as dt

from frames import final_plan, plan, rows
from pyspark.sql import functions as F

from tradewind.functions import (
    clamp_non_negative,
    date_key,
    mask_email,
    mask_email_strict,
    normalize_email,
    parse_date,
    parse_ts,
    valid_email,
)
from tradewind.operators import rows as ops
from tradewind.operators.changes import apply_changes, change_feed
from tradewind.operators.identity import with_identity


def test_safe_select_casts_and_fills(frame):
    df = frame([("1", "abc"), ("x", None)], "a string, extra string")
    out = ops.safe_select(df, [("a", "bigint"), ("missing", "date")])
    assert out.dtypes == [("a", "bigint"), ("missing", "date")]
    assert rows(out) == [(1, None), (None, None)]


def test_safe_select_on_a_frame_without_columns(spark):
    out = ops.safe_select(spark.range(0).select(), [("order_id", "string"), ("quantity", "int")])
    assert out.columns == ["order_id", "quantity"] and out.count() == 0


def test_clamp_keeps_null(frame):
    df = frame([(-3,), (0,), (4,), (None,)], "q int")
    assert rows(df.select(clamp_non_negative("q"))) == [(0,), (0,), (4,), (None,)]


def test_times_parse_or_turn_null(frame):
    df = frame([("2026-06-01T23:59:59Z",), ("2026-07-01 08:52:44.668387",), ("soon",), (None,)], "t string")
    got = {r[0]: r[1] for r in df.select("t", F.date_format(parse_ts("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()}
    assert got["2026-06-01T23:59:59Z"] == "2026-06-01 23:59:59.000000"
    assert got["2026-07-01 08:52:44.668387"] == "2026-07-01 08:52:44.668387"
    assert got["soon"] is None and got[None] is None
    days = frame([("2026-06-01",), ("01/06/2026",)], "t string").select(parse_date("t"))
    assert rows(days) == [(dt.date(2026, 6, 1),), (None,)]


def test_date_key(frame):
    df = frame([(dt.datetime(2026, 6, 1, 23, 0),), (None,)], "t timestamp")
    assert rows(df.select(date_key("t"))) == [(20260601,), (None,)]


def test_emails(frame):
    # LIKE '%_@__%.__%' wants two characters between the @ and a dot, and two behind the dot.
    valid = {"  A.B@Shop.Com ": True, "no_at": False, "nodomain@": False, "": False, None: None, "a@b.co": False}
    df = frame([(e,) for e in valid], "e string")
    assert {r[0]: r[1] for r in df.select("e", valid_email(normalize_email("e"))).collect()} == valid


def test_mask_as_written(frame):
    df = frame([("mary.analytics@domain.com",), ("no_at",), ("a@b.com",), (None,)], "e string")
    got = {r[0]: r[1] for r in df.select("e", mask_email("e")).collect()}
    assert got["mary.analytics@domain.com"] == "m*************@domain.com"
    assert got["no_at"] == "no_at" and got["a@b.com"] == "a@b.com" and got[None] is None


def test_strict_mask_leaves_no_local_part(frame):
    df = frame([("abc@b.com",), ("no_at",), ("a@b.com",), (None,)], "e string")
    got = {r[0]: r[1] for r in df.select("e", mask_email_strict("e")).collect()}
    assert got == {"abc@b.com": "a**@b.com", "no_at": "*****", "a@b.com": "*@b.com", None: None}
    assert rows(df.select(mask_email_strict("e", True))) == rows(df)


def test_latest_by_takes_newest_and_settles_ties(frame):
    data = [(1, "2020-01-01", "b"), (1, "2020-01-02", "z"), (1, "2020-01-02", "c"), (2, None, "n"), (None, "2021-01-01", "x")]
    df = frame(data, "id int, day string, v string")
    out = ops.latest_by(df, ["id"], [F.col("day").desc_nulls_last()])
    assert rows(out) == [(1, "2020-01-02", "c"), (2, None, "n")]
    kept = ops.latest_by(df, ["id"], [F.col("day").desc_nulls_last()], null_keys=True)
    assert kept.count() == 3


def test_dedup_limits_rows_before_the_shuffle(spark):
    # One key holds a third of the rows: each map task may hand on one row of it.
    df = spark.range(30_000, numPartitions=4).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v")
    out = ops.dedup(df, ["k"])
    text = plan(out)
    assert text.index("Partial") > text.index("Exchange hashpartitioning(k")
    assert out.count() == 20_001
    assert out.where("k = -1").collect()[0].v == 0


def test_dedup_counts(frame):
    df = frame([(1, 1, 5), (1, 1, 5), (1, 2, 5), (None, 2, 5)], "a int, b int, c int")
    assert rows(ops.dropped_by_dedup(df, ["a", "b"])) == [(3, 2, 1)]


def test_union_evolving(frame):
    a = frame([(1, "n")], "id int, region string")
    b = frame([("s", 2, "VIP15")], "region string, id int, discount_code string")
    assert rows(ops.union_evolving(a, b)) == [(1, "n", None), (2, "s", "VIP15")]


def test_top_k_is_one_pass(frame):
    df = frame([(i, -i) for i in range(20)], "a int, b int")
    out = ops.top_k(df, [F.desc("a")], 3)
    assert "TakeOrderedAndProject" in plan(out)
    assert [r.a for r in out.collect()] == [19, 18, 17]


def test_identity_is_gapless_and_ordered(spark):
    df = spark.range(5_000, numPartitions=7).selectExpr("5000 - id AS k", "id % 3 AS v")
    out = with_identity(df, ["k"], "n", start=10, partitions=5).collect()
    assert sorted(r.n for r in out) == list(range(10, 5_010))
    assert [r.k for r in sorted(out, key=lambda r: r.n)] == sorted(r.k for r in out)


def test_identity_has_no_global_window(spark):
    out = with_identity(spark.range(100).selectExpr("id AS k"), ["k"])
    assert "SinglePartition" not in final_plan(out).split("BroadcastExchange")[0]


def test_change_feed_and_back(frame):
    old = frame([(1, "a", None), (2, "b", 1), (3, "c", 2)], "id int, v string, w int")
    new = frame([(1, "a", None), (2, "B", 1), (4, "d", None)], "id int, v string, w int")
    feed = change_feed(old, new, ["id"], 7)
    assert rows(feed) == [
        ("delete", 3, "c", 2, 7),
        ("insert", 4, "d", None, 7),
        ("update_postimage", 2, "B", 1, 7),
        ("update_preimage", 2, "b", 1, 7),
    ]
    assert rows(apply_changes(old, feed, ["id"])) == rows(new)
    assert change_feed(old, old, ["id"], 8).count() == 0
