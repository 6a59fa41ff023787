"""Versions of a table and the feed between them by bucket checksums."""

from __future__ import annotations

import glob

import pytest
from frames import rows
from pyspark.sql import functions as F

from tradewind.operators import changes
from tradewind.session import workspace
from tradewind.sinks import VersionedTable, changed_buckets, read_version, save_version, version_feed


@pytest.fixture
def table(spark):
    return VersionedTable(workspace(spark, "versions"), ["k", "j"], 16)


def test_feed_equals_join_of_whole_versions(spark, table):
    old = spark.range(300).selectExpr("id AS k", "cast(id % 3 AS string) AS j", "if(id % 5 = 0, NULL, id) AS v", "if(id % 5 = 0, 'x', NULL) AS w")
    # A value moves into the column beside it where the other becomes null.
    new = old.where("k % 50 <> 1").selectExpr("k", "j", "if(k = 10, 7, v) AS v", "if(k = 10, NULL, w) AS w").union(spark.sql("SELECT 1000L, '0', 1L, NULL"))
    save_version(old, table, 0)
    save_version(new, table, 1)
    got = version_feed(spark, table, 0, 1)
    assert rows(got) == rows(changes.change_feed(old, new, ["k", "j"], 1))
    assert rows(read_version(spark, table, 1)) == rows(new)


def test_unchanged_buckets_are_not_read(spark, table):
    old = spark.range(5000).selectExpr("id AS k", "'a' AS j", "id AS v")
    new = old.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v")))
    save_version(old, table, 0)
    save_version(new, table, 1)
    (bucket,) = changed_buckets(spark, table, 0, 1)
    for v in (0, 1):  # the other buckets' files may even be broken
        for f in glob.glob(f"{table.rows_at(v)}/_bucket=*/*.parquet"):
            if f"_bucket={bucket}/" not in f:
                with open(f, "wb") as out:
                    out.write(b"no Parquet")
    feed = version_feed(spark, table, 0, 1)
    assert sorted((r["_change_type"], r["k"], r["v"]) for r in feed.collect()) == [("update_postimage", 77, -1), ("update_preimage", 77, 77)]


def test_nothing_changed_and_a_version_again(spark, table):
    df = spark.range(50).selectExpr("id AS k", "'a' AS j")
    for v in (0, 1, 1):
        save_version(df.repartition(v + 1), table, v)
    assert changed_buckets(spark, table, 0, 1) == [] and version_feed(spark, table, 0, 1).isEmpty()
    save_version(df.where("k < 10"), table, 1)
    assert version_feed(spark, table, 0, 1).groupBy("_change_type").count().collect()[0]["count"] == 40


def test_a_new_column_changes_every_row_that_has_it(spark, table):
    old = spark.range(20).selectExpr("id AS k", "'a' AS j")
    new = old.withColumn("more", F.when(F.col("k") < 5, F.lit("x")))
    save_version(old, table, 0)
    save_version(new, table, 1)
    found = version_feed(spark, table, 0, 1)
    assert sorted(r["k"] for r in found.where("_change_type = 'update_postimage'").collect()) == list(range(5))


def test_empty_versions(spark, table):
    none = spark.range(0).selectExpr("id AS k", "'a' AS j")
    save_version(none, table, 0)
    save_version(spark.range(3).selectExpr("id AS k", "'a' AS j"), table, 1)
    assert version_feed(spark, table, 0, 1).count() == 3
    assert version_feed(spark, table, 1, 0).count() == 3


def test_a_bucket_that_is_as_it_was_is_not_written_again(spark, table):
    versions = [spark.range(2000).selectExpr("id AS k", "'a' AS j", f"if(id = 77, {v}, id) AS v") for v in range(3)]
    for v, df in enumerate(versions):
        save_version(df, table, v)
    for v in (1, 2):
        (bucket,) = changed_buckets(spark, table, v - 1, v)
        assert {f.split("/")[-2] for f in glob.glob(f"{table.rows_at(v)}/_bucket=*/*.parquet")} == {f"_bucket={bucket}"}
    # An early version is written again: the later ones keep the rows they share with the first try.
    save_version(versions[0].where("k < 10"), table, 0)
    assert [rows(read_version(spark, table, v)) for v in range(3)] == [rows(versions[0].where("k < 10")), rows(versions[1]), rows(versions[2])]
    assert version_feed(spark, table, 0, 1).count() == 1990
    assert rows(version_feed(spark, table, 1, 2)) == rows(changes.change_feed(versions[1], versions[2], ["k", "j"], 2))
