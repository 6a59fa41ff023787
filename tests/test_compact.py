"""Compaction of a partitioned table, and tables with expectations."""

from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from tradewind.plans.expectations import Declared, ExpectationFailed, update_tables, violations
from tradewind.session import workspace
from tradewind.sinks import compact, save_table


@pytest.fixture
def scattered(spark):
    """A table of three partitions, one of them null, with ten files each, and one of one file."""
    root = workspace(spark, "compact")
    name = f"scattered_{root.rsplit('-', 1)[1]}"
    many = spark.range(0, 3000, 1, 10).selectExpr("id", "repeat('x', 20) AS text", "CASE id % 3 WHEN 0 THEN 'a b' WHEN 1 THEN \"it's\" END AS part")
    save_table(many.unionByName(spark.range(5).selectExpr("id", "'y' AS text", "'single' AS part").coalesce(1)), name, root, ["part"])
    return name


def files(spark, name):
    found = spark.read.table(name).select("part", F.col("_metadata.file_path").alias("f")).distinct()
    return {r["part"]: r["n"] for r in found.groupBy("part").agg(F.count("f").alias("n")).collect()}


def test_rows_stay_and_files_are_few(spark, scattered):
    before = rows(spark.read.table(scattered))
    assert files(spark, scattered) == {"a b": 10, "it's": 10, None: 10, "single": 1}
    done = compact.compact_table(spark, scattered, "part")
    assert rows(spark.read.table(scattered)) == before
    assert files(spark, scattered) == {"a b": 1, "it's": 1, None: 1, "single": 1}
    assert len(done.replaced) == done.report.count() == 3
    compact.remove_replaced(spark, done)
    assert rows(spark.read.table(scattered)) == before
    # Nothing is left to do, and later rows go to the partition as it is now.
    assert compact.compact_table(spark, scattered, "part").replaced == []
    spark.sql(f"INSERT INTO {scattered} VALUES (-1, 'late', 'a b')")
    assert spark.read.table(scattered).where("part = 'a b'").count() == 1001


def test_bins_are_filled_to_the_target(spark, scattered):
    size = spark.read.table(scattered).select(F.max("_metadata.file_size")).first()[0]
    compact.compact_table(spark, scattered, "part", 4 * size, F.col("part") == "a b")
    after = files(spark, scattered)
    assert after["it's"] == 10 and 1 <= after["a b"] <= 3


def test_cut_off_between_partitions(spark, scattered, monkeypatch):
    """Some partitions are pointed to their new files, the others not yet: all rows are read
    once, and the next run does the rest."""
    before = rows(spark.read.table(scattered))
    real, swaps = type(spark).sql, []

    def cut(self, text, *rest, **more):
        if "SET LOCATION" in text:
            swaps.append(text)
            if len(swaps) == 2:
                raise RuntimeError("killed")
        return real(self, text, *rest, **more)

    monkeypatch.setattr(type(spark), "sql", cut)
    with pytest.raises(RuntimeError):
        compact.compact_table(spark, scattered, "part")
    monkeypatch.undo()
    spark.catalog.refreshTable(scattered)
    assert rows(spark.read.table(scattered)) == before
    assert sorted(files(spark, scattered).values()) == [1, 1, 10, 10]
    compact.compact_table(spark, scattered, "part")
    assert rows(spark.read.table(scattered)) == before
    assert set(files(spark, scattered).values()) == {1}


@pytest.fixture
def lake(spark):
    root = workspace(spark, "declared")
    return root, f"d{root.rsplit('-', 1)[1]}_"


def tables():
    # Named so that the order of names is not the order of reads.
    last = Declared("a_totals", ["z_lines"], lambda x: x.groupBy("k").agg(F.sum("v").alias("v")), "Totals.", fail={"positive": "v > 0"})
    first = Declared("z_lines", ["raw"], lambda x: x, "Lines.", {"tier": "silver"}, warn={"known": "k IS NOT NULL"}, drop={"small": "v < 100"})
    return [last, first]


def test_tables_follow_what_they_read(spark, lake, frame):
    root, prefix = lake
    raw = frame([("a", 1), ("a", 2), (None, 5), ("b", 200), ("b", None)], "k string, v int")
    found = update_tables(spark, tables(), {"raw": raw}, prefix, root, 0)
    assert rows(found.drop("run")) == rows(frame([("z_lines", "known", "warn", 5, 1, True), ("z_lines", "small", "drop", 5, 2, True), ("a_totals", "positive", "fail", 2, 0, True)], "t string, e string, a string, r bigint, v bigint, w boolean"))
    assert rows(spark.read.table(f"{prefix}a_totals")) == [("a", 3), (None, 5)]
    assert spark.catalog.getTable(f"{prefix}z_lines").description == "Lines."


def test_missed_condition_leaves_the_table(spark, lake, frame):
    root, prefix = lake
    update_tables(spark, tables(), {"raw": frame([("a", 1)], "k string, v int")}, prefix, root, 0)
    for _ in range(2):  # the run may be repeated
        with pytest.raises(ExpectationFailed, match="a_totals: positive"):
            update_tables(spark, tables(), {"raw": frame([("a", -7), ("c", 3)], "k string, v int")}, prefix, root, 1)
    assert rows(spark.read.table(f"{prefix}a_totals")) == [("a", 1)]
    assert rows(spark.read.table(f"{prefix}z_lines")) == [("a", -7), ("c", 3)]
    kept = violations(spark, root)
    assert kept.count() == 6 and [tuple(r)[4:] for r in kept.where("run = 1 AND action = 'fail'").collect()] == [(2, 1, False)]
    update_tables(spark, tables(), {"raw": frame([("a", 9)], "k string, v int")}, prefix, root, 1)
    assert rows(spark.read.table(f"{prefix}a_totals")) == [("a", 9)]


def test_a_new_column_is_taken(spark, lake, frame):
    root, prefix = lake
    update_tables(spark, tables()[1:], {"raw": frame([("a", 1)], "k string, v int")}, prefix, root, 0)
    update_tables(spark, tables()[1:], {"raw": frame([("a", 1, "x")], "k string, v int, more string")}, prefix, root, 1)
    assert spark.read.table(f"{prefix}z_lines").columns == ["k", "v", "more"]
    assert violations(spark, f"{root}/none").isEmpty()
