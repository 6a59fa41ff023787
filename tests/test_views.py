"""Views kept from row changes: against recomputing, when cut off, and at the edges."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import functions as F

from tradewind import sinks
from tradewind.operators import changes
from tradewind.session import workspace
from tradewind.sinks import views

DDL = "id bigint, day date, kind string, amount decimal(10,2), pieces int, who string"


@pytest.fixture
def view(spark):
    return sinks.KeptView(workspace(spark, "view"), ("day", "kind"), "day", {"amount": "amount", "pieces": "pieces"}, {"people": "who", "kinds_of_pieces": "pieces"})


def lines(frame, seed, n=120):
    rng = random.Random(seed)
    days = [None, "2024-01-01", "2024-01-02", "2024-02-01"]
    data = [
        (i, rng.choice(days), rng.choice(["a", "b", None]), rng.choice([None, Decimal("1.25"), Decimal("-3.00")]), rng.choice([None, 1, 2]), rng.choice([None, "x", "y", "z"]))
        for i in range(n) if rng.random() < 0.6
    ]
    return frame([(i, d, *r) for i, d, *r in data], DDL.replace("day date", "day string")).withColumn("day", F.col("day").cast("date")).select(*[c.split()[0] for c in DDL.split(", ")])


def recomputed(df):
    return df.groupBy("day", "kind").agg(
        F.sum("amount").alias("amount"), F.sum("pieces").alias("pieces"),
        F.countDistinct("who").alias("people"), F.countDistinct("pieces").alias("kinds_of_pieces"),
    )


def test_equal_to_recomputing_after_every_version(spark, frame, view):
    old = lines(frame, 0)
    sinks.build_view(old, view)
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(old))
    for version in (1, 2, 3):
        new = lines(frame, version, 120 if version < 3 else 20)
        feed = changes.change_feed(old, new, ["id"], version)
        sinks.apply_changes(feed, view, version)
        sinks.apply_changes(feed, view, version)  # nothing is added twice
        assert rows(sinks.read_view(spark, view)) == rows(recomputed(new))
        old = new


def test_all_groups_go_and_come_back(spark, frame, view):
    base = lines(frame, 5)
    sinks.build_view(base.limit(0), view)
    assert rows(sinks.read_view(spark, view)) == []
    sinks.apply_changes(changes.change_feed(base.limit(0), base, ["id"], 1), view, 1)
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(base))
    sinks.apply_changes(changes.change_feed(base, base.limit(0), ["id"], 2), view, 2)
    assert rows(sinks.read_view(spark, view)) == []
    sinks.apply_changes(changes.change_feed(base.limit(0), base, ["id"], 3), view, 3)
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(base))


@pytest.mark.parametrize("step", [1, 2, 3])
def test_cut_off_between_steps(spark, frame, view, monkeypatch, step):
    """Killed in any step of a version: a reader or the next try finishes it, once."""
    old, new = lines(frame, 1), lines(frame, 2)
    sinks.build_view(old, view)
    feed = changes.change_feed(old, new, ["id"], 1)
    real, calls = views.replace_partitions, []

    def cut(df, path, *rest):
        calls.append(path)
        if len(calls) == step:
            raise RuntimeError("killed")
        real(df, path, *rest)

    monkeypatch.setattr(views, "replace_partitions", cut)
    with pytest.raises(RuntimeError):
        sinks.apply_changes(feed, view, 1)
    monkeypatch.setattr(views, "replace_partitions", real)
    if step == 2:
        assert rows(sinks.read_view(spark, view)) == rows(recomputed(new))
    sinks.apply_changes(feed, view, 1)
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(new))


def test_cut_off_before_the_marker_leaves_the_old_view(spark, frame, view, monkeypatch):
    old, new = lines(frame, 1), lines(frame, 2)
    sinks.build_view(old, view)
    feed = changes.change_feed(old, new, ["id"], 1)

    def cut(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(views, "write_text", cut)
    with pytest.raises(RuntimeError):
        sinks.apply_changes(feed, view, 1)
    monkeypatch.undo()
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(old))
    sinks.apply_changes(feed, view, 1)
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(new))


def test_only_touched_partitions_are_written(spark, frame, view):
    base = lines(frame, 7)
    sinks.build_view(base, view)
    path = f"{view.path}/groups"
    files = {r.f for r in spark.read.parquet(path).where("day = '2024-02-01'").select(F.input_file_name().alias("f")).distinct().collect()}
    one = base.where("day = '2024-01-01'").limit(1).withColumn("_change_type", F.lit("delete"))
    sinks.apply_changes(one, view, 1)
    after = {r.f for r in spark.read.parquet(path).where("day = '2024-02-01'").select(F.input_file_name().alias("f")).distinct().collect()}
    assert files == after


def test_doubles_are_refused(spark, frame, view):
    df = lines(frame, 1).withColumn("amount", F.col("amount").cast("double"))
    with pytest.raises(TypeError, match="exact"):
        sinks.build_view(df, view)


def test_feed_reversed_leads_back(frame):
    old, new = lines(frame, 1), lines(frame, 2)
    feed = changes.change_feed(old, new, ["id"], 1)
    assert rows(changes.apply_changes(new, changes.reversed_feed(feed), ["id"])) == rows(old)


def test_coarser_view_from_the_sums_of_a_finer_one(spark, frame, view):
    sums = {"amount": "amount", "pieces": "pieces"}
    whole = sinks.KeptView(workspace(spark, "view"), ("day", "sort"), "day", sums)
    by_pieces = sinks.KeptView(workspace(spark, "view"), ("day", "kind", "who"), "day", sums)
    old = lines(frame, 0).limit(0)
    for version in range(3):
        new = lines(frame, version)
        fine = sinks.summed(changes.change_feed(old, new, ["id"], version), by_pieces)
        # A group that is as it was adds nothing and is not written.
        assert fine.where("_lines = 0 AND coalesce(amount, 0) = 0 AND coalesce(pieces, 0) = 0 AND _n_amount = 0 AND _n_pieces = 0").isEmpty()
        sinks.apply_sums(sinks.coarser(fine, by_pieces, whole, {"sort": "kind"}), whole, version)
        sinks.apply_sums(fine, by_pieces, version)
        assert rows(sinks.read_view(spark, whole)) == rows(recomputed(new).drop("people", "kinds_of_pieces"))
        assert sinks.read_view(spark, by_pieces).count() == new.select("day", "kind", "who").distinct().count()
        old = new
    with pytest.raises(ValueError, match="sums"):
        sinks.coarser(fine, by_pieces, view, {})


def test_lines_of_moved_products(spark, frame):
    """No product known before, one that is new, one that goes to another category, none."""
    from tradewind.plans import warehouse

    fact = frame([("o1", "p1"), ("o1", "p2"), ("o2", "p2"), ("o3", None)], "order_id string, product_id string").withColumn("order_ts", F.lit("2026-06-01").cast("timestamp"))
    kinds = "product_id string, category string"
    first, second = frame([("p1", "a")], kinds), frame([("p1", "b"), ("p2", None)], kinds)

    def found(fact_feed, old, new):
        out = warehouse.line_changes(fact, new, fact_feed, changes.change_feed(old, new, ["product_id"], 1))
        assert out.columns[-1] == "product_category"
        return rows(out.groupBy("order_id", "product_id", "category").agg(F.sum(F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)).alias("n")).where("n <> 0"))

    come = changes.change_feed(fact.limit(0), fact, ["order_id", "product_id"], 0)
    none = come.limit(0)
    assert found(come, first.limit(0), second) == [("o1", "p1", "b", 1), ("o1", "p2", None, 1), ("o2", "p2", None, 1)]
    assert found(none, first, second) == [("o1", "p1", "a", -1), ("o1", "p1", "b", 1), ("o1", "p2", None, 1), ("o2", "p2", None, 1)]
    assert found(come, first, second) == [("o1", "p1", "b", 1), ("o1", "p2", None, 1), ("o2", "p2", None, 1)]
    assert found(none, second, second) == [] and found(come, second, second) == found(come, first.limit(0), second)


def test_lines_that_came_count_once(spark, frame):
    """A new line of a product that also moved is one row, not one for the old category and two
    for the move; lines that were there move."""
    from tradewind.plans import warehouse

    cells, kinds = "order_id string, product_id string, n bigint", "product_id string, category string"
    fact = frame([("o1", "p1", 1), ("o1", "p2", 2), ("o2", "p1", 3), ("o2", "p3", 4)], cells).withColumn("order_ts", F.lit("2026-06-01").cast("timestamp"))
    products = frame([("p1", "b"), ("p2", "c"), ("p3", "d")], kinds)
    moves = changes.change_feed(frame([("p1", "a"), ("p2", "c")], kinds), products, ["product_id"], 1)
    feed = changes.change_feed(fact.where("n < 3"), fact, ["order_id", "product_id"], 1)
    out = warehouse.line_changes(fact, products, feed, moves, F.col("n") >= 3)
    assert rows(out.select("order_id", "product_id", "category", "_change_type")) == [
        ("o1", "p1", "a", "delete"), ("o1", "p1", "b", "insert"), ("o2", "p1", "b", "insert"), ("o2", "p3", "d", "insert"),
    ]
    whole = warehouse.line_changes(fact, products, feed, moves)
    signed = F.sum(F.when(F.col("_change_type") == "insert", 1).otherwise(-1)).alias("w")
    per = [df.groupBy("order_id", "product_id", "category").agg(signed).where("w <> 0") for df in (out, whole)]
    assert rows(per[0]) == rows(per[1])


def test_rows_written_aside_are_moved(spark, frame, view, monkeypatch):
    """The files of a version are written once; cut off between two directories, the next try
    moves the others and takes none away."""
    import glob
    import os

    from tradewind.sinks import files

    old, new = lines(frame, 1), lines(frame, 2)
    sinks.build_view(old, view)
    feed = changes.change_feed(old, new, ["id"], 1)

    def cut(spark, source, target, col):
        one = sorted(glob.glob(f"{source}/{col}=*"))[0]
        files.remove_partition(spark, target, col, one.split("=")[1])
        os.rename(one, f"{target}/{os.path.basename(one)}")
        raise RuntimeError("killed")

    monkeypatch.setattr(files, "move_partitions", cut)
    with pytest.raises(RuntimeError, match="killed"):
        sinks.apply_changes(feed, view, 1)
    monkeypatch.undo()
    aside = {os.path.basename(f) for f in glob.glob(f"{view.path}/aside/1/*/day=*/*.parquet")}
    assert aside
    assert rows(sinks.read_view(spark, view)) == rows(recomputed(new))
    assert aside <= {os.path.basename(f) for f in glob.glob(f"{view.path}/*/day=*/*.parquet")}
    assert not glob.glob(f"{view.path}/aside/1/*/day=*")


def test_groups_summed_once_serve_both_views(spark, frame, view):
    coarse = sinks.KeptView(workspace(spark, "view"), ("day",), "day", {"amount": "amount", "pieces": "pieces"})
    old = lines(frame, 0).limit(0)
    for version in range(2):
        new = lines(frame, version)
        fine = sinks.summed(changes.change_feed(old, new, ["id"], version), view)
        groups = sinks.by_group(fine, view)
        assert groups.count() <= new.select("day", "kind").distinct().count() + old.select("day", "kind").distinct().count()
        sinks.apply_sums(sinks.coarser(groups, view, coarse, {}), coarse, version)
        sinks.apply_sums(fine, view, version, groups)
        assert rows(sinks.read_view(spark, view)) == rows(recomputed(new))
        assert rows(sinks.read_view(spark, coarse)) == rows(new.groupBy("day").agg(F.sum("amount").alias("amount"), F.sum("pieces").alias("pieces")))
        old = new
