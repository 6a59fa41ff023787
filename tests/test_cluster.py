"""The space-filling layout, and the audit of Parquet footers."""

from __future__ import annotations

import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tradewind import sinks, sources
from tradewind.session import workspace
from tradewind.sinks import cluster


def test_bits_in_turns(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(64), rng.randrange(64)) for _ in range(50)]

    def plain(x, y):
        return int("".join(a + b for a, b in zip(f"{x:06b}", f"{y:06b}")), 2)

    df = spark.createDataFrame(pairs, "x bigint, y bigint")
    got = df.select("x", "y", cluster.interleaved([F.col("x"), F.col("y")]).alias("z")).collect()
    assert all(r["z"] == plain(r["x"], r["y"]) for r in got)
    with pytest.raises(ValueError, match="fit"):
        cluster.interleaved([F.lit(1)] * 11)


def scanned(df):
    """Rows that the scan of ``df`` hands out, by its own figure."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().get("numOutputRows").get().value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_filters_on_either_column_skip_files(spark):
    root = workspace(spark, "curve")
    tag = root.rsplit("-", 1)[1]
    df = spark.range(40_000).selectExpr("cast(pmod(id * 7919, 365) AS int) AS day", "pmod(id * 104729, 5000) AS customer", "id", "CASE WHEN id % 500 = 0 THEN NULL ELSE id END AS other")
    table = sinks.clustered_table(df, f"curve_{tag}", ["day", "customer"], 32, root)
    assert rows(table) == rows(df)
    for cond, share in (("day BETWEEN 100 AND 120", 0.4), ("customer BETWEEN 1000 AND 1200", 0.4), ("day BETWEEN 100 AND 120 AND customer BETWEEN 1000 AND 1200", 0.15)):
        out = table.where(cond)
        assert scanned(out) <= share * 40_000
        assert out.count() == df.where(cond).count()


def test_one_value_and_nulls_and_empty(spark):
    root = workspace(spark, "curve")
    tag = root.rsplit("-", 1)[1]
    same = spark.range(1000).selectExpr("cast(NULL AS date) AS day", "5 AS customer", "id")
    assert rows(sinks.clustered_table(same, f"curve_a{tag}", ["day", "customer"], 4, f"{root}/a")) == rows(same)
    # A place that all rows share is divided among the files.
    assert spark.read.table(f"curve_a{tag}").select("_metadata.file_path").distinct().count() == 4
    assert sinks.clustered_table(same.limit(0), f"curve_b{tag}", ["day", "customer"], 4, f"{root}/b").isEmpty()


def test_footers(spark):
    root = workspace(spark, "footers")
    spark.range(5).selectExpr("id", "'x' AS Name").coalesce(1).write.parquet(f"{root}/a")
    spark.range(7).selectExpr("cast(id AS string) AS id", "true AS more").coalesce(1).write.parquet(f"{root}/b c")
    with open(f"{root}/broken.parquet", "w") as f:
        f.write("this is no Parquet file")
    audit = sources.parquet_type_audit(spark, root, "id bigint, name string")
    got = sorted((r["column"] or "", r["declared"] or "", r["found"] or "", r["status"], r["rows"]) for r in audit.where("status <> 'unreadable'").collect())
    assert got == [
        ("id", "bigint", "bigint", "ok", 5), ("id", "bigint", "string", "other_type", 7),
        ("more", "", "boolean", "undeclared", 7), ("name", "string", "", "missing", 7), ("name", "string", "string", "ok", 5),
    ]
    (bad,) = audit.where("status = 'unreadable'").collect()
    assert bad["path"].endswith("broken.parquet") and bad["found"]
