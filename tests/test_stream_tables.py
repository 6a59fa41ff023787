"""JSON streams into a table by name: crashes, new columns, odd lines."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import workspace
from tradewind.streaming import create_stream_table, stream_json_to_table, tables

KNOWN = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("customer_id", T.LongType())])


@pytest.fixture
def place(spark):
    root = workspace(spark, "stream-table")
    return root, f"t{root.rsplit('-', 1)[1]}"


def deliver(root, file, *lines):
    os.makedirs(f"{root}/raw", exist_ok=True)
    with open(f"{root}/raw/{file}", "w") as out:
        out.write("\n".join(lines))


def run(spark, place, **options):
    root, name = place
    return stream_json_to_table(spark, f"{root}/raw", name, KNOWN, f"{root}/checkpoint", f"{root}/table", **options)


def test_killed_between_write_and_commit(spark, place, monkeypatch):
    root, name = place
    for i in range(3):
        deliver(root, f"{i}.json", *[f'{{"session_id": "s{i}{j}", "customer_id": {j}}}' for j in range(5)])
    real = tables.write_batch

    def cut(lines, batch, *rest):
        real(lines, batch, *rest)
        if batch == 1:
            raise RuntimeError("killed")

    monkeypatch.setattr(tables, "write_batch", cut)
    with pytest.raises(Exception, match="killed"):
        run(spark, place, files_per_batch=1)
    monkeypatch.setattr(tables, "write_batch", real)
    assert spark.read.table(name).count() == 10  # written, not committed
    out = run(spark, place, files_per_batch=1)
    assert out.count() == out.select("session_id").distinct().count() == 15
    assert run(spark, place).count() == 15
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 15


def test_columns_grow_and_odd_lines_stay(spark, place):
    root, name = place
    deliver(root, "a.json", '{"session_id": "a", "customer_id": 1}', "", "no json {", "[1, 2]", "null", '{"session_id": 7, "customer_id": "x"}')
    assert run(spark, place).columns == ["session_id", "customer_id", "_rescued", "_batch"]
    deliver(root, "b.json", '{"SESSION_ID": "other case", "customer_id": 2, "it\'s new": {"deep": [1]}, "plain": true, "nothing": null, "both \\" and \'": 5}')
    out = run(spark, place)
    assert out.columns == ["session_id", "customer_id", "_rescued", "both \" and '", "it's new", "nothing", "plain", "_batch"]
    assert sorted(r[0] for r in out.select("`both \" and '`").dropna().collect()) == ["5"]
    rows = {(r["session_id"], r["customer_id"], r["_rescued"], r["it's new"], r["plain"]) for r in out.collect()}
    assert rows == {
        ("a", 1, None, None, None), ("7", None, None, None, None),
        (None, None, "no json {", None, None), (None, None, "[1, 2]", None, None), (None, None, "null", None, None),
        (None, 2, None, '{"deep":[1]}', "true"),
    }


def test_types_are_inferred_if_asked(spark, place):
    root, _ = place
    deliver(root, "a.json", '{"n": 3, "d": 1.5, "b": false, "l": [1]}')
    kinds = dict(run(spark, place, infer_types=True).dtypes)
    assert (kinds["n"], kinds["b"], kinds["l"]) == ("bigint", "boolean", "string")


def test_another_stream_is_refused_and_nothing_to_read(spark, place):
    root, name = place
    os.makedirs(f"{root}/raw")
    assert run(spark, place).isEmpty()
    with pytest.raises(ValueError, match="filled by"):
        create_stream_table(spark, name, KNOWN, f"{root}/another")
    assert spark.read.table(name).where(F.col("_batch") >= 0).isEmpty()
