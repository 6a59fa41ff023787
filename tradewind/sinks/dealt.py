"""Tables dealt into buckets by a key, with the rows of hot keys beside them.

A bucket is one task's work, so a key with many rows may not lie in one. While the rows are
written aside once, a sketch of the most frequent keys is merged from all tasks. Rows
of keys above a share, and of no key, become the head, a table without buckets; all others
the tail, hashed into buckets. Joins and aggregates of tails need no exchange; those of heads
are shuffled, and AQE splits their keys. ``name`` is a view of both.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import split_join
from ..session import workspace


@dataclass(frozen=True)
class DealtTable:
    """Tail and head of the table ``name``; ``hot`` are the keys of the head (besides null),
    fewer than ``2 * buckets / hot_share``."""

    name: str
    key: str
    tail: DataFrame
    head: DataFrame
    hot: tuple

    def read(self) -> DataFrame:
        return self.tail.unionByName(self.head)

    def is_hot(self, key: Column | str) -> Column:
        """Whether rows of this key are in the head."""
        return F.coalesce(F.col(key).isin(*self.hot) if isinstance(key, str) else key.isin(*self.hot), F.lit(False)) if self.hot else F.lit(False)


def frequent_keys(df: DataFrame, key: str, least_share: float) -> tuple[Column, Column]:
    """Aggregates over ``df``: its rows, and the keys that hold ``least_share`` of them or
    more with an upper bound of their rows, from a summary that tasks keep and merge.

    The summary's error is below half of ``least_share``: no key above it is missed, and
    one of fewer rows may be named.
    """
    most = 1 + math.ceil(2 / least_share)  # null counts as a key here
    tracked = min(1_000_000, max(1024, 8 * most))
    return F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")


def deal_table(
    df: DataFrame, name: str, key: str, buckets: int, sort: Sequence[str] | None = None, path: str | None = None, hot_share: float = 4.0
) -> DealtTable:
    """Write ``df`` as the table ``name`` (see above) and return its two parts.

    A key is hot if it has ``hot_share`` times the rows of an even bucket. ``df`` is computed
    once. Null keys are in the head: they join with nothing.
    """
    spark = df.sparkSession
    seen = Observation()
    aside = workspace(spark, "dealt")
    least = hot_share / buckets
    rows, top = frequent_keys(df, key, least)
    df.observe(seen, rows, top).write.parquet(aside)
    found = seen.get
    hot = tuple(sorted(t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] >= least * found["rows"]))
    written = spark.read.schema(df.schema).parquet(aside)
    split = DealtTable(name, key, written, written, hot).is_hot(key) | F.col(key).isNull()

    def save(writer, part: str) -> None:  # noqa: ANN001
        writer = writer.mode("overwrite").format("parquet")
        if path:
            writer = writer.option("path", f"{path}/{part}")
        writer.saveAsTable(f"{name}_{part}")

    # Shuffled to its buckets first: each task writes its own, not all of them.
    save(written.where(~split).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*(sort or [key])), "tail")
    save(written.where(split).write, "head")
    kind = df.select(key).schema
    save(spark.createDataFrame([(k,) for k in hot], kind).coalesce(1).write, "hot")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_tail UNION ALL SELECT * FROM {name}_head")
    return dealt_table(spark, name, key)


def dealt_table(spark: SparkSession, name: str, key: str) -> DealtTable:
    """The table ``name`` that :func:`deal_table` has written."""
    hot = tuple(sorted(r[0] for r in spark.read.table(f"{name}_hot").collect()))  # few: see DealtTable
    return DealtTable(name, key, spark.read.table(f"{name}_tail"), spark.read.table(f"{name}_head"), hot)


def join_dealt(left: DealtTable, right: DealtTable, how: str = "inner") -> DataFrame:
    """``left`` and ``right`` joined on their key, which has one name: inner, left,
    left_semi or left_anti.

    The rows of a key lie in one part of either side, so each row of ``left`` finds all
    its partners in one of four joins. Only the first, tail with tail, is large on both
    sides, and it needs no exchange; the others have a few keys on one side.
    """
    key = left.key
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} is no join of dealt tables")
    cool, warm = ~right.is_hot(key), right.is_hot(key)
    joined = [left.tail.where(cool).join(right.tail, key, how)]
    if right.hot:
        joined.append(split_join(left.tail.where(warm), right.head, key, how))
        joined.append(split_join(left.head.where(warm), right.head, key, how))
    joined.append(split_join(left.head.where(cool), right.tail.where(left.is_hot(key)), key, how))
    return reduce(DataFrame.unionByName, joined)


def aggregate_dealt(table: DealtTable, *aggs: Column) -> DataFrame:
    """``aggs`` per key: of the tail without an exchange, of the head's few keys after
    partial sums in the tasks. Their groups differ, so both are simply put together."""
    return table.tail.groupBy(table.key).agg(*aggs).unionByName(table.head.groupBy(table.key).agg(*aggs))
