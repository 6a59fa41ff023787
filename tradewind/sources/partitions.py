"""Reading date-partitioned directories without listing or scanning all of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Schema
from .fs import existing


def _day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def pruned_scan(
    df: DataFrame,
    date_col: str,
    lo: Any,
    hi: Any,
    extra: str | Column | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Rows of the days ``lo`` to ``hi``. The filter is on the partition column as it
    is, so directories outside the range are never opened."""
    out = df.where(F.col(date_col).between(F.lit(_day(lo)), F.lit(_day(hi))))
    if extra is not None:
        out = out.where(extra)
    return out.orderBy(*order) if order else out


def projected_paths(root: str, col: str, start: str | dt.date, end: str | dt.date) -> list[str]:
    """The directories a daily layout has from ``start`` to ``end``, by rule."""
    first, last = _day(start), _day(end)
    return [f"{root}/{col}={first + dt.timedelta(days=i)}" for i in range((last - first).days + 1)]


def projected_scan(
    spark: SparkSession, root: str, col: str, start: str | dt.date, end: str | dt.date, schema: Schema
) -> DataFrame:
    """The Parquet rows of a date range, found by path rule instead of by listing
    ``root`` or asking a catalog. A day without a directory has no rows.

    ``schema`` includes the partition column.
    """
    there = existing(spark, projected_paths(root, col, start, end))
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*there)


def partition_gaps(df: DataFrame, date_col: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """(date_col): the days from ``start`` to ``end`` on which ``df`` has no rows."""
    days = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(_day(start)), F.lit(_day(end)))).alias(date_col)
    )
    seen = df.select(F.col(date_col).cast("date").alias(date_col)).distinct()
    return days.join(seen, date_col, "left_anti")
