"""Shaping and deduplicating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fill

ColumnOrName = Column | str
Spec = Sequence[tuple[str, str]]


def safe_select(df: DataFrame, spec: Spec) -> DataFrame:
    """Exactly the columns of ``spec``: cast where present, a typed null where absent.

    ``try_cast`` keeps a bad value from failing the job under ANSI mode: it turns
    null and is left to the quality rules.
    """
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(name).try_cast(kind) if name.lower() in present else F.lit(None).cast(kind)).alias(name)
            for name, kind in spec
        ]
    )


def spec_of(schema: T.StructType) -> list[tuple[str, str]]:
    """A struct type as the list ``safe_select`` takes."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` are all present. Plain null tests, which a scan can take over."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]))


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Each column with its default in place of null; the columns keep their types."""
    return df.withColumns({c: fill(c, F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()})


def with_reason(df: DataFrame, reason: str, col: str = "dq_failure_reason") -> DataFrame:
    return df.withColumn(col, F.lit(reason))


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def between_dates(df: DataFrame, col: ColumnOrName, lo: Any, hi: Any) -> DataFrame:
    """Rows with ``lo <= col <= hi``."""
    c = F.col(col) if isinstance(col, str) else col
    return df.where(c.between(F.lit(lo), F.lit(hi)))


def union_evolving(*dfs: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName], null_keys: bool = False
) -> DataFrame:
    """One row per key: the first under ``order``, ties settled by all other columns.

    Rows with a null key are dropped, or with ``null_keys`` count as one key. The
    ``row_number() = 1`` form makes Spark keep one row per key in every map task
    before it shuffles, so many copies of one key never meet in a single task.
    """
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in set(keys)]
    first = Window.partitionBy(*keys).orderBy(*ordering, *rest)
    if not null_keys:
        df = require_keys(df, keys)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def dedup(df: DataFrame, keys: Sequence[str], null_keys: bool = False) -> DataFrame:
    """One row per key, the least under all other columns, so reruns agree."""
    return latest_by(df, keys, [], null_keys)


def dropped_by_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows :func:`dedup` takes away: (rows, kept, dropped)."""
    per_key = require_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("kept")
    ).withColumn("dropped", F.col("rows") - F.col("kept"))


def top_k(df: DataFrame, order: Sequence[ColumnOrName], k: int) -> DataFrame:
    """The first ``k`` rows: each task keeps ``k``, then they are merged."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int, order: Sequence[ColumnOrName] | None = None) -> DataFrame:
    """``n`` rows; ordered by all columns unless told otherwise, so it can be repeated."""
    return top_k(df, order or df.columns, n)
