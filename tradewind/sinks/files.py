"""Parquet sinks by path."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace
from ..sources.files import file_inventory
from ..sources.fs import exists, move_partitions, remove_partition, write_text


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_partitioned(df: DataFrame, path: str, *cols: str, gathered: bool = False) -> None:
    """Append below ``col=value`` directories, few files each: see :func:`_gathered`."""
    (df if gathered else _gathered(df, cols)).write.mode("append").partitionBy(*cols).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *cols: str, gathered: bool = False) -> None:
    """Replace the partitions ``df`` has rows for and leave the others alone. Rows that lie in
    the order of ``cols`` already are ``gathered`` and need no shuffle."""
    rows = df if gathered else _gathered(df, cols)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def replace_partitions(df: DataFrame, path: str, col: str, values: DataFrame, lies: str | None = None) -> None:
    """Let the partitions of ``values`` (one column, ``col``) hold the rows of ``df`` and
    no others; a partition ``df`` has no rows for is removed.

    ``df`` must be a stored frame that does not read ``path``. Of the values, only those
    to be removed reach the driver. Rows that lie below ``lies`` in directories of ``col``
    already are moved, not written again; ``df`` then only says which partitions they
    fill, and does not read ``lies``, so that a try that was cut off can be repeated.
    """
    if lies is None:
        overwrite_partitions(df, path, col)
    else:
        move_partitions(df.sparkSession, lies, path, col)
    if not exists(df.sparkSession, path):
        return
    there = df.select(F.col(col).alias("_there")).distinct()
    for gone in values.join(there, F.col(col).eqNullSafe(F.col("_there")), "left_anti").distinct().collect():
        remove_partition(df.sparkSession, path, col, gone[0])


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that what is used more
    than once is computed once, and survives a lost executor."""
    path = workspace(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _gathered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of one directory brought together, so not every task writes a file in
    every directory. AQE splits a directory that is too big for one task."""
    return df.hint("rebalance", *cols)


def publish_snapshot(df: DataFrame, path: str, spark: SparkSession | None = None) -> str:
    """Write ``df`` and a manifest of its files with their lengths; the manifest's path.

    A reader of the manifest sees the whole snapshot or, before it is there, none.
    """
    spark = spark or df.sparkSession
    df.write.mode("error").parquet(f"{path}/data")
    written = spark.read.parquet(f"{path}/data")
    # One entry per file with rows: as many lines as the manifest itself has. Spark gives
    # paths percent-encoded; readers take them plain.
    files = file_inventory(written).orderBy("file_path").select("file_path", "file_size").collect()
    entries = [{"url": unquote(f.file_path), "mandatory": True, "meta": {"content_length": f.file_size}} for f in files]
    manifest = f"{path}/manifest.json"
    write_text(spark, manifest, json.dumps({"entries": entries}, indent=1))
    return manifest
