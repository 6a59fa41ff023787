"""Small files of a partitioned table packed into larger ones, behind readers' backs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import split_join
from ..sources.fs import remove_tree
from .files import stored

TARGET = 128 << 20


@dataclass(frozen=True)
class Compaction:
    """What :func:`compact_table` has done: the partitions with their files before and after,
    and the folders that the table no longer uses."""

    report: DataFrame
    replaced: list[str]


def _files(df: DataFrame, part: str) -> DataFrame:
    """(part, _file, bytes): the inventory of the files that hold rows."""
    file, size = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("bytes")
    return df.select(F.col(part), file, size).groupBy(part, "_file").agg(F.max("bytes").alias("bytes"))


def packed(files: DataFrame, part: str, target_bytes: int = TARGET) -> DataFrame:
    """``files`` (part, _file, bytes) of the partitions that have more files than their bytes
    need, with the bin each goes to: files in order of name, a new bin wherever the sum passes a
    multiple of ``target_bytes``."""
    upto = Window.partitionBy(part).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(part)
    before = F.coalesce(F.sum("bytes").over(upto), F.lit(0))
    binned = files.withColumn("_bin", F.floor(before / target_bytes).cast("int"))
    bins = F.max("_bin").over(whole) + 1
    return binned.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_bins", bins).where("_n > _bins")


def compact_table(spark: SparkSession, name: str, part: str, target_bytes: int = TARGET, only: Column | None = None) -> Compaction:
    """Rewrite the partitions of the catalog table ``name`` that hold needlessly many files;
    ``only`` (a condition on ``part``) keeps to some of them. Rows stay as they are.

    The new files of all these partitions are written to a folder of their own; then the
    table's partitions are pointed there one by one. A reader of the table sees the old or
    the new files of a partition, never both. Cut off at any point, the rest is done by the
    next run; what was written in vain is a folder no partition uses. The replaced folders are
    the caller's to remove, with :func:`remove_replaced`, once no reader is left in them.
    One writer at a time: what another adds to these partitions meanwhile goes with them.
    """
    table = spark.read.table(name)
    if only is not None:
        table = table.where(only)
    # The inventory is taken once: names of files, their sizes and bins.
    plan = stored(packed(_files(table, part), part, target_bytes), "compaction")
    before = plan.groupBy(part).agg(F.count(F.lit(1)).alias("files_before"), F.max("_bins").alias("bins"), F.sum("bytes").alias("bytes"))
    parts = before.select(part).collect()  # one name a partition
    place = f"{_location(spark, name)}/_compacted-{uuid.uuid4().hex[:12]}"
    report = before.select(part, "files_before", "bytes").withColumn("folder", F.lit(place))
    if not parts:
        return Compaction(report, [])
    rows = table.withColumn("_file", F.col("_metadata.file_path"))
    # A file is in one partition, so its name is all that rows and plan are joined by.
    dealt = split_join(rows, plan.select("_file", "_bin"), "_file").drop("_file")
    bins = before.agg(F.sum("bins")).first()[0]
    dealt.repartition(bins, part, "_bin").drop("_bin").write.partitionBy(part).parquet(place)
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    replaced = []
    for (value,) in parts:
        text = None if value is None else str(value)
        spec = f"PARTITION ({part} = " + ("null" if value is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'") + ")"
        folder = utils.getPartitionPathString(part, text).replace("'", "\\'")
        replaced.append(_location(spark, f"{name} {spec}"))
        spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{place}/{folder}'")
    spark.catalog.refreshTable(name)
    return Compaction(report, replaced)


def _location(spark: SparkSession, what: str) -> str:
    """Where a table, or one partition of it, lies."""
    rows = spark.sql(f"DESCRIBE EXTENDED {what}").collect()
    return [r["data_type"] for r in rows if r["col_name"] == "Location"][0]


def remove_replaced(spark: SparkSession, done: Compaction) -> None:
    """Delete the folders that the table no longer uses."""
    for folder in done.replaced:
        remove_tree(spark, folder)
