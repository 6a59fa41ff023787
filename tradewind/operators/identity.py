"""Surrogate keys without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import workspace


def with_identity(
    df: DataFrame, order: Sequence[str], name: str = "id", start: int = 1, partitions: int | None = None, unique: bool = False
) -> DataFrame:
    """Number the rows ``start, start + 1, …`` in the order of ``order``.

    The rows are range-partitioned on ``order`` and sorted inside each partition;
    a row's number is its place there plus the rows in the partitions before it.
    Both parts come from one written copy: a range partitioning that is computed
    twice, or again after a lost executor, may cut elsewhere. Rows equal under
    ``order`` are told apart by a hash of all columns, so that a value many rows
    share does not fill one partition; ``unique`` says that there are none, and saves the hash.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = workspace(spark, "identity")
    # The low 33 bits of monotonically_increasing_id are the place in the partition.
    by = list(order) if unique else [*order, "_tie"]
    placed = (
        (df if unique else df.withColumn("_tie", F.xxhash64(*df.columns)))
        .repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .select("*", F.monotonically_increasing_id().alias("_at"))
        .withColumns(
            {
                "_slice": F.shiftright("_at", 33).cast("int"),
                "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
        .drop("_at")
    )
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)

    # One row per slice, so at most `n` rows: the window and the broadcast are bounded.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = stored.join(F.broadcast(offsets), "_slice")
    return numbered.select((F.col("_offset") + F.col("_place") + F.lit(start)).alias(name), *df.columns)
