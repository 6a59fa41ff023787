"""Versions of a table whose changes are found by comparing checksums of buckets first.

A version is written in buckets by key, a directory each, and beside it one line per
bucket: its rows and two checksums that do not depend on their order, and where the rows
are: a bucket that is as it was is not written again. Between two versions only the buckets
whose lines differ are read and joined.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import change_feed, checksum
from ..sources.fs import exists, read_text, write_text

_BUCKET = "_bucket"


@dataclass(frozen=True)
class VersionedTable:
    """Versions below ``path``; ``keys`` are unique and not null; ``buckets`` is the same for
    all versions, chosen so that the rows of one are a task's work."""

    path: str
    keys: Sequence[str]
    buckets: int

    def rows_at(self, version: int) -> str:
        return f"{self.path}/rows/version={version}"

    def sums_at(self, version: int) -> str:
        return f"{self.path}/checksums/version={version}"

    def schema_at(self, version: int) -> str:
        return f"{self.path}/schemas/{version}.json"


def save_version(df: DataFrame, table: VersionedTable, version: int) -> DataFrame:
    """Write ``df`` as ``version``; a version written again is replaced. Its rows.

    A bucket with the checksums it had in the version before is not written again: the rows
    lie where they are. So ``df`` is read twice, and should be a stored frame. A version that
    is written again gets a folder of its own, as a later one may share rows of the first.
    """
    spark, cols = df.sparkSession, df.columns
    shape = df.schema.simpleString()
    bucket = F.pmod(F.xxhash64(*table.keys), F.lit(table.buckets)).cast("int")
    dealt, kept = df.withColumn(_BUCKET, bucket), []
    if exists(spark, f"{table.sums_at(version - 1)}/_SUCCESS"):
        # As many lines as there are buckets at most.
        kept = _sums(spark, table, version - 1).join(_checksums(dealt, cols, shape), [_BUCKET, *_SUMS], "left_semi").collect()
        dealt = dealt.where(~F.col(_BUCKET).isin([r[_BUCKET] for r in kept]))
    place, again = f"version={version}", 0
    while exists(spark, f"{table.path}/rows/{place}"):
        again += 1
        place = f"version={version}.{again}"
    dealt.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{table.path}/rows/{place}")
    write_text(spark, table.schema_at(version), df.schema.json())
    written = spark.read.schema(T.StructType(list(df.schema.fields)).add(_BUCKET, "integer")).parquet(f"{table.path}/rows/{place}")
    sums = _checksums(written, cols, shape).withColumn("place", F.lit(place)).select(*_LINE.names)
    sums = sums.union(spark.createDataFrame([tuple(r[c] for c in _LINE.names) for r in kept], _LINE))
    sums.coalesce(1).write.mode("overwrite").parquet(table.sums_at(version))
    return read_version(spark, table, version)


# The names and types of the columns count too: another shape changes every bucket.
_SUMS = ["rows", "one", "two", "shape"]
_LINE = T.StructType().add(_BUCKET, "integer").add("rows", "long")
for _text in ("one", "two", "shape", "place"):
    _LINE = _LINE.add(_text, "string")


def _checksums(dealt: DataFrame, cols: Sequence[str], shape: str) -> DataFrame:
    """One line for each bucket."""
    sums = dealt.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("rows"), checksum(cols, 1).alias("one"), checksum(cols, 2).alias("two"))
    return sums.withColumn("shape", F.lit(shape))


def _sums(spark: SparkSession, table: VersionedTable, version: int) -> DataFrame:
    """The lines of a version, with the folder its rows are in."""
    return spark.read.schema(_LINE).parquet(table.sums_at(version)).fillna(f"version={version}", ["place"])


def _rows(spark: SparkSession, table: VersionedTable, version: int, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets."""
    schema = T.StructType.fromJson(json.loads(read_text(spark, table.schema_at(version)))).add(_BUCKET, "integer")
    places: dict[str, list[int]] = {}
    for line in _sums(spark, table, version).collect():
        if buckets is None or line[_BUCKET] in buckets:
            places.setdefault(line["place"], []).append(line[_BUCKET])
    rows = spark.createDataFrame([], schema)
    for i, (place, held) in enumerate(sorted(places.items())):
        found = spark.read.schema(schema).parquet(f"{table.path}/rows/{place}").where(F.col(_BUCKET).isin(held))
        rows = found if i == 0 else rows.union(found)
    return rows


def read_version(spark: SparkSession, table: VersionedTable, version: int) -> DataFrame:
    return _rows(spark, table, version).drop(_BUCKET)


def changed_buckets(spark: SparkSession, table: VersionedTable, old: int, new: int) -> list[int]:
    """The buckets in which two versions differ: as many numbers as there are buckets at most."""
    a, b = (_sums(spark, table, v).select(_BUCKET, F.struct(*_SUMS).alias(name)) for v, name in ((old, "_a"), (new, "_b")))
    differ = a.join(b, _BUCKET, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return sorted(r[0] for r in differ.select(_BUCKET).collect())


def version_feed(spark: SparkSession, table: VersionedTable, old: int, new: int) -> DataFrame:
    """The row changes from version ``old`` to ``new`` (see ``change_feed``), as those of
    ``new``. Only buckets that differ are read. A column that ``old`` lacks is null there."""
    buckets = changed_buckets(spark, table, old, new)
    a, b = (_rows(spark, table, v, buckets).drop(_BUCKET) for v in (old, new))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in b.schema if f.name not in a.columns]
    return change_feed(a.select("*", *missing), b, table.keys, new)
