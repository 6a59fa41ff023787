"""Append-only file streams into bronze, run to completion."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.fs import exists, read_text, write_text

# Files are told apart by name alone, in the stream's checkpoint: one that arrives with an
# old date, as after a backfill or a copy that keeps dates, is as new as any other.
_ANY_AGE = "100000d"


def stream_to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None
) -> None:
    """Append everything that is available now to the Parquet files at ``path``.

    What was read is kept in ``checkpoint`` and what was written in the sink's own
    log, so a run that is repeated, or killed half-way, adds each row once.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()


def open_stream(
    spark: SparkSession, src: str, schema: T.StructType | str, fmt: str = "json", max_file_age: str = _ANY_AGE, **options
) -> DataFrame:
    """The files below ``src`` as a stream.

    ``max_file_age``: set it only to have a new file overlooked that was modified this
    much before the newest one already read; by default none is.
    """
    return (
        spark.readStream.schema(schema)
        .format(fmt)
        .option("maxFileAge", max_file_age)
        .options(**options)
        .load(src)
    )


def ingest_stream(
    spark: SparkSession, src: str, schema: T.StructType | str, out: str, checkpoint: str, fmt: str = "json", **options
) -> DataFrame:
    """Take the files below ``src`` that no earlier run took and append their rows to
    ``out``; all of ``out`` afterwards."""
    stream_to_table(open_stream(spark, src, schema, fmt, **options), out, checkpoint)
    return read_ingested(spark, out, schema)


def read_ingested(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """What the sink at ``out`` has committed; columns that older files lack are null."""
    if not exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def evolve_schema(
    spark: SparkSession, src: str, schema_path: str, fmt: str = "json", infer_types: bool = False
) -> T.StructType:
    """The schema stored at ``schema_path``, widened by new columns found in ``src``.

    Only files that no earlier call has looked at are read, whatever their date; their
    names are kept in a table beside ``schema_path``. A known column keeps its type; a
    new one goes at the end, as a string unless ``infer_types``. Call it before each
    start of the stream.
    """
    stored = read_text(spark, schema_path)
    known = T.StructType.fromJson(json.loads(stored)["schema"]) if stored else T.StructType()
    seen_path = f"{schema_path}.files"
    try:
        here = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(src).select("path")
        if exists(spark, seen_path):
            here = here.join(spark.read.schema("path string").parquet(seen_path), "path", "left_anti")
        new = [r.path for r in here.collect()]  # names of the files to come, not their rows
        found = spark.read.format(fmt).option("primitivesAsString", not infer_types).load(new).schema if new else T.StructType()
    except AnalysisException as e:
        # No file, or none with a row.
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        new, found = [], T.StructType()
    names = {f.name.lower() for f in known.fields}
    merged = T.StructType([*known.fields, *[f for f in found.fields if f.name.lower() not in names]])
    # The schema first: a run that ends between the two looks at the files again.
    write_text(spark, schema_path, json.dumps({"schema": merged.jsonValue()}))
    if new:
        spark.createDataFrame([(p,) for p in new], "path string").coalesce(1).write.mode("append").parquet(seen_path)
    return merged
