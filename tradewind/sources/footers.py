"""Types in the footers of Parquet files, read by tasks, against the declared ones."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .files import Schema, _struct
from .fs import listed

# Stores that can be asked for the end of a file alone; from others the file comes whole.
_BY_RANGE = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
_FOOTERS = "path string, rows bigint, position int, column string, found string, error string"


def _kind(kind: pa.DataType) -> str:
    try:
        return from_arrow_type(kind).simpleString()
    except Exception:  # a type Spark has no name for
        return str(kind)


def _place(path: str) -> tuple[pa.fs.FileSystem, str]:
    if path.startswith(("/", "file:")):
        return pa.fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return pa.fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/@"))


def _footer(path: str, content: bytes | None) -> list[tuple]:
    try:
        if content is not None:
            source = pa.BufferReader(content)
        else:
            store, place = _place(path)
            source = store.open_input_file(place)
        with source:
            meta = pq.read_metadata(source)
        return [(path, meta.num_rows, i, f.name, _kind(f.type), None) for i, f in enumerate(meta.schema.to_arrow_schema())]
    except (pa.ArrowInvalid, OSError) as e:
        return [(path, None, None, None, None, str(e).split("\n")[0])]


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """(path, rows, position, column, found, error): one line per column of each Parquet file
    below ``path``; a file whose footer cannot be read is one line with the error."""
    scheme = path.split("://")[0] if "://" in path else path.split(":/")[0] if ":/" in path else "file"
    ranged = scheme in _BY_RANGE
    names = listed(spark, path).where("path LIKE '%.parquet'").select("path")
    if ranged:
        files = names.repartition(spark.sparkContext.defaultParallelism)  # names only
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            contents = [None] * b.num_rows if ranged else b.column("content").to_pylist()
            for name, content in zip(b.column("path").to_pylist(), contents):
                lines = _footer(name, content)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), kinds)], names=columns)

    columns = [c.split()[0] for c in _FOOTERS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    return files.mapInArrow(run, _FOOTERS)


def parquet_type_audit(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """(path, column, declared, found, status, rows), one line per file and column: ``ok``,
    ``other_type``, ``missing`` (declared, not in the file), ``undeclared`` or ``unreadable``
    (the file as a whole; found is the error). Names are compared without regard to case."""
    declared = F.array(*[F.struct(F.lit(f.name).alias("_name"), F.lit(f.dataType.simpleString()).alias("declared")) for f in _struct(spark, schema)])
    footers = parquet_footers(spark, path)
    bad = footers.where("error IS NOT NULL").select("path", F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("declared"), F.col("error").alias("found"), F.lit("unreadable").alias("status"), "rows")
    good = footers.where("error IS NULL")
    wanted = good.groupBy(F.col("path").alias("_path")).agg(F.max("rows").alias("_rows")).select("_path", "_rows", F.inline(declared))
    both = wanted.join(good, (F.col("_path") == F.col("path")) & (F.lower("_name") == F.lower("column")), "full_outer")
    status = F.when(F.col("column").isNull(), "missing").when(F.col("_name").isNull(), "undeclared").when(F.col("declared") == F.col("found"), "ok").otherwise("other_type")
    lines = both.select(F.coalesce("path", "_path").alias("path"), F.coalesce("_name", "column").alias("column"), "declared", "found", status.alias("status"), F.coalesce("rows", "_rows").alias("rows"))
    return lines.unionByName(bad)
