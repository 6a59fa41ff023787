"""Helpers the text operators share: row-wise Arrow tasks, working tables, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import workspace

WHITESPACE = b" \t\n\x0b\x0c\r"


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``; other columns never clash."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def texts(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


SLICE_BYTES = 2 << 20


def _slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Every row, in batches of about ``size`` bytes: Python objects take several times
    the bytes of the texts they are made from."""
    for b in batches:
        if b.num_rows:
            step = max(1, b.num_rows // max(1, b.nbytes // size))
            for first in range(0, b.num_rows, step):
                yield b.slice(first, step)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object] | None], ddl: str, done: Callable[[], None] = lambda: None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``fn`` on every Arrow batch; it returns the columns of ``ddl`` by name. ``done`` is
    called when a task has no more batches."""
    spark_schema = schema_of(ddl)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, slice_bytes):
            if (out := fn(b)) is not None:
                yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)
        done()

    return df.mapInArrow(run, spark_schema)


@contextmanager
def small_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """While it is open, what runs gets its rows in Arrow batches of about ``size`` (such as
    ``8m``) and not of Spark's setting: for rows that grow in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def append(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], ddl: str) -> DataFrame:
    """``df`` with the columns of ``ddl`` that ``fn`` computes from each batch.

    The caller picks names that ``df`` lacks (see ``fresh``).
    """
    added = schema_of(ddl)
    spark_schema = T.StructType([*df.schema.fields, *added.fields])
    more = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            out = fn(b)
            cols = [*b.columns, *(_array(out[f.name], f.type) for f in more)]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema([*b.schema, *more]))

    return df.mapInArrow(run, spark_schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read back, and the place: lineage ends
    here, and a lost executor costs no more than a reread."""
    path = workspace(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), path


def stored(df: DataFrame, label: str) -> DataFrame:
    return stored_at(df, label)[0]


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a working table that this library wrote."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def hex_of(values: np.ndarray) -> list[str]:
    """Unsigned 64-bit integers as 16 lowercase hex digits."""
    raw = values.astype(">u8").tobytes().hex()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The connected components of an undirected graph, as (node, root).

    ``edges`` has the columns a and b (long or text, no nulls); a node's root is the
    smallest node reachable. Nodes without an edge to another node are left out.
    Rounds of large-star and small-star (Kiveris et al., "Connected components in
    MapReduce and beyond", 2014): each round hangs all neighbours below the smallest
    one, so every step is a partial-aggregate minimum and an equi-join that AQE may
    split. Each round's edges are a written table. Raises if ``max_rounds`` rounds do
    not end it; the number needed grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    edges, place = stored_at(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large-star: every larger neighbour hangs below the smallest node around.
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small-star: the smaller neighbours and the node itself hang below the smallest.
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after, there = stored_at(small.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc")
        sign = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        drop_stored(spark, place)
        edges, place = after, there
        if sign == before:
            return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")).union(edges.select("a", "a").distinct())
        before = sign
    raise RuntimeError(f"components not found in {max_rounds} rounds")


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
