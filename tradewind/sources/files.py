"""Reading raw and curated files, and what can be said about the files themselves."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str


def _struct(spark: SparkSession, schema: Schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """CSV with a header line, columns taken by name: the order may differ from ``schema``,
    a column the file lacks is null, others are left out.

    All files below ``path`` must have the same header; one that differs is an error.
    An empty field is null, quoted or not.
    """
    wanted = _struct(spark, schema)
    try:
        header = spark.read.option("header", True).csv(path).columns  # reads one line
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], wanted)
    known = {f.name.lower(): f for f in wanted.fields}
    there = T.StructType([T.StructField(c, known[c.lower()].dataType if c.lower() in known else T.StringType()) for c in header])
    rows = spark.read.schema(there).option("header", True).option("enforceSchema", False).csv(path)
    have = {c.lower() for c in header}
    return rows.select(
        *[F.col(f"`{f.name}`").alias(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields]
    )


def read_jsonl(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """One JSON object per line; without a schema, all files are read once to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_partitioned(spark: SparkSession, root: str, fmt: str, schema: Schema | None = None, **options) -> DataFrame:
    """All files below ``root``; ``name=value`` directories become columns."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(root)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of several schema versions; a column a file lacks is null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_prefix(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_reference(spark: SparkSession, path: str, schema: Schema, fmt: str = "csv") -> DataFrame:
    """All of a reference table, whatever an incremental run has already seen."""
    return read_csv(spark, path, schema) if fmt == "csv" else read_partitioned(spark, path, fmt, schema)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def register_external(
    spark: SparkSession, name: str, path: str, schema: Schema, partition_cols: list[str] | None = None
) -> DataFrame:
    """A catalog table over existing Parquet files, its partitions discovered."""
    fields = _struct(spark, schema).fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parted} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.read.table(name)


def schema_drift(found: DataFrame | T.StructType, declared: Schema, spark: SparkSession | None = None) -> DataFrame:
    """(column, declared, found, change): added, removed or retyped columns.

    Only the two schemas are compared; no row is read.
    """
    spark = spark or found.sparkSession
    found_schema = found if isinstance(found, T.StructType) else found.schema
    want = {f.name.lower(): f.dataType.simpleString() for f in _struct(spark, declared).fields}
    have = {f.name.lower(): f.dataType.simpleString() for f in found_schema.fields}
    lines = []
    for name in sorted(want.keys() | have.keys()):
        w, h = want.get(name), have.get(name)
        if w != h:
            lines.append((name, w, h, "added" if w is None else "removed" if h is None else "retyped"))
    return spark.createDataFrame(lines, "column string, declared string, found string, change string")


def file_inventory(df: DataFrame) -> DataFrame:
    """(file_path, file_size, rows) of the files ``df`` reads."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("rows"))


def scan_cost(df: DataFrame) -> DataFrame:
    """(files, bytes, rows) of the files that hold rows of ``df``."""
    return file_inventory(df).agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )


def land_by_filename_date(df: DataFrame, out_root: str, partition: str = "date") -> tuple[DataFrame, DataFrame]:
    """Write rows below the day found in their file's name; (landed, rejects).

    The first eight digits of the name are the day; the name is kept in
    ``source_file``. Rows of files without a readable day are the rejects.
    """
    named = df.select("*", F.col("_metadata.file_name").alias("source_file"))
    digits = F.regexp_extract("source_file", r"(\d{8})", 1)
    dated = named.withColumn(partition, F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))
    # The rebalance brings a day's rows together and still splits a day that is too big for one task.
    landing = dated.where(F.col(partition).isNotNull()).hint("rebalance", partition)
    landing.write.mode("append").partitionBy(partition).parquet(out_root)
    landed = df.sparkSession.read.schema(dated.schema).parquet(out_root)
    return landed, dated.where(F.col(partition).isNull()).drop(partition)


def load_errors(
    spark: SparkSession, path: str, schema: Schema, fmt: str = "csv", n: int | None = None, header: bool = True
) -> DataFrame:
    """(file_name, modified, raw_record, reason): records that do not fit ``schema``,
    all of them, or the ``n`` first with the newest file first.

    The reason names the columns whose text does not parse.
    """
    declared = _struct(spark, schema)
    names = [f.name for f in declared.fields]
    with_raw = T.StructType([*declared.fields, T.StructField("_raw", T.StringType())])
    # The permissive reader tells which records are bad and keeps their text.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"}
    if fmt == "csv":
        options["header"] = str(header)
    rows = spark.read.format(fmt).schema(with_raw).options(**options).load(path)
    bad = rows.where("_raw IS NOT NULL").select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_raw").alias("raw_record"),
        F.struct(*names).alias("_typed"),
    )
    as_text = ", ".join(f"`{n}` string" for n in names)
    parse = F.from_csv if fmt == "csv" else F.from_json
    fields = bad.withColumn("_text", parse("raw_record", as_text))
    unread = [F.col("_text")[n].isNotNull() & F.col("_typed")[n].isNull() for n in names]
    wrong = F.filter(F.array(*[F.when(u, F.lit(n)) for u, n in zip(unread, names)]), lambda c: c.isNotNull())
    malformed = F.concat(F.lit("malformed record, expected "), F.lit(f"{len(names)} columns"))
    reason = F.when(F.size(wrong) > 0, F.concat(F.lit("bad value in "), F.array_join(wrong, ", "))).otherwise(malformed)
    audit = fields.withColumn("reason", reason).drop("_text", "_typed")
    if n is None:
        return audit
    return audit.orderBy(F.desc("modified"), "file_name", "raw_record").limit(n)
