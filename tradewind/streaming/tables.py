"""JSON-lines streams into a catalog table, batch by batch, whose schema grows on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH, RESCUED = "_batch", "_rescued"
_STREAM = "tradewind.stream"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_stream_table(spark: SparkSession, name: str, known: T.StructType, checkpoint: str, path: str | None = None) -> None:
    """The table ``name`` with the ``known`` columns, for the stream of ``checkpoint`` alone,
    as batch numbers are that stream's; a table that is there is left as it is."""
    if spark.catalog.tableExists(name):
        owner = spark.sql(f"SHOW TBLPROPERTIES {name} ('{_STREAM}')").first().value
        if owner != checkpoint:
            raise ValueError(f"table {name} is filled by the stream of {owner}")
        return
    cols = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in known)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE {name} ({cols}, {RESCUED} string, {BATCH} bigint) USING parquet PARTITIONED BY ({BATCH}){place}"
        f" TBLPROPERTIES ('{_STREAM}' = '{checkpoint}')"
    )


def found_columns(records: DataFrame) -> T.StructType:
    """The fields that the JSON objects of the variant column ``v`` have, with their types."""
    text = records.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not text or not text.startswith("OBJECT<"):
        return T.StructType()
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def _widen(spark: SparkSession, name: str, found: T.StructType, infer_types: bool) -> None:
    have = {c.lower() for c in spark.read.table(name).columns}
    new = []
    for f in found:
        if f.name.lower() not in have:
            have.add(f.name.lower())
            plain = infer_types and not isinstance(f.dataType, (T.NullType, T.VariantType, T.StructType, T.ArrayType))
            new.append(f"{_quoted(f.name)} {f.dataType.simpleString() if plain else 'string'}")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")


def _field(name: str, kind: str) -> Column:
    """The field ``name`` of the variant object ``v``, null if it is not of the kind."""
    quote = '"' if "'" in name else "'"
    if quote in name or "\\" in name:  # no path can name it
        return F.try_variant_get("v", "$", "map<string,string>")[name].try_cast(kind)
    return F.try_variant_get("v", f"$[{quote}{name}{quote}]", kind)


def write_batch(lines: DataFrame, batch: int, name: str, infer_types: bool = False) -> None:
    """Let partition ``batch`` of the table hold the JSON ``lines`` (column ``value``) and no
    others, so that a batch repeated after a crash adds nothing.

    Fields the table lacks become new columns, as text unless ``infer_types``; earlier
    rows are null there. A value that does not fit its column is null, a line that is no
    JSON object is kept as it is in ``_rescued``, and an empty line is nothing.
    """
    spark = lines.sparkSession
    parsed = lines.where(F.trim("value") != "").select("value", F.try_parse_json("value").alias("v"))
    _widen(spark, name, found_columns(parsed), infer_types)
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT<"), F.lit(False))
    cols = []
    for f in spark.read.table(name).schema:
        if f.name == BATCH:
            cols.append(F.lit(batch).cast("bigint").alias(BATCH))
        elif f.name == RESCUED:
            cols.append(F.when(~is_object, F.col("value")).alias(RESCUED))
        else:
            cols.append(F.when(is_object, _field(f.name, f.dataType.simpleString())).alias(f.name))
    writer = parsed.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.insertInto(name)


def stream_json_to_table(
    spark: SparkSession, src: str, name: str, known: T.StructType, checkpoint: str,
    path: str | None = None, infer_types: bool = False, files_per_batch: int | None = None,
) -> DataFrame:
    """Take the JSON-lines files below ``src`` that no earlier run took, until none is left,
    into the table ``name``; the table afterwards.

    The checkpoint notes which files make up a batch before the batch is written, and the
    batch's number is its partition: killed at any point, a rerun leaves each line once.
    """
    create_stream_table(spark, name, known, checkpoint, path)
    stream = spark.readStream.format("text").option("recursiveFileLookup", True).option("maxFileAge", "100000d")
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def each(lines: DataFrame, batch: int) -> None:
        write_batch(lines, batch, name, infer_types)

    query = stream.load(src).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    # Batches are written by a session of the stream's own; this one may know older files.
    spark.catalog.refreshTable(name)
    return spark.read.table(name)
