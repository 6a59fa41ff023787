"""Catalog tables: replace, reload, insert, bucket, and a view kept by partition."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import change_feed, feed_of
from ..operators.identity import with_identity
from ..operators.joins import split_join
from ..sources.fs import exists
from .files import append_partitioned, overwrite_partitions, replace_partitions, stored


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace table ``name``; ``path`` places its files outside the warehouse folder."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.read.table(name)


def reload_staging(df: DataFrame, name: str) -> None:
    """Empty the existing table ``name`` and load ``df``, column by column name."""
    target = df.sparkSession.read.table(name)
    # Unlike a partition overwrite, this empties the table whatever ``df`` holds.
    df.select(*target.columns).write.option("partitionOverwriteMode", "static").insertInto(name, overwrite=True)


def add_rows(df: DataFrame, name: str) -> None:
    """INSERT INTO ``name`` SELECT, by column name; columns ``df`` lacks are null."""
    target = df.sparkSession.read.table(name)
    have = set(df.columns)
    cols = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema]
    df.select(*cols).write.insertInto(name)


def insert_new(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Like :func:`add_rows` for the rows whose ``keys`` the table does not have yet,
    so a load that is run again adds nothing."""
    known = df.sparkSession.read.table(name).select(*keys)
    add_rows(df.join(known, list(keys), "left_anti").select(*df.columns), name)


def _keep_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], feed: tuple[str, int]) -> None:
    """Write the changes from ``old`` rows to ``new`` ones to the folder and under the version
    of ``feed``, unless an earlier try has written them in full before it was cut off."""
    path, version = feed
    if not exists(old.sparkSession, f"{path}/_SUCCESS"):
        change_feed(old, new.select(*old.columns), keys, version).write.mode("overwrite").parquet(path)


def upsert_rows(df: DataFrame, name: str, keys: Sequence[str], feed: tuple[str, int] | None = None) -> None:
    """The rows of ``df`` take the place of those with the same ``keys``, or are added.

    Writes the whole table, as is fit for a dimension. ``keys`` are unique in ``df``.
    ``feed`` (a path and a version) keeps the row changes, before the table is touched.
    """
    new = stored(df, "upsert")
    table = df.sparkSession.read.table(name)
    if feed:
        _keep_feed(split_join(table, new.select(*keys), keys, "left_semi"), new, keys, feed)
    kept = split_join(table, new.select(*keys), keys, "left_anti")
    reload_staging(stored(kept.select(*table.columns).unionByName(new), "upsert"), name)


def upsert_partitions(
    df: DataFrame, name: str, path: str, keys: Sequence[str], part: str, feed: tuple[str, int] | None = None, number: str | None = None
) -> None:
    """Like :func:`upsert_rows` for a table at ``path`` partitioned by ``part`` (no nulls):
    only partitions whose rows change are written, and none if no row does. One that only
    gets new rows gets them in files of their own; its others stay.

    A row whose ``part`` has changed leaves its old partition. Rows are compared in groups of
    the first of ``keys`` (an order's lines), of which none should hold many rows: the table is
    summed to a line a group, and only rows of groups that are not the same are written aside
    and, if the table has the group, joined. ``feed`` (a path and a version) keeps the row
    changes, before the table is touched. ``number`` names a column that ``df`` lacks: a row
    the table has keeps its number, new ones go on from the highest, by ``part`` and ``keys``:
    rows so numbered lie in the order of the directories.
    """
    spark = df.sparkSession
    table = spark.read.table(name)
    if table.isEmpty():
        rows = with_identity(df, [part, *keys], number, unique=True) if number else stored(df, "upsert")
        _fill_partitions(rows, name, path, part, feed, gathered=number is not None)
        return
    new = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema if f.name != number])
    unlike = stored(_unlike(new, table.select(*new.columns), keys[0], part), "unlike")
    come = _as_new(unlike.where("_lo IS NULL"), table, keys, number)
    lo, hi = unlike.agg(F.min("_lo"), F.max("_hi")).first()
    known = None
    if lo is not None:
        met = unlike.where("_lo IS NOT NULL")
        concerned = split_join(table.where(F.col(part).between(lo, hi)), met.select(keys[0]).distinct(), keys[0], "left_semi")
        differ = stored(_differing(concerned, met.select(*new.columns), keys, number), "differ")
        come = come.unionByName(differ.where(F.col("_old").isNull()))
        known = differ.where(F.col("_old").isNotNull())
    if number:
        highest = table.agg(F.max(number)).first()[0] or 0
        come = with_identity(come, [f"_new.{part}", *keys], "_number", highest + 1, unique=True)
        come = come.withColumn("_new", F.col("_new").withField(number, F.col("_number"))).drop("_number")
    both = come if known is None else known.unionByName(come)
    if feed and not exists(spark, f"{feed[0]}/_SUCCESS"):
        feed_of(both, keys, table.columns, feed[1]).write.mode("overwrite").parquet(feed[0])
    kinds = {f.name: f.dataType for f in table.schema}
    values = [(F.col(c) if c in set(keys) else F.col(f"_new.{c}")).cast(kinds[c]).alias(c) for c in table.columns]
    rest = come.select(*values)
    if known is not None:
        touched = stored(known.select(F.explode(F.array(f"_old.{part}", f"_new.{part}")).alias(part)).distinct(), "touched")
        if not touched.isEmpty():
            kept = split_join(_in_parts(table, touched, part), known.select(*keys), keys, "left_anti")
            rows = split_join(both.select(*values), touched, part, "left_semi")
            replace_partitions(stored(kept.unionByName(rows).select(*table.columns), "upsert"), path, part, touched)
            rest = split_join(rest, touched, part, "left_anti")
    # A try that was cut off here finds the rows that came, as they are, when it is repeated.
    append_partitioned(rest.select(*table.columns), path, part, gathered=number is not None)
    _list_partitions(spark, name)


def _unlike(new: DataFrame, table: DataFrame, group: str, part: str) -> DataFrame:
    """The rows of ``new`` whose ``group`` is not the same in ``table``, by count and two
    checksums, with the least and the highest ``part`` (``_lo``, ``_hi``) that has the group
    there; null if none has."""
    # Null or not goes in as well: a null alone leaves a hash as it is. Keys are unique, so
    # that no two rows cancel each other out.
    cells = [x for c in new.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    marks = {f"_{k}": F.xxhash64(F.lit(k), *cells) for k in (1, 2)}
    there = table.withColumns(marks).groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), *[F.bit_xor(m).alias(f"{m}_there") for m in marks], F.min(part).alias("_lo"), F.max(part).alias("_hi")
    )
    rows = Window.partitionBy(group)
    here = new.withColumns(marks).withColumns({"_rows": F.count(F.lit(1)).over(rows), **{m: F.bit_xor(m).over(rows) for m in marks}})
    same = F.col("_rows").eqNullSafe(F.col("_n"))
    for m in marks:
        same = same & F.col(m).eqNullSafe(F.col(f"{m}_there"))
    return here.join(there, group, "left").where(~same).select(*new.columns, "_lo", "_hi")


def _as_new(rows: DataFrame, table: DataFrame, keys: Sequence[str], number: str | None) -> DataFrame:
    """``rows`` that the table lacks as :func:`_differing` gives them."""
    rest = T.StructType([f for f in table.schema if f.name not in set(keys)])
    cells = [F.lit(None).cast(f.dataType).alias(f.name) if f.name == number else F.col(f.name) for f in rest]
    return rows.select(*keys, F.lit(None).cast(rest).alias("_old"), F.struct(*cells).alias("_new"))


def _fill_partitions(new: DataFrame, name: str, path: str, part: str, feed: tuple[str, int] | None, gathered: bool) -> None:
    """The first rows of a table without rows: all of them come."""
    spark = new.sparkSession
    new = new.select(*spark.read.table(name).columns)
    if feed and not exists(spark, f"{feed[0]}/_SUCCESS"):
        come = new.select(F.lit("insert").alias("_change_type"), *new.columns, F.lit(feed[1]).cast("long").alias("_commit_version"))
        come.write.mode("overwrite").parquet(feed[0])
    overwrite_partitions(new, path, part, gathered=gathered)
    _list_partitions(spark, name)


def _list_partitions(spark: SparkSession, name: str) -> None:
    """The catalog keeps a list of a table's partitions."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def _in_parts(table: DataFrame, parts: DataFrame, part: str) -> DataFrame:
    """The rows of the partitions ``parts``: by its bounds at the scan, then by value."""
    lo, hi = parts.agg(F.min(part), F.max(part)).first()
    return split_join(table.where(F.col(part).between(lo, hi)), parts, part, "left_semi") if lo is not None else table.limit(0)


def _differing(table: DataFrame, new: DataFrame, keys: Sequence[str], number: str | None) -> DataFrame:
    """``keys``, ``_old`` and ``_new`` of the rows of ``new`` that ``table`` has not or has
    otherwise; the ``number`` comes from the table."""
    rest = [c for c in table.columns if c not in set(keys) and c != number]
    kinds = {f.name: f.dataType for f in table.schema}
    a = table.select(*keys, F.struct(*[c for c in table.columns if c not in set(keys)]).alias("_old"))
    b = new.select(*keys, *[F.col(c).cast(kinds[c]).alias(c) for c in rest])
    both = split_join(b, a, keys, "left")
    same = F.col("_old").isNotNull()
    for c in rest:
        same = same & F.col(c).eqNullSafe(F.col(f"_old.{c}"))
    now = [F.col(f"_old.{c}").alias(c) if c == number else F.col(c) for c in table.columns if c not in set(keys)]
    return both.where(~same).select(*keys, "_old", F.struct(*now).alias("_new"))


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, sort: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """Table ``name`` hashed into ``buckets`` by ``key``: joins and aggregates on
    ``key`` between such tables need no exchange.

    A bucket is one task's work when it is read; if one value of ``key`` may hold many
    rows, see :func:`tradewind.sinks.deal_table`.
    """
    # Shuffled to its buckets first: each task writes its own, not all of them.
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*(sort or [key]))
    writer = writer.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.read.table(name)


def describe_table(spark: SparkSession, name: str, comment: str, properties: Mapping[str, str] | None = None) -> None:
    """Set the comment and properties of a table."""
    text = comment.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def refresh_view(
    path: str, base: DataFrame, changed: DataFrame, aggregate: Callable[[DataFrame], DataFrame], key: str, view_key: str
) -> None:
    """Bring the aggregate stored at ``path`` up to date with ``base``.

    Only groups of a ``key`` value that occurs in ``changed`` are computed again,
    from all of ``base``'s rows of that value: distinct counts cannot be added up.
    The result is partitioned by ``view_key``, which holds the values of ``key``;
    untouched partitions stay, and one whose rows have all gone from ``base`` goes.
    """
    affected = stored(changed.select(key).distinct(), "affected")
    lo, hi, nulls = affected.agg(F.min(key), F.max(key), F.count_if(F.col(key).isNull())).first()
    # The bounds skip partitions and row groups at the scan, the join does the rest.
    within = F.col(key).between(lo, hi) if lo is not None else F.lit(False)
    touched = split_join(base.where(within), affected.where(within), key, "left_semi")
    if nulls:
        touched = touched.unionByName(base.where(F.col(key).isNull()))
    view = stored(aggregate(touched), "view")
    replace_partitions(view, path, view_key, affected.select(F.col(key).alias(view_key)))
