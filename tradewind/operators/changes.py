"""Row changes between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checksum(cols: Sequence[str], seed: int) -> Column:
    """A sum over rows of ``cols`` that does not depend on their order."""
    # Whether a value is null goes in as well: a null alone leaves a hash as it is.
    parts = [x for c in cols for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")).cast("string")


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """What turned ``old`` into ``new``, one row per change.

    ``_change_type`` is insert, delete, update_preimage or update_postimage, and
    ``_commit_version`` is ``version``. ``keys`` must be unique and not null on both sides
    (see ``latest_by``), which also keeps every join partition free of hot keys.
    """
    cols = new.columns
    # The keys go once through the join, beside the other columns, not in them too.
    rest = [c for c in cols if c not in set(keys)]
    row = F.struct(F.lit(True).alias("_here"), *rest)
    a = old.select(*keys, row.alias("_old"))
    b = new.select(*keys, row.alias("_new"))
    joined = a.join(b, list(keys), "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    return feed_of(joined, keys, cols, version)


def feed_of(joined: DataFrame, keys: Sequence[str], cols: Sequence[str], version: int) -> DataFrame:
    """The feed from rows of ``keys``, ``_old`` and ``_new`` that differ: structs of the other
    ``cols``, null where there is no such row."""

    def change(kind: str, row: str):
        return F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("_row"))

    changes = (
        F.when(F.col("_old").isNull(), F.array(change("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(change("delete", "_old")))
        .otherwise(F.array(change("update_preimage", "_old"), change("update_postimage", "_new")))
    )
    return (
        joined.select(*keys, F.explode(changes).alias("_c"))
        .select("_c._change_type", *[F.col(c) if c in set(keys) else F.col("_c._row")[c].alias(c) for c in cols])
        .withColumn("_commit_version", F.lit(version).cast("long"))
    )


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` after one version's ``changes``."""
    cols = old.columns
    gone = changes.where(F.col("_change_type").isin("delete", "update_preimage")).select(*keys)
    come = changes.where(F.col("_change_type").isin("insert", "update_postimage")).select(*cols)
    return old.join(gone, list(keys), "left_anti").unionByName(come)


def reversed_feed(changes: DataFrame) -> DataFrame:
    """``changes`` that lead back: what was inserted is deleted, and so on."""
    back = {"insert": "delete", "delete": "insert", "update_preimage": "update_postimage", "update_postimage": "update_preimage"}
    kinds = F.create_map(*[F.lit(x) for pair in back.items() for x in pair])
    return changes.withColumn("_change_type", kinds[F.col("_change_type")])
