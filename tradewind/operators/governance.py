"""Column access by tags, role masks and row filters, all as projections and filters.

Tags and grants are configuration of a few dozen lines and are resolved on the
driver; the data only ever sees a ``select`` or a ``where``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mask_email, mask_for_role

Tag = tuple[str, str, str]  # (resource "db", "db.table" or "db.table.column"; key; value)


@dataclass(frozen=True)
class Grant:
    """``principal`` may read whatever carries ``key=value`` as its effective tag."""

    principal: str
    key: str
    value: str
    permissions: frozenset[str] = frozenset({"SELECT", "DESCRIBE"})


class AccessDenied(Exception):
    """A principal asked for a column none of its grants covers."""


def effective_tags(tags: Iterable[Tag], resource: str) -> dict[str, str]:
    """Each key's value for ``resource``: its own tag, else its table's, else its database's."""
    own = {(r.lower(), k): v for r, k, v in tags}
    parts = resource.lower().split(".")
    found: dict[str, str] = {}
    for depth in range(len(parts), 0, -1):
        level = ".".join(parts[:depth])
        for (name, key), value in own.items():
            if name == level:
                found.setdefault(key, value)
    return found


def permitted_columns(
    cols: Sequence[str], table: str, tags: Iterable[Tag], grants: Iterable[Grant], who: str
) -> list[str]:
    tags = list(tags)
    held = {(g.key, g.value) for g in grants if g.principal == who and "SELECT" in g.permissions}
    return [c for c in cols if held & set(effective_tags(tags, f"{table}.{c}").items())]


def secure_select(
    df: DataFrame,
    table: str,
    tags: Iterable[Tag],
    grants: Iterable[Grant],
    who: str,
    cols: Sequence[str] | None = None,
    deny: str = "raise",
) -> DataFrame:
    """``cols`` of ``df`` as ``who`` may see them.

    A column without a grant raises :class:`AccessDenied`, or is left out with
    ``deny="omit"``.
    """
    wanted = list(cols or df.columns)
    allowed = permitted_columns(wanted, table, tags, grants, who)
    denied = [c for c in wanted if c not in allowed]
    if denied and (deny == "raise" or not allowed):
        raise AccessDenied(f"{who} may not read {', '.join(denied)} of {table}")
    return df.select(*allowed)


def tag_report(cols: Sequence[str], table: str, tags: Iterable[Tag], spark: SparkSession) -> DataFrame:
    """(column, key, value): the effective tags of a table's columns."""
    tags = list(tags)
    lines = [(c, k, v) for c in cols for k, v in sorted(effective_tags(tags, f"{table}.{c}").items())]
    return spark.createDataFrame(lines, "column string, key string, value string")


def mask_by_group(
    df: DataFrame, col: str, groups: Iterable[str], entitled: str, mask: Callable[..., Column] = mask_email
) -> DataFrame:
    """``col`` masked unless the reader is in the ``entitled`` group."""
    return df.withColumn(col, mask(col, entitled in set(groups)))


def mask_constant(df: DataFrame, col: str, roles: Iterable[str], entitled: str) -> DataFrame:
    """``col`` replaced by a constant unless the reader holds the ``entitled`` role."""
    return df.withColumn(col, mask_for_role(col, entitled in set(roles)))


def row_filter(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows the reader may see; a predicate that is unknown hides the row."""
    return df.where(predicate)


def create_mask_function(spark: SparkSession, name: str = "mask_email_sql") -> str:
    """Register the e-mail mask as a SQL function ``name(email, is_admin)``."""
    # Fixed value: the pattern of functions.masks, as a SQL literal.
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(email STRING, is_admin BOOLEAN) RETURNS STRING "
        "RETURN CASE WHEN is_admin THEN email ELSE regexp_replace(email, '(?<=.).(?=.*@)', '*') END"
    )
    return name


def masked_view(
    spark: SparkSession,
    table: DataFrame,
    view: str,
    masks: Mapping[str, Callable[[str], Column]],
) -> DataFrame:
    """A temporary view of ``table`` whose columns pass through their ``masks``."""
    shown = table.select(*[masks[c](c).alias(c) if c in masks else F.col(c) for c in table.columns])
    shown.createOrReplaceTempView(view)
    return spark.table(view)
