"""Aggregates kept up to date from row changes alone.

A view holds, for each group of lines, sums, the number of its lines and, for distinct
counts, how many of its lines have each value. A change adds or takes away, so neither the
base nor untouched partitions of the view are read; a group without lines goes by itself.
(Bitmaps of the values would be smaller, but a value cannot be taken out of a union: only
its count tells whether another line still has it.)

A version is applied once. The new contents of the partitions it touches are written
aside first, in directories as they lie in the view; a marker says that they are complete;
then they are moved to their places, which may be repeated as often as it is cut off. One
writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import split_join
from ..session import side_by_side
from ..sources.fs import exists, read_text, remove_tree, write_text
from .files import overwrite_partitions, replace_partitions, stored

_ADDS = ("insert", "update_postimage")


@dataclass(frozen=True)
class KeptView:
    """What a view at ``path`` holds: lines grouped by ``groups``, of which ``part`` (in
    ``groups``) names its directories; ``sums`` and ``distinct`` map result columns to
    columns of the lines. Sums are of whole numbers and decimals, as doubles do not cancel."""

    path: str
    groups: Sequence[str]
    part: str
    sums: Mapping[str, str]
    distinct: Mapping[str, str] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        """The groups, the directories' column last, as it is read back."""
        return [*[g for g in self.groups if g != self.part], self.part]


def _signed(changes: DataFrame) -> DataFrame:
    return changes.withColumn("_w", F.when(F.col("_change_type").isin(*_ADDS), 1).otherwise(-1))


def _kept_values(view: KeptView) -> list[str]:
    return [f"_of_{out}" for out in view.distinct]


def _fine(view: KeptView, lines: DataFrame) -> DataFrame:
    """What the signed ``lines`` add, per group and values to be counted: sums, non-null
    values of each, lines. Of the lines, only the columns of the view are looked at."""
    for c in view.sums.values():
        if not isinstance(lines.schema[c].dataType, (T.DecimalType, T.IntegralType)):
            raise TypeError(f"{c} is {lines.schema[c].dataType.simpleString()}: only exact sums can be kept")
    adds: list[Column] = [F.sum("_w").alias("_lines")]
    for out, c in view.sums.items():
        kind = lines.schema[c].dataType
        # Not multiplied by the sign: that would widen a decimal.
        total = F.sum(F.when(F.col("_w") > 0, F.col(c)).otherwise(-F.col(c)))
        adds.append(total.cast(f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "bigint").alias(out))
        adds.append(F.sum(F.when(F.col(c).isNotNull(), F.col("_w"))).alias(f"_n_{out}"))
    values = [F.col(c).alias(f"_of_{out}") for out, c in view.distinct.items()]
    return _that_add(lines.groupBy(*view.keys, *values).agg(*adds), [*view.keys, *_kept_values(view)])


def _that_add(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Without rows all of whose amounts are nothing: what came and went again."""
    amounts = [F.coalesce(F.col(c), F.lit(0)) != 0 for c in sums.columns if c not in set(keys)]
    return sums.where(reduce(Column.__or__, amounts))


def _delta(view: KeptView, fine: DataFrame) -> DataFrame:
    """Per group, what the changes add."""
    if not view.distinct:
        return fine
    amounts = [f for f in fine.schema if f.name not in (*view.keys, *_kept_values(view))]
    return fine.groupBy(*view.keys).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in amounts])


def _support(view: KeptView, out: str, fine: DataFrame) -> DataFrame:
    """Per group and value of one distinct count, the lines the changes add."""
    value = F.col(f"_of_{out}")
    found = fine.where(value.isNotNull())
    if len(view.distinct) == 1:  # ``fine`` has one row for each already
        return found.select(*view.keys, value.alias("_value"), F.col("_lines").alias("_n"))
    return found.groupBy(*view.keys, value.alias("_value")).agg(F.sum("_lines").alias("_n"))


def _merged(old: DataFrame | None, new: DataFrame, keys: Sequence[str], left: str, dealt: Sequence[str] = ()) -> DataFrame:
    """Old and new amounts added up; rows of which no ``left`` remain are gone. ``old`` and
    ``new`` have one row for the ``keys``. With ``dealt``, of them, the rows are shuffled by
    these, so that they lie in the order in which they are written."""
    if old is None:
        return new.where(F.col(left) != 0)
    both = old.unionByName(new)
    amounts = [c for c in new.columns if c not in keys]
    kinds = {f.name: f.dataType for f in new.schema}
    if dealt:
        both = both.repartition(*dealt)
    added = both.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in amounts])
    return added.where(F.col(left) != 0)


def _dealt(view: KeptView, rows: DataFrame | None) -> DataFrame | None:
    """``rows`` with a column that deals those of a directory to an eighth of the shuffle's
    tasks: a directory gets no more files than that, and none is one task's work."""
    if rows is None:
        return None
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    return rows.withColumn("_dealt", F.pmod(F.xxhash64("_value"), F.lit(tasks)).cast("int"))


def _table(view: KeptView, name: str) -> str:
    return f"{view.path}/{name}"


def _read(spark: SparkSession, path: str, like: T.StructType) -> DataFrame | None:
    return spark.read.schema(like).parquet(path) if exists(spark, path) else None


def _part_last(df: DataFrame, part: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != part], part)


def _touched_part(old: DataFrame | None, touched: DataFrame, part: str) -> DataFrame | None:
    """The rows of ``old`` in the partitions of ``touched``: by its bounds at the scan, then by
    value; a null is a partition of its own."""
    if old is None:
        return None
    lo, hi, nulls = touched.agg(F.min(part), F.max(part), F.count_if(F.col(part).isNull())).first()
    within = F.col(part).between(lo, hi) if lo is not None else F.lit(False)
    found = split_join(old.where(within), touched.where(within), part, "left_semi")
    return found.unionByName(old.where(F.col(part).isNull())) if nulls else found


def version_of(spark: SparkSession, view: KeptView) -> int:
    """The last version applied to the view, -1 if there is none."""
    _finish(spark, view)
    text = read_text(spark, _table(view, "version.json"))
    return json.loads(text)["version"] if text else -1


def _schemas(control: dict) -> dict[str, T.StructType]:
    return {name: T.StructType.fromJson(json.loads(s)) for name, s in control["schemas"].items()}


def build_view(lines: DataFrame, view: KeptView, version: int = 0) -> None:
    """The view of ``lines`` from scratch, as ``version``."""
    apply_changes(lines.withColumn("_change_type", F.lit("insert")), view, version)


def apply_changes(changes: DataFrame, view: KeptView, version: int) -> None:
    """Bring the view from an earlier version to ``version`` by the row ``changes`` between
    them (see ``operators.changes.change_feed``), given as lines of the view, whose columns
    may be null.

    A version that has been applied already changes nothing, so a run that was cut off is
    simply repeated. Only partitions that hold a changed group are read and written.
    """
    if version > version_of(changes.sparkSession, view):
        apply_sums(summed(changes, view), view, version)


def summed(changes: DataFrame, view: KeptView) -> DataFrame:
    """What ``changes`` add to ``view``, written once: the lines are summed before, so that a
    group's sums take their place."""
    return stored(_fine(view, _signed(changes)), "view-changes")


def coarser(fine: DataFrame, of: KeptView, view: KeptView, named: Mapping[str, str]) -> DataFrame:
    """What the changes summed up in ``fine`` for the view ``of`` add to ``view``, which has the
    same sums by fewer groups and no distinct counts; ``named`` says what its groups are called
    in ``of``, if not the same."""
    if view.distinct or dict(view.sums) != dict(of.sums):
        raise ValueError(f"{view.path} has not the sums of {of.path}")
    kept = [f for f in fine.schema if f.name not in (*of.keys, *_kept_values(of))]
    groups = [F.col(named.get(g, g)).alias(g) for g in view.keys]
    sums = fine.groupBy(*groups).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in kept])
    return stored(_that_add(sums, view.keys), "view-changes")


def by_group(fine: DataFrame, view: KeptView) -> DataFrame:
    """``fine`` summed to the groups of ``view``, written once, for :func:`coarser` and
    :func:`apply_sums`: of distinct counts it has one row for each value."""
    return stored(_delta(view, fine), "view-groups") if view.distinct else fine


def apply_sums(fine: DataFrame, view: KeptView, version: int, groups: DataFrame | None = None) -> None:
    """:func:`apply_changes` by what the changes add (:func:`summed`, :func:`coarser`), summed
    to ``groups`` already (:func:`by_group`) or not."""
    spark = fine.sparkSession
    if version <= version_of(spark, view):
        return
    delta = _delta(view, fine) if groups is None else groups
    # A group that any line changed is among the groups.
    touched = stored((fine if groups is None else groups).select(view.part).distinct(), "view-parts")
    aside = _table(view, f"aside/{version}")
    old = _touched_part(_read(spark, _table(view, "groups"), _part_last(delta, view.part).schema), touched, view.part)
    names = {"groups": _part_last(_merged(old, delta, view.keys, "_lines"), view.part)}
    gathered = set()
    for out in view.distinct:
        delta = _part_last(_support(view, out, fine), view.part)
        old = _touched_part(_read(spark, _table(view, out), delta.schema), touched, view.part)
        keys = [*view.keys, "_value", "_dealt"]
        merged = _merged(_dealt(view, old), _dealt(view, delta), keys, "_n", [view.part, "_dealt"])
        names[out] = _part_last(merged.drop("_dealt"), view.part)
        if old is not None:
            gathered.add(out)

    def write(name: str, df: DataFrame) -> None:
        remove_tree(spark, f"{aside}/{name}")  # what a try that was cut off may have left
        overwrite_partitions(df, f"{aside}/{name}", view.part, gathered=name in gathered)
        filled = spark.read.schema(df.schema).parquet(f"{aside}/{name}").select(view.part).distinct()
        filled.write.mode("overwrite").parquet(f"{aside}/filled/{name}")

    side_by_side(*[partial(write, name, df) for name, df in names.items()])
    touched.write.mode("overwrite").parquet(f"{aside}/touched")
    kinds = {name: df.schema.json() for name, df in [*names.items(), ("touched", touched)]}
    write_text(spark, _table(view, "pending.json"), json.dumps({"version": version, "schemas": kinds}))
    _finish(spark, view)


def _finish(spark: SparkSession, view: KeptView) -> None:
    """Put what lies aside complete in its place; again, if that was cut off."""
    text = read_text(spark, _table(view, "pending.json"))
    pending = json.loads(text) if text else {}
    if "version" not in pending:
        return
    aside = _table(view, f"aside/{pending['version']}")
    kinds = _schemas(pending)
    part = kinds.pop("touched")
    touched = spark.read.schema(part).parquet(f"{aside}/touched")
    for name in kinds:
        filled = spark.read.schema(part).parquet(f"{aside}/filled/{name}")
        replace_partitions(filled, _table(view, name), view.part, touched, f"{aside}/{name}")
    write_text(spark, _table(view, "version.json"), text)
    write_text(spark, _table(view, "pending.json"), "{}")


def read_view(spark: SparkSession, view: KeptView) -> DataFrame:
    """The groups with their sums (null if no line has a value) and distinct counts."""
    _finish(spark, view)
    kinds = _schemas(json.loads(read_text(spark, _table(view, "version.json"))))
    tables = {name: _read(spark, _table(view, name), kind) for name, kind in kinds.items() if name != "touched"}
    # A view that never had a group has no files.
    tables = {name: spark.createDataFrame([], kinds[name]) if df is None else df for name, df in tables.items()}
    groups = tables["groups"]
    sums = [F.when(F.col(f"_n_{out}") > 0, F.col(out)).alias(out) for out in view.sums]
    out = groups.select(*view.groups, *sums)
    for name in view.distinct:
        counted = tables[name].groupBy(*[F.col(g).alias(f"_{g}") for g in view.groups]).agg(F.count(F.lit(1)).alias(name))
        same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in view.groups]
        out = out.join(counted, same, "left").select(*out.columns, F.coalesce(name, F.lit(0)).alias(name))
    return out
