"""Tables declared by a query over others and the expectations their rows must meet."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import expect_or_drop, holds
from ..sinks import describe_table, overwrite_partitions
from ..sources.fs import exists

VIOLATIONS = "run bigint, table string, expectation string, action string, rows bigint, violations bigint, written boolean"


@dataclass(frozen=True)
class Declared:
    """The table ``name``: ``query`` of the frames that ``reads`` names, which are other
    declared tables or sources. Rows that miss a ``warn`` condition are counted and kept, a
    ``drop`` condition counted and left out; with one that misses a ``fail`` condition the
    table is not replaced. A condition that is null is missed."""

    name: str
    reads: Sequence[str]
    query: Callable[..., DataFrame]
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    warn: Mapping[str, str] = field(default_factory=dict)
    drop: Mapping[str, str] = field(default_factory=dict)
    fail: Mapping[str, str] = field(default_factory=dict)

    def conditions(self) -> list[tuple[str, str, str]]:
        return [(n, action, c) for action, found in (("warn", self.warn), ("drop", self.drop), ("fail", self.fail)) for n, c in found.items()]


class ExpectationFailed(Exception):
    """A table's rows miss a condition they must meet."""


def update_tables(
    spark: SparkSession, declared: Sequence[Declared], sources: Mapping[str, DataFrame], prefix: str, root: str, run: int
) -> DataFrame:
    """Write all tables as ``{prefix}{name}``, each after those it reads, and return the
    violations of this run, as kept in ``{root}/violations`` (see ``VIOLATIONS``).

    Each table is computed once: its rows are counted against its conditions while they are
    written to a folder of the run. Then the table is pointed there, so that readers have
    the old rows or the new ones. If a ``fail`` condition is missed, the table stays as it
    was, the counts are kept, and :class:`ExpectationFailed` is raised; tables that read
    it are not updated. A run repeated replaces what it has written before.
    """
    by_name = {t.name: t for t in declared}
    order = TopologicalSorter({t.name: [r for r in t.reads if r in by_name] for t in declared}).static_order()
    lines: list[tuple] = []
    failed = ""
    for name in order:
        table = by_name[name]
        frames = [spark.read.table(f"{prefix}{r}") if r in by_name else sources[r] for r in table.reads]
        conditions = table.conditions()
        seen = Observation()
        missed = [F.count_if(~holds(c)).alias(f"c{i}") for i, (_, _, c) in enumerate(conditions)]
        counted = table.query(*frames).observe(seen, F.count(F.lit(1)).alias("rows"), *missed)
        for c in table.drop.values():
            counted = expect_or_drop(counted, c)
        place = f"{root}/tables/{name}/run={run}"
        counted.write.mode("overwrite").parquet(place)
        found = seen.get
        bad = [n for i, (n, action, _) in enumerate(conditions) if action == "fail" and found[f"c{i}"]]
        lines += [(run, name, n, action, found["rows"], found[f"c{i}"], not bad) for i, (n, action, _) in enumerate(conditions)]
        if bad:
            failed = f"{name}: {', '.join(bad)}"
            break
        _point(spark, f"{prefix}{name}", counted, place)
        if table.comment or table.properties:
            describe_table(spark, f"{prefix}{name}", table.comment, table.properties)
    kept = spark.createDataFrame(lines, VIOLATIONS)
    overwrite_partitions(kept.coalesce(1), f"{root}/violations", "run")
    if failed:
        raise ExpectationFailed(failed)
    return kept


def _point(spark: SparkSession, name: str, df: DataFrame, place: str) -> None:
    """Let the table ``name`` have the files at ``place``."""
    columns = df.schema.toDDL()
    same = spark.catalog.tableExists(name) and spark.read.table(name).dtypes == df.dtypes
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:  # new, or of another shape; the files of an external table stay
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{place}'")
    spark.catalog.refreshTable(name)


def violations(spark: SparkSession, root: str) -> DataFrame:
    """The counts of all runs."""
    if not exists(spark, f"{root}/violations"):
        return spark.createDataFrame([], VIOLATIONS)
    return spark.read.schema(VIOLATIONS).parquet(f"{root}/violations").select(*[c.split()[0] for c in VIOLATIONS.split(", ")])
