"""Named queries over the driver's tables, each with its SQL for the comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure
from .tables import SQL_TABLES

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, tables: str = "") -> Callable[[Run], Run]:
    """Register a function as ``name``; ``tables`` names the table expressions that
    ``sql`` selects from."""

    def add(fn: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is there already")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(configure(spark), sf_dir))

        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(run, with_tables(sql, tables.split()) if sql else None)
        return fn

    return add


def with_tables(body: str, names: list[str]) -> str:
    """``body`` below the table expressions it needs, each after those it needs itself."""
    ordered: list[str] = []

    def need(name: str) -> None:
        below, _ = SQL_TABLES[name]
        for n in below:
            need(n)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        need(n)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({SQL_TABLES[n][1].strip()})" for n in ordered)
    return f"WITH {parts}\n{body.strip()}"


def comparable(df: DataFrame) -> DataFrame:
    """``df`` in types both engines hand out alike: long, double, text, boolean."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.array_sort(c), "; ")
        cols.append(c.alias(f.name))
    return df.select(*cols)
