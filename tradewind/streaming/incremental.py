"""Runs that see only files no earlier run has finished.

Each source has its own stream and checkpoint, which append new rows to bronze
under the number of the run. The batch step then takes the runs that are not done
yet. It notes which before it starts; after a crash the same runs are taken again
under the same number, so a step that overwrites the partitions of that number
leaves no duplicates. One run at a time: the control file has no lock.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.fs import exists, read_text, write_text
from .ingest import open_stream, stream_to_table

RUN = "run_id"

Process = Callable[[Mapping[str, DataFrame], int], None]


@dataclass(frozen=True)
class Source:
    """Raw files of one table: declared schema, format and reader options."""

    name: str
    path: str
    schema: T.StructType
    fmt: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)


def _load(spark: SparkSession, path: str) -> dict:
    text = read_text(spark, path)
    return json.loads(text) if text else {"next_run": 1, "done_through": 0, "open": None}


def _rows(spark: SparkSession, source: Source, root: str, first: int, last: int) -> DataFrame:
    path = f"{root}/bronze/{source.name}"
    schema = T.StructType([*source.schema.fields, T.StructField(RUN, T.IntegerType())])
    if not exists(spark, path):
        return spark.createDataFrame([], source.schema)
    stored = spark.read.schema(schema).parquet(path)
    return stored.where(F.col(RUN).between(first, last)).drop(RUN)


def run_incremental(spark: SparkSession, sources: Sequence[Source], root: str, process: Process) -> int | None:
    """Pull what is new from ``sources`` and hand it to ``process(frames, run)``.

    The run's number, or None if no source had a new row; ``process`` is then not
    called. Progress moves on only after ``process`` has returned.
    """
    control = f"{root}/control/progress.json"
    state = _load(spark, control)

    def keep(**changes) -> None:
        state.update(changes)
        write_text(spark, control, json.dumps(state))

    def work_off(first: int, last: int) -> bool:
        frames = {s.name: _rows(spark, s, root, first, last) for s in sources}
        found = any(not df.isEmpty() for df in frames.values())
        if found:
            process(frames, last)
        keep(done_through=last, open=None)
        return found

    if state["open"]:
        work_off(*state["open"])
    run = state["next_run"]
    keep(next_run=run + 1)
    for s in sources:
        if exists(spark, s.path):
            new = open_stream(spark, s.path, s.schema, s.fmt, **s.options).withColumn(RUN, F.lit(run))
            stream_to_table(new, f"{root}/bronze/{s.name}", f"{root}/checkpoints/{s.name}", [RUN])
    keep(open=[state["done_through"] + 1, run])
    return run if work_off(state["open"][0], run) else None
