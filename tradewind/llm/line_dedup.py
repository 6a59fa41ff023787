"""Line dedup against levelled sorted runs of line hashes.

Documents come in batches of ascending doc_id. The line keys known so far lie in runs:
tables of (key hash, smallest doc_id) sorted by the hash. A new batch merge-joins every
run, drops the lines whose key is there, and adds the keys that are new as a run of its
own on level 0. When a level holds ``fan_out`` runs they are merged into one run of the
next level, so a key is rewritten once a level, and there are at most ``fan_out`` runs on
each of a logarithmic number of levels.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace
from .common import WHITESPACE, append, documents, drop_stored, fresh, map_rows, stored, texts

MIN_CHARS = 10


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(WHITESPACE).lower()


def key_hashes(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """A 128-bit hash for each line of the text, None for lines with a short key."""
    out: list[bytes | None] = []
    for line in (text or b"").split(b"\n"):
        key = line_key(line)
        short = len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars)
        out.append(None if short else xxhash.xxh128_digest(key))
    return out


@dataclass
class Run:
    path: str
    level: int


@dataclass
class LineRuns:
    """The levelled runs; ``folder`` is below the shared folder and holds them all."""

    spark: SparkSession
    folder: str
    fan_out: int = 4
    runs: list[Run] = field(default_factory=list)
    made: int = 0

    def frame(self, run: Run) -> DataFrame:
        return self.spark.read.schema("key binary, first_id bigint").parquet(run.path)

    def known(self) -> DataFrame | None:
        """Keys of all runs. No key is in two runs, since a batch adds only new ones."""
        out = None
        for run in self.runs:
            out = self.frame(run) if out is None else out.union(self.frame(run))
        return out

    def _write(self, keys: DataFrame, level: int) -> None:
        self.made += 1
        path = f"{self.folder}/level={level}-run={self.made}"
        keys.sortWithinPartitions("key").write.parquet(path)
        self.runs.append(Run(path, level))

    def add(self, new_keys: DataFrame) -> None:
        """Add keys (key, first_id) that no run has, as a run of level 0."""
        self._write(new_keys, 0)
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(same := [r for r in self.runs if r.level == level]) >= self.fan_out:
            merged = None
            for r in same:
                merged = self.frame(r) if merged is None else merged.union(self.frame(r))
            self.runs = [r for r in self.runs if r.level != level]
            self._write(merged.repartition("key"), level + 1)
            for r in same:
                drop_stored(self.spark, r.path)
            level += 1


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(key, id) once for each different line key of a document, long ones only."""

    def fn(b: pa.RecordBatch) -> dict:
        keys: list[bytes] = []
        ids: list[int | None] = []
        for i, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
            mine = {k for k in key_hashes(t, min_chars) if k is not None}
            keys.extend(mine)
            ids.extend([i] * len(mine))
        return {"key": keys, "id": ids}

    return map_rows(docs, fn, "key binary, id bigint")


def _order_id(docs: DataFrame) -> DataFrame:
    """Documents without an id come after all others, as if their id were the largest."""
    return docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(2**63 - 1)))


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into ``batches`` ranges of about as many rows. Where
    they fall changes no result, so an approximate quantile will do."""
    if batches < 2:
        return []
    cuts = docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def dropped_keys(docs: DataFrame, *, min_chars: int = MIN_CHARS, batches: int = 4, fan_out: int = 4) -> DataFrame:
    """(id, key): the keys that a document loses, each of them first in a smaller id."""
    spark = docs.sparkSession
    ordered = _order_id(docs)
    keys = stored(_keys(ordered, min_chars), "line-keys")
    store = LineRuns(spark, workspace(spark, "line-runs"), fan_out)
    lost: DataFrame | None = None
    bounds: list[int | None] = [None, *batch_bounds(keys.select(F.col("id").alias("doc_id")), batches), None]
    for low, high in zip(bounds, bounds[1:]):
        part = keys
        if low is not None:
            part = part.where(F.col("id") > low)
        if high is not None:
            part = part.where(F.col("id") <= high)
        first = part.groupBy("key").agg(F.min("id").alias("first_id"))
        # A key of an earlier run belongs to the smaller id there, a new one to the
        # smallest id of this batch.
        known = store.known()
        if known is None:
            owner = stored(first.withColumn("new", F.lit(True)), "line-owners")
        else:
            earlier = known.select("key", F.col("first_id").alias("known_id"))
            merged = first.join(earlier, "key", "left")
            owner = stored(merged.select("key", F.coalesce("known_id", "first_id").alias("first_id"), F.col("known_id").isNull().alias("new")), "line-owners")
        mine = part.join(owner, "key").where(F.col("id") > F.col("first_id")).select("id", "key")
        gone = stored(mine, "line-drops")
        lost = gone if lost is None else lost.union(gone)
        store.add(owner.where("new").select("key", "first_id"))
    return lost


def _rebuild(text: bytes | None, gone: set[bytes], min_chars: int) -> tuple[int, int, bytes]:
    lines = (text or b"").split(b"\n")
    if not gone:
        return len(lines), 0, text or b""
    keep = [line for line, k in zip(lines, key_hashes(text, min_chars)) if k is None or k not in gone]
    return len(lines), len(lines) - len(keep), b"\n".join(keep)


def _with_lost(df: DataFrame, id_col: str, lost: DataFrame, name: str) -> DataFrame:
    """``df`` with the keys each row's id loses, joined end to end."""
    lists = lost.groupBy("id").agg(F.array_join(F.collect_list(F.hex("key")), "").alias(name))
    key = fresh(df, "_tw_id")
    lists = lists.withColumnRenamed("id", key)
    keyed = df.withColumn(key, F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(2**63 - 1)))
    return keyed.join(lists, key, "left").drop(key)


def _sets(column: pa.Array) -> list[set[bytes]]:
    raw = [bytes.fromhex(x) if x else b"" for x in column.to_pylist()]
    return [{x[i : i + 16] for i in range(0, len(x), 16)} for x in raw]


def report(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = 4, fan_out: int = 4) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (what is left) for each row of ``df``.

    A null or empty text is one empty line and stays one. A line whose key has at least
    ``min_chars`` code points and is also in a smaller doc_id goes; repeated lines within
    the smallest one stay, as do those of rows that share its doc_id. Rows without a
    doc_id count as the largest id. A document that loses all lines is left with an empty
    text. An empty table gives no rows. Other columns are not looked at.
    """
    docs = documents(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    lost = dropped_keys(docs, min_chars=min_chars, batches=batches, fan_out=fan_out)

    def fn(b: pa.RecordBatch) -> dict:
        rows = [_rebuild(t, g, min_chars) for t, g in zip(texts(b.column("text")), _sets(b.column("lost")))]
        return {"doc_id": b.column("doc_id"), "n_lines": [r[0] for r in rows], "n_dropped": [r[1] for r in rows], "kept_sha256": [hashlib.sha256(r[2]).hexdigest() for r in rows], "text": pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())}

    return map_rows(_with_lost(docs, "doc_id", lost, "lost"), fn, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, text string")


def clean(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = 4, fan_out: int = 4) -> DataFrame:
    """``df`` with its repeated lines taken out of the text; all rows and columns stay.

    A null text stays null, an empty one empty; ties and rows without an id are settled as
    in :func:`report`. An empty table stays empty.
    """
    docs = documents(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    lost = dropped_keys(docs, min_chars=min_chars, batches=batches, fan_out=fan_out)
    name, text = fresh(df, "_tw_lost"), fresh(df, "_tw_text")

    def fn(b: pa.RecordBatch) -> dict:
        rows = [t if not g else _rebuild(t, g, min_chars)[2] for t, g in zip(texts(b.column(text_col)), _sets(b.column(name)))]
        return {text: pa.array(rows, pa.binary()).cast(pa.string())}

    out = append(_with_lost(df, id_col, lost, name), fn, f"{text} string")
    return out.withColumn(text_col, F.col(text)).select(*[F.col(f"`{c}`") for c in df.columns])
