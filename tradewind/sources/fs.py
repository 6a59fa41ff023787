"""The file system Spark itself uses, for names only; data goes through readers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NEW = ".new"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _rename(fs, old, new) -> None:
    # Hadoop reports most failures by its result.
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {old.toString()} to {new.toString()}")


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of ``paths`` that are there, in order; asked for several at a time."""
    with ThreadPoolExecutor(16) as pool:
        there = list(pool.map(lambda p: exists(spark, p), paths))
    return [p for p, found in zip(paths, there) if found]


def remove_partition(spark: SparkSession, root: str, col: str, value: object) -> None:
    """Delete the directory of one value of the partition column ``col`` below ``root``."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    p, fs = _path(spark, f"{root}/{utils.getPartitionPathString(col, None if value is None else str(value))}")
    fs.delete(p, True)


def move_partitions(spark: SparkSession, source: str, target: str, col: str) -> None:
    """Let the directories of ``col`` below ``source`` take the place of those of the same name
    below ``target``. One that is moved is gone from ``source``, so a try that was cut off is
    repeated."""
    pattern, fs = _path(spark, f"{source}/{col}=*")
    found = [s.getPath() for s in fs.globStatus(pattern) or []]
    folder, _ = _path(spark, target)
    if found:
        fs.mkdirs(folder)
    for old in found:
        new = spark._jvm.org.apache.hadoop.fs.Path(folder, old.getName())
        fs.delete(new, True)
        _rename(fs, old, new)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, *folders: str) -> DataFrame:
    """(path, length, file_path): every file below ``folders``, its plain name and the one
    that ``_metadata.file_path`` has. Spark lists many folders in tasks; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
    return files.select("path", "length", F.col("_metadata.file_path").alias("file_path"))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small control file, or None if it is not there.

    If a writer was cut off between removing the old file and renaming the new
    one, the new one is complete and is read.
    """
    path = next((p for p in (path, path + _NEW) if exists(spark, p)), None)
    if path is None:
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small control file: written aside, then renamed over the old one."""
    p, fs = _path(spark, path)
    aside, _ = _path(spark, path + _NEW)
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    _rename(fs, aside, p)


def rename_into(spark: SparkSession, pattern: str, target: str, name: Callable[[str, int], str]) -> int:
    """Move the files matching ``pattern`` into the folder ``target`` under the name
    ``name(path, i)`` gives the ``i``-th; how many there were."""
    p, fs = _path(spark, pattern)
    folder, _ = _path(spark, target)
    fs.mkdirs(folder)
    found = sorted(str(s.getPath().toString()) for s in fs.globStatus(p))
    for i, path in enumerate(found):
        _rename(fs, _path(spark, path)[0], _path(spark, f"{target}/{name(path, i)}")[0])
    return len(found)
