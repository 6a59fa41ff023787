"""Loading exactly the files a manifest lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Schema
from .fs import existing, listed

MANIFEST_SCHEMA = "entries array<struct<url: string, mandatory: boolean, meta: struct<content_length: bigint>>>"


class ManifestError(Exception):
    """A mandatory file of the manifest is missing."""


def manifest_entries(spark: SparkSession, manifest: str) -> DataFrame:
    """(url, mandatory, content_length), one row per entry."""
    doc = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(manifest)
    entry = doc.select(F.explode("entries").alias("e"))
    return entry.select(
        F.col("e.url").alias("url"),
        F.coalesce("e.mandatory", F.lit(False)).alias("mandatory"),
        F.col("e.meta.content_length").alias("content_length"),
    )


def _folders(urls: list[str]) -> list[str]:
    """The folders that ``urls`` are in."""
    return sorted({re.sub("^file:/+", "/", u).rpartition("/")[0] or "/" for u in urls})


def _plain(url: Column | str) -> Column:
    return F.regexp_replace(url, "^file:/+", "/")


def _found(spark: SparkSession, manifest: str) -> DataFrame:
    """The entries with the length and the exact name of the file that is there, if one is.
    Their folders are listed as a whole; no file is asked for by itself."""
    entries = manifest_entries(spark, manifest)
    urls = [r.url for r in entries.select("url").collect()]  # names, as many as the manifest has
    folders = existing(spark, _folders(urls))
    if folders:
        files = listed(spark, *folders).withColumnRenamed("path", "_path")
    else:
        files = spark.createDataFrame([], "_path string, length bigint, file_path string")
    return entries.join(files, _plain("url") == _plain("_path"), "left").select("url", "mandatory", "content_length", "length", "file_path")


def read_manifest(
    spark: SparkSession, manifest: str, schema: Schema | None = None, base: str | None = None
) -> DataFrame:
    """The Parquet files the manifest lists, no others.

    A missing mandatory file raises :class:`ManifestError`; a missing optional one
    is left out. ``base`` keeps ``name=value`` directories as columns. File names,
    not data, are collected. Without ``schema`` that of the first file is taken.
    """
    entries = _found(spark, manifest).orderBy("url").collect()
    missing = [e.url for e in entries if e.mandatory and e.length is None]
    if missing:
        raise ManifestError(f"mandatory files missing: {', '.join(missing)}")
    there = [e for e in entries if e.length is not None]
    if not there:
        if schema is None:
            raise ManifestError("the manifest lists no existing file and no schema was given")
        return spark.createDataFrame([], schema)
    # The reader lists the folders once more and leaves out what the manifest does not name.
    reader = spark.read.schema(spark.read.parquet(there[0].url).schema if schema is None else schema)
    reader = reader.option("basePath", base) if base else reader.option("recursiveFileLookup", True)
    found = reader.parquet(*_folders([e.url for e in there]))
    return found.where(F.col("_metadata.file_path").isin([e.file_path for e in there]))


def manifest_check(spark: SparkSession, manifest: str) -> DataFrame:
    """(url, mandatory, expected_bytes, found_bytes, status) per entry; status is
    ok, missing or length_mismatch."""
    status = (
        F.when(F.col("length").isNull(), "missing")
        .when(F.col("content_length") != F.col("length"), "length_mismatch")
        .otherwise("ok")
    )
    return _found(spark, manifest).select(
        "url", "mandatory", F.col("content_length").alias("expected_bytes"), F.col("length").alias("found_bytes"), status.alias("status")
    )
