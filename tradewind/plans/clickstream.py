"""Click events from raw JSON lines into their bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..streaming import stream_json_to_table
from .schemas import CLICKSTREAM


def run(spark: SparkSession, raw: str, prefix: str, root: str, files_per_batch: int | None = None) -> DataFrame:
    """The table ``{prefix}bronze_clickstream`` with the events that have arrived below
    ``{raw}/clickstream`` since the last run; columns that come new are added to it."""
    return stream_json_to_table(
        spark, f"{raw}/clickstream", f"{prefix}bronze_clickstream", CLICKSTREAM,
        f"{root}/checkpoints/clickstream", f"{root}/bronze/clickstream", files_per_batch=files_per_batch,
    )
