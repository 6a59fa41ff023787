"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings only: they can be put on a session somebody else started.
RUNTIME_CONF = {
    # Raw times end in "Z"; any other zone would move rows to another day.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of the rows: let AQE split its partition even
    # when that costs the aggregate above the join one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet rows take several times their file size in memory. With sizes taken
    # at face value, Spark would broadcast tables much beyond its threshold.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # What a run writes aside for itself counts as much as its tables: both are kept small.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def small_sides_hashed(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside hash a side instead of sorting both, if AQE finds all of that
    side's partitions to be small. Not for every join: what follows may need the order."""
    # Below the advisory size of a partition (64 MB unless set) Spark ignores it.
    with _while_set(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m"):
        yield


@contextmanager
def several_tasks_a_core(spark: SparkSession) -> Iterator[None]:
    """Scans that run inside are cut for four tasks a core, if files are large enough. Cut for
    one, up to 128 MB, a table of a little more leaves most cores idle for a second task."""
    with _while_set(spark, "spark.sql.files.minPartitionNum", str(4 * spark.sparkContext.defaultParallelism)):
        yield


@contextmanager
def _while_set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def side_by_side(*jobs: Callable[[], object]) -> None:
    """Run ``jobs`` that do not need each other at once: one fills the cores that the last
    tasks of another leave idle. The first error is raised when all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
    for job in running:
        job.result()


def local_session(app: str = "tradewind", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a fresh
    temporary folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tradewind-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tradewind/{label}-{uuid.uuid4().hex[:12]}"
