"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

import bookpipe

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Splits a hot join key over several tasks; see operators.latest and operators.upsert.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Adaptive execution merges small shuffle partitions to the advisory size but never splits plain
    # ones; see shuffles_for.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "bookpipe", **overrides: str) -> SparkSession:
    """Session with the project's settings. ``spark-submit`` gives master and sizes."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Stored bytes per initial shuffle partition; rows are several times larger in a shuffle than in
# compressed files. The number of partitions is limited, as every map task keeps one block for each.
BYTES_PER_PARTITION = 64 * 1024 * 1024
MOST_PARTITIONS = 100_000


def partitions_for(stored_bytes: int, least: int) -> int:
    """Initial shuffle partitions for an input of that size."""
    return max(least, min(MOST_PARTITIONS, -(-stored_bytes // BYTES_PER_PARTITION)))


@contextmanager
def shuffles_for(spark: SparkSession, stored_bytes: int) -> Iterator[None]:
    """Start shuffles with enough partitions for the input; adaptive execution merges the surplus."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(partitions_for(stored_bytes, least)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, from its file system's working folder if it is relative."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def checkpoint_folder(spark: SparkSession, default: str | None = None) -> str:
    """The session's checkpoint folder, which all executors share; ``default`` where none is set.

    A local session without either gets a temporary folder. On a cluster that would be visible to
    one machine only, so there a folder is required.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    base = base or context.getCheckpointDir() or default
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="bookpipe-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder."""
    return f"{checkpoint_folder(spark)}/bookpipe-{uuid.uuid4().hex}"


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, whichever thread comes first."""
    context = spark.sparkContext
    with _shipping:
        if context.applicationId not in _shipped:
            root = Path(bookpipe.__file__).parent
            folder = tempfile.mkdtemp(prefix="bookpipe-")
            context.addPyFile(shutil.make_archive(f"{folder}/bookpipe", "zip", root.parent, root.name))
            _shipped.add(context.applicationId)
