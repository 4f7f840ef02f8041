"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What every job here relies on. Memory and cores belong to the cluster and are left to
# spark-submit; for the shuffle see `shuffle_settings`.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def shuffle_settings(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for jobs whose largest shuffle (a fact's joined columns) has about this size.

    The number of partitions is chosen for that one; adaptive execution merges them for smaller
    shuffles, but splits only skewed ones, so it has to start high enough.
    """
    partitions = max(200, -(-largest_shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(app: str = "marketlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` uses ``__`` for dots in the key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` named.

    Without either this is an error, not a silent write to one machine's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created until a job writes to it."""
    return f"{shared_folder(spark)}/marketlake/{name}-{uuid.uuid4().hex}"


_open_scratch: list[list[str]] = []
# Settings of the jobs whose result is stored, unless the session has its own.
JOB_SETTINGS = {
    # The stored table takes the place of the shuffle files that led to it.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Batches for Python are bounded by bytes, as texts may be long: 10,000 rows of them are tens of MB, twice.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def _write(rows: DataFrame, folder: str) -> None:
    conf = rows.sparkSession.conf
    chosen = {key: value for key, value in JOB_SETTINGS.items() if conf.get(key, None) is None}
    for key, value in chosen.items():
        conf.set(key, value)
    try:
        rows.write.parquet(folder)
    finally:
        for key in chosen:
            conf.unset(key)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: for results that are used several
    times, or whose later uses must see exactly the same rows."""
    folder = new_folder(rows.sparkSession, name)
    for made in _open_scratch[-1:]:
        made.append(folder)
    _write(rows, folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def stored_alone(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, stored; what it stored on the way is removed. For results that take several passes."""
    folder = new_folder(spark, name)
    for made in _open_scratch[-1:]:
        made.append(folder)
    with scratch(spark):
        rows = make()
        _write(rows, folder)
    return spark.read.schema(rows.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``stored`` wrote inside. For jobs that leave tables, not lazy frames."""
    _open_scratch.append([])
    try:
        yield
    finally:
        for folder in _open_scratch.pop():
            remove(spark, folder)
