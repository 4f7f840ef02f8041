"""Writing: snapshots, exports, appends, and versions that readers switch to at once."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import VERSIONS
from marketlake.sources.literals import literal_rows, no_rows

DAY = "event_date"
# Spark's own CSV default stops at milliseconds.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows plus a counter that the write itself fills: ``counter.get["rows"]`` afterwards."""
    counter = Observation()
    return rows.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def write_staging(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Replace the staged Parquet snapshot of each table; returns the row counts."""
    written = {}
    for name, rows in tables.items():
        rows, counter = counted(rows)
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        written[name] = counter.get["rows"]
    return written


def export_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` puts all rows through one task: small exports only."""
    rows = rows.coalesce(1) if single_file else rows
    rows.write.mode("overwrite").option("header", True).option("timestampNTZFormat", CSV_TIME).csv(path)


def append(rows: DataFrame, path: str) -> int:
    rows, counter = counted(rows)
    rows.write.mode("append").parquet(path)
    return counter.get["rows"]


def by_day(rows: DataFrame, column: str) -> DataFrame:
    """Add the day of ``column`` and cluster by it for a partitioned write.

    REBALANCE gives each day few files and, unlike a repartition by day, lets adaptive execution
    split a day that holds most of the rows. The write sorts by day anyway; with the time as second
    key, readers can skip row groups inside a day.
    """
    clustered = rows.withColumn(DAY, F.to_date(column)).hint("rebalance", F.col(DAY))
    return clustered.sortWithinPartitions(DAY, column)


def append_by_day(rows: DataFrame, path: str, column: str) -> int:
    """Append to a table in day folders, so that later loads read only the days they touch."""
    rows, counter = counted(by_day(rows, column))
    rows.write.mode("append").partitionBy(DAY).parquet(path)
    return counter.get["rows"]


def open_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in day folders at ``path``, empty if nothing was written yet."""
    full = T.StructType(schema.fields + [T.StructField(DAY, T.DateType())])
    no_rows(spark, full).write.mode("ignore").partitionBy(DAY).parquet(path)
    return spark.read.schema(full).parquet(path)


def new_version(folder: str) -> str:
    return f"{folder}/version={uuid4().hex}"


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """What was published in the folder: view, path, published. Rows are only ever added."""
    path = f"{folder}/versions"
    no_rows(spark, VERSIONS).write.mode("ignore").parquet(path)
    return spark.read.schema(VERSIONS).parquet(path)


def announce(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], paths: Mapping[str, str]) -> None:
    """Make these versions the current ones, all with one append, and point the session's views at them: the
    tables as they are read from their new paths."""
    rows = literal_rows(spark, VERSIONS, [(view, path, None) for view, path in paths.items()])
    stamped = rows.withColumn("published", F.current_timestamp().cast("timestamp_ntz"))
    stamped.coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    for view, table in tables.items():
        table.createOrReplaceTempView(view)


def current_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Where the current version of each published table is, whichever session wrote it: one short row for every
    publication, read by one task."""
    newest = versions(spark, folder).coalesce(1).groupBy("view").agg(F.max_by("path", "published"))
    return dict(map(tuple, newest.collect()))


def current_path(spark: SparkSession, view: str, folder: str) -> str | None:
    return current_paths(spark, folder).get(view)


def current(
    spark: SparkSession, view: str, schema: T.StructType, folder: str, paths: Mapping[str, str] | None = None
) -> DataFrame:
    """The current version of a published table; no rows before the first. ``paths`` saves the lookup."""
    path = (current_paths(spark, folder) if paths is None else paths).get(view)
    return spark.read.schema(schema).parquet(path) if path else no_rows(spark, schema)


def publish(tables: Mapping[str, DataFrame], folder: str, by_column: Mapping[str, str] | None = None) -> dict[str, int]:
    """Replace tables together: write a new version of each, then announce them with one append.

    A failed write changes nothing. Readers that already run keep their version, and the version
    being read is never overwritten. ``by_column`` names the time column of tables to be stored in
    day folders.
    """
    version = new_version(folder)
    spark = next(iter(tables.values())).sparkSession
    written, paths, found = {}, {}, {}
    for view, rows in tables.items():
        column = (by_column or {}).get(view)
        paths[view] = f"{version}/{view}"
        written[view] = append_by_day(rows, paths[view], column) if column else append(rows, paths[view])
        schema = T.StructType(rows.schema.fields + [T.StructField(DAY, T.DateType())] * bool(column))
        found[view] = spark.read.schema(schema).parquet(paths[view])
    announce(spark, folder, found, paths)
    return written
