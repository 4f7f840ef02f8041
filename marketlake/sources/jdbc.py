"""Relational tables over JDBC: read in parallel slices of a numeric key, replaced, appended to.

Connection settings (url, user, password, driver) always come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_options(url: str, properties: Mapping[str, str], fetch_size: int = 10_000) -> dict[str, str]:
    return {"url": url, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **properties}


def slice_options(column: str, lower: int, upper: int, slices: int) -> dict[str, str]:
    """Options for ``slices`` parallel range reads of ``column``; rows outside the bounds are
    still read, by the first and last slice."""
    if upper < lower or slices < 1:
        raise ValueError("need lower <= upper and at least one slice")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper + 1),
        "numPartitions": str(slices),
    }


def read_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str]) -> DataFrame:
    """The result of a query the database runs; one slice, so for bounded results."""
    return spark.read.format("jdbc").options(**read_options(url, properties), query=query).load()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """A whole table; with ``key`` in ``slices`` parallel range reads between its own bounds."""
    options = read_options(url, properties)
    if key:
        bounds = read_query(spark, url, f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}", properties)
        lower, upper = bounds.first()
        if lower is not None:
            options |= slice_options(key, int(lower), int(upper), slices)
    return spark.read.format("jdbc").options(**options, dbtable=table).load()


def write_options(url: str, table: str, properties: Mapping[str, str], batch_size: int = 10_000) -> dict[str, str]:
    """``truncate`` lets an overwrite empty the table and keep its definition."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "truncate": "true", **properties}


def write_table(
    rows: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append", connections: int = 8
) -> None:
    """Append rows, or with ``mode="overwrite"`` replace a dimension, over at most ``connections``.

    Each task commits for itself. Write facts to an empty staging table if all or nothing is needed.
    """
    rows.coalesce(connections).write.format("jdbc").options(**write_options(url, table, properties)).mode(mode).save()
