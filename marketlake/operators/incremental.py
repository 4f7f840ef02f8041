"""Which rows of a batch a table does not have yet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, row_bytes
from marketlake.operators.ranking import first_per_key


def _literal(value, rows: DataFrame, column: str) -> Column:
    """A driver value as a literal of the column's own type. It goes through text, since a datetime
    literal would carry a zone and keep the comparison from reaching the scan."""
    return F.lit(str(value)).cast(rows.schema[column].dataType)


def days_in(spark: SparkSession, path: str, day: str) -> list[date]:
    """The dates that have a folder ``day=...`` in a table's path: names are listed, no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in system.listStatus(folder)] if system.exists(folder) else []
    days = [x.removeprefix(f"{day}=") for x in names if x.startswith(f"{day}=")]
    return [date.fromisoformat(x) for x in days if x[:1].isdigit()]


def newest_day(spark: SparkSession, path: str, day: str):
    """The last date that has a folder ``day=...`` in a table's path, or None."""
    return max(days_in(spark, path, day), default=None)


def high_water_mark(target: DataFrame, column: str, day: str | None = None, path: str | None = None):
    """The largest value in the table, or None for an empty one: a single value to the driver.

    With ``day``, the table's date partition column that is derived from ``column``, only the
    newest day is read for it. That day comes from the names of the folders in ``path``, or without
    one from a query that reads no data column but opens every file.
    """
    if day:
        newest = newest_day(target.sparkSession, path, day) if path else target.agg(F.max(day)).first()[0]
        if newest is not None:
            target = target.filter(F.col(day) == _literal(newest, target, day))
    return target.agg(F.max(column)).first()[0]


def newer_than_mark(batch: DataFrame, mark, column: str) -> DataFrame:
    """Rows strictly after the mark; all rows without one.

    The mark is a literal, so Parquet skips files and row groups by it. Rows at the mark itself
    and late rows before it are not loaded; :func:`not_loaded` finds those too.
    """
    if mark is None:
        return batch
    return batch.filter(F.col(column) > _literal(mark, batch, column))


def at_or_before_mark(batch: DataFrame, target: DataFrame, keys: Sequence[str], mark, column: str) -> DataFrame:
    """The rows a strict mark leaves behind: not after the mark, and not in the table either."""
    return not_loaded(batch.filter(F.col(column) <= _literal(mark, batch, column)), target, keys, column)


# Of more days than these only the first and the last are kept.
MOST_DAYS = 10_000


class Extent(NamedTuple):
    """Number of rows, first and last value of a column, rows without one, bytes of the key columns, and the days of the
    column (None if they are too many, or if it holds no times)."""

    rows: int
    first: object
    last: object
    nulls: int
    bytes: int
    days: tuple[date, ...] | None = None


def extent(rows: DataFrame, column: str, keys: Sequence[str] | None = None) -> Extent:
    """One pass; what reaches the driver is one row and the distinct dates, of which a calendar has few."""
    size = F.coalesce(F.sum(row_bytes(rows.select(*(keys or [column])))), F.lit(0))
    dated = isinstance(rows.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    *sizes, days = rows.agg(
        F.count(F.lit(1)), F.min(column), F.max(column), F.count_if(F.col(column).isNull()), size,
        F.collect_set(F.to_date(column)) if dated else F.lit(None),
    ).first()
    return Extent(*sizes, tuple(sorted(days)) if dated and len(days) <= MOST_DAYS else None)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def not_loaded(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    column: str,
    day: str | None = None,
    within: Extent | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of the batch whose key the table lacks. NULL in a key is a value like any other.

    One pass over the batch gives its extent in time, unless the caller knows it (``within``). It
    limits the part of the table that is read, by ``day`` (a date partition column; only the folders of the batch's own
    days are opened, however far apart they are) and by the time column itself. For a batch counted small, its keys are broadcast to thin out the table before
    the anti-join, so that the table is scanned but never shuffled.
    """
    keys = list(keys)
    within = within or extent(batch, column, keys)
    if within.rows == 0:
        return batch
    known = target
    if within.first is not None:
        first, last = _literal(within.first, batch, column), _literal(within.last, batch, column)
        between = {column: F.col(column).between(first, last)}
        if day and within.days is not None:
            between[day] = F.col(day).isin([F.lit(x) for x in within.days])  # other days between are not opened
        elif day:
            between[day] = F.col(day).between(first.cast("date"), last.cast("date"))
        for name, found in between.items():
            known = known.filter(found | F.col(name).isNull() if within.nulls else found)
    else:
        known = known.filter(F.col(column).isNull())
    known = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
    if within.rows <= max_rows and within.bytes <= BROADCAST_BYTES:
        fresh = batch.select(*keys)
        known = known.join(F.broadcast(fresh), _same(fresh, known, keys), "left_semi")
    return batch.join(known, _same(batch, known, keys), "left_anti")


def one_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest under the remaining columns, so that reruns choose alike."""
    rest = [c for c in batch.columns if c not in keys]
    return first_per_key(batch, keys, *rest)
