"""Lookups of dimension rows from large fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What may be broadcast: at most this many rows and this many bytes in them.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def row_bytes(rows: DataFrame) -> Column:
    """About the bytes of a row: text and binary by their length, arrays, maps and structs by their JSON."""
    sizes = [F.lit(0)]
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.lit(16))
            continue
        sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
    return sum(sizes[1:], sizes[0]).cast("long")


def fits_broadcast(dimension: DataFrame, bound: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the dimension is small enough, by counting its rows and their bytes.

    The answer is a bound, not an estimate. ``bound`` is a cheaper frame with at least as many
    rows: if that is too long already, the dimension itself is not computed for the check.
    """
    if bound is not None and bound.count() > max_rows:
        return False
    size = dimension.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(dimension)), F.lit(0))).first()
    return size[0] <= max_rows and size[1] <= BROADCAST_BYTES


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    on: str | list[str],
    how: str = "inner",
    bound: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a fact to a dimension with one row per key.

    A dimension that is counted small is broadcast and the fact is not shuffled. A larger one is
    left to a shuffle join, where adaptive execution splits the partitions of hot keys. A dimension that is a
    join or an aggregate itself is best given ``stored``: it is read once for the check and once for the join.
    """
    if fits_broadcast(dimension, bound, max_rows):
        dimension = F.broadcast(dimension)
    return fact.join(dimension, on, how)


def lookup(rows: DataFrame, dimension: DataFrame, on: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their dimension columns, and the rows that have no dimension row."""
    small = fits_broadcast(dimension)
    matched = rows.join(F.broadcast(dimension) if small else dimension, on)
    keys = dimension.select(on)
    return matched, rows.join(F.broadcast(keys) if small else keys, on, "left_anti")


def missing_keys(rows: DataFrame, master: DataFrame, on: str) -> DataFrame:
    """Distinct keys that the master data lacks; distinct comes first, so hot keys are one row."""
    return rows.select(on).distinct().join(master.select(on), on, "left_anti")
