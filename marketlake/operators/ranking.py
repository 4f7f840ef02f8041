"""First row per key, top rows, and positions over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlake.session import stored

# monotonically_increasing_id puts the partition in the bits above these.
_ROW_BITS = 33


def first_per_key(rows: DataFrame, keys: str | Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key under a total order.

    Spark keeps one row per key in every map task before the shuffle (WindowGroupLimit), so a hot
    key sends one row per task and no task sees the whole group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def top_rows(rows: DataFrame, count: int, *order: Column | str) -> DataFrame:
    """The first ``count`` rows under a total order; each task keeps only that many."""
    return rows.orderBy(*order).limit(count)


def with_position(rows: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Number all rows 0, 1, 2, ... under a total order, without a single-task window.

    The rows are range-sorted once and written with their place inside each range. The start of a
    range is the sum of the sizes of the ranges before it: one row per range, at most
    ``spark.sql.shuffle.partitions`` of them, which bounds both the window and the broadcast.
    Reading the written table means both passes see the same ranges, also after lost executors.
    """
    placed = stored(rows.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "positions")

    within = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    block = F.shiftright("_slot", _ROW_BITS)
    sizes = placed.groupBy(block.alias("_block")).agg((F.max(within) + 1).alias("_size"))
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_block", block)
        .join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_start") + within)
        .drop("_block", "_start", "_slot")
    )
