"""Joins of a long table with groups of itself, where one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apart(groups: DataFrame, *keys: str) -> DataFrame:
    """Groups, one row per key, to be joined with the rows that they were made from.

    A group's rows are already where the join wants them, so Spark would put the aggregate and the join into one
    stage, and adaptive execution could not split the partition of a hot key there. With the keys written as an
    expression the groups, short rows and one per key, are shuffled once more by themselves; the long side
    can then be split.
    """
    return groups.withColumns({key: F.greatest(key, key) for key in keys})
