"""Constraint checks: each returns the violating rows or keys, none of them if the rule holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_rows(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a column that must have a value."""
    return rows.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]))


def repeated_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a value of one of these columns occurs more than once, naming the first such values."""
    values = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])).alias("x"))
    found = repeated_keys(values.select("x.*"), ["key", "value"]).limit(5).collect()
    if found:
        raise ValueError("not unique: " + ", ".join(f"{x.key} {x.value}" for x in found))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with the number of rows; NULL is no violation.

    Rows are counted per key before the join, so a hot key is one row in it.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def violation_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """rule, violations: the number of rows or keys each check returned."""
    parts = [found.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")
             for rule, found in checks.items()]
    return reduce(DataFrame.unionByName, parts)
