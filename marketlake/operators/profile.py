"""Data-quality profile: NULLs, types, distinct values, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.constraints import repeated_keys
from marketlake.operators.incremental import days_in
from marketlake.operators.joins import BROADCAST_ROWS, fits_broadcast, join_dimension
from marketlake.operators.sinks import DAY
from marketlake.session import stored


def _one_row_per_column(totals: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn one row of totals named <column>_<suffix> into a row per column."""
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}{suffix}`").alias(n) for n, suffix in fields.items()])
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def null_profile(rows: DataFrame) -> DataFrame:
    """column, dtype, nulls, non_null for every column, from one pass."""
    totals = rows.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in rows.columns],
        *[F.count(c).alias(f"{c}_filled") for c in rows.columns],
    )
    profile = _one_row_per_column(totals, rows.columns, {"nulls": "_nulls", "non_null": "_filled"})
    dtype = F.create_map(*[F.lit(x) for pair in rows.dtypes for x in pair])
    return profile.select("column", dtype[F.col("column")].alias("dtype"), "nulls", "non_null")


def columns_with_nulls(rows: DataFrame) -> DataFrame:
    """Only the columns that have NULLs, with their number; no rows means a complete table."""
    return null_profile(rows).filter("nulls > 0").select("column", "nulls")


def distinct_profile(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """column, distinct_values (NULL not counted). ``approximate`` trades a shuffle for a sketch."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    totals = rows.agg(*[count(F.col(c)).alias(f"{c}_distinct") for c in rows.columns])
    return _one_row_per_column(totals, rows.columns, {"distinct_values": "_distinct"})


def _beyond_first(groups: DataFrame, check: str) -> DataFrame:
    extra = F.coalesce(F.sum(F.col("rows") - 1), F.lit(0))
    return groups.agg(extra.alias("duplicates")).select(F.lit(check).alias("check"), "duplicates")


def duplicate_profile(rows: DataFrame, key: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows beyond the first copy, for whole rows and for the key: check, duplicates.

    A copy of a row repeats its key too. So the key columns alone are grouped first and written, and if few keys
    are repeated, only their rows are compared as a whole; a clean table is then never shuffled in
    full width. With many repeated keys whole rows are grouped, and the key counts are sums of those.
    Either way copies are counted inside each map task before the shuffle.
    """
    repeated = stored(repeated_keys(rows, key), "repeated")
    if fits_broadcast(repeated, max_rows=max_rows):
        named = F.broadcast(repeated.select(*[F.col(c).alias(f"_{c}") for c in key]))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
        copies = rows.join(named, same, "left_semi").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("rows"))
        return _beyond_first(copies, "full row").unionByName(_beyond_first(repeated, "key"))
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    by_key = copies.groupBy(*key).agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_extra"))
    totals = by_key.agg(F.sum("_extra").alias("full row"), F.sum(F.col("_n") - 1).alias("key"))
    return totals.unpivot([], ["full row", "key"], "check", "duplicates").select(
        "check", F.coalesce("duplicates", F.lit(0)).alias("duplicates")
    )


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """The rows that occur more than once, each once, with ``copies``.

    What is shuffled first is a digest of 128 bits a row, and full rows only where a digest repeats: a wide table
    without copies is never shuffled. Rows of one digest are compared as a whole, so none is taken for another. Both
    steps read the rows: give ones that are stored if they are dear to compute.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    nulls = F.concat(*(F.when(c.isNull(), "0").otherwise("1") for c in columns))  # hashes skip nulls
    marked = rows.withColumns({"_d1": F.xxhash64(F.lit(1), *columns, nulls), "_d2": F.xxhash64(F.lit(2), nulls, *columns)})
    repeated = marked.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_d1", "_d2")
    again = join_dimension(marked, stored(repeated, "repeated"), ["_d1", "_d2"], "left_semi").select(*columns)
    return again.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


# A stored profile: what a day (its folder) has of each column. Sketches of days merge to that of all.
DAY_PROFILE = T.StructType(
    [T.StructField("column", T.StringType()), T.StructField("dtype", T.StringType())]
    + [T.StructField(x, T.LongType()) for x in ("nulls", "non_null")]
    + [T.StructField("sketch", T.BinaryType())]
)
SKETCH_BITS = 14  # log2 of the sketch's registers: a standard error of 0.8 per cent


def day_profiles(rows: DataFrame, day: str = DAY) -> DataFrame:
    """day, column, dtype, nulls, non_null and a sketch of the distinct values, for each day and each other column."""
    columns = [c for c in rows.columns if c != day]
    hashed = F.xxhash64  # one kind of number for values of any type
    parts = rows.groupBy(day).agg(*[
        F.struct(
            F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"), F.count(F.col(f"`{c}`")).alias("non_null"),
            F.hll_sketch_agg(F.when(F.col(f"`{c}`").isNotNull(), hashed(F.col(f"`{c}`"))), F.lit(SKETCH_BITS)).alias("sketch"),
        ).alias(f"_{k}") for k, c in enumerate(columns)
    ])
    kinds = dict(rows.dtypes)
    each = [
        F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(f"_{k}.nulls").alias("nulls"), F.col(f"_{k}.non_null").alias("non_null"), F.col(f"_{k}.sketch").alias("sketch"))
        for k, c in enumerate(columns)
    ]
    return parts.select(day, F.inline(F.array(*each)))


def profile_new_days(spark: SparkSession, path: str, schema: T.StructType, profiles: str) -> int:
    """Profile the days of a table in day folders that have no stored profile yet, and only those; returns how many. A
    day is taken to be complete; remove its profile folder where it is not."""
    new = sorted(set(days_in(spark, path, DAY)) - set(days_in(spark, profiles, DAY)))
    if new:
        full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
        rows = spark.read.schema(full).parquet(path).filter(F.col(DAY).isin([F.lit(x) for x in new]))
        day_profiles(rows).write.mode("append").partitionBy(DAY).parquet(profiles)
    return len(new)


def merged_profile(spark: SparkSession, profiles: str) -> DataFrame:
    """column, dtype, nulls, non_null, distinct_values (about) of all stored days: days are merged, no table is read."""
    full = T.StructType([*DAY_PROFILE.fields, T.StructField(DAY, T.DateType())])
    return spark.read.schema(full).parquet(profiles).groupBy("column", "dtype").agg(
        F.sum("nulls").alias("nulls"), F.sum("non_null").alias("non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )
