"""Small frames from values in the program. They are built from literals inside the JVM: no Python
workers are started for them, and the optimizer sees their size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, schema: T.StructType, values: Iterable[tuple]) -> DataFrame:
    rows = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(schema, row, strict=True)])
        for row in values
    ]
    if not rows:
        return no_rows(spark, schema)
    return spark.range(1).select(F.inline(F.array(*rows)))


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in schema])
