"""CSV extracts and exports, Parquet staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.temporal import from_offset_text


def read_csv(spark: SparkSession, path: str, schema: T.StructType, timestamp_format: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def read_ticker_extract(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TICKER_EXTRACT, "yyyy-MM-dd HH:mm:ss")


def read_star_export(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three exported star tables, with zone offsets dropped from their timestamps."""
    time = read_csv(spark, f"{folder}/dim_time", schemas.EXPORT_DIM_TIME)
    currency = read_csv(spark, f"{folder}/dim_currency", schemas.EXPORT_DIM_CURRENCY)
    fact = read_csv(spark, f"{folder}/fact_pairs", schemas.EXPORT_FACT_PAIRS)
    return {
        "dim_time": time.withColumn("Timestamp", from_offset_text(F.col("Timestamp"))),
        "dim_currency": currency,
        "fact_pairs": fact.withColumn("TIME_ID", from_offset_text(F.col("TIME_ID"))),
    }


def read_staging(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One staged Parquet table, as :func:`marketlake.operators.sinks.write_staging` left it."""
    return spark.read.parquet(f"{folder}/{name}")
