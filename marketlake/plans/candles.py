"""Daily candles from single prices: opening, highest, lowest and closing price and the number of prices.

A part of a candle is an aggregate that merges: the first and the last price are the least and the greatest
(time, id, price), so parts of one day, from several batches or files, add up to the candle of the whole. Stored parts
are kept by batch; a batch that is loaded again replaces its own parts, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.literals import no_rows

KEYS = ("Pair_ID",)
BATCH = "batch"


def candle_parts(prices: DataFrame, keys: Sequence[str] = KEYS, tie: str = "Price_Hist_ID") -> DataFrame:
    """keys, Day, First, Last, High, Low, Trades of the prices of each day. Of prices of one time the one of least
    ``tie`` comes first. Prices without a time or a value are left out. Every map task sends one row per key and day."""
    tick = F.struct(F.col("Timestamp"), F.col(tie).alias("Tie"), F.col("Price"))
    good = prices.filter("Timestamp IS NOT NULL AND Price IS NOT NULL")
    return good.groupBy(*keys, F.to_date("Timestamp").alias("Day")).agg(
        F.min(tick).alias("First"), F.max(tick).alias("Last"), F.max("Price").alias("High"), F.min("Price").alias("Low"), F.count(F.lit(1)).alias("Trades")
    )


def merged_parts(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One part for each key and day."""
    return parts.groupBy(*keys, "Day").agg(
        F.min("First").alias("First"), F.max("Last").alias("Last"), F.max("High").alias("High"), F.min("Low").alias("Low"), F.sum("Trades").alias("Trades")
    )


def candles(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, Day, Open, High, Low, Close, Trades of parts that are the only ones of their key and day."""
    return parts.select(*keys, "Day", F.col("First.Price").alias("Open"), "High", "Low", F.col("Last.Price").alias("Close"), "Trades")


def daily_candles(prices: DataFrame, keys: Sequence[str] = KEYS, tie: str = "Price_Hist_ID") -> DataFrame:
    return candles(candle_parts(prices, keys, tie), keys)


def add_candle_parts(prices: DataFrame, home: str, batch: str) -> None:
    """Store the parts of a batch of prices below ``home``, in place of those that the batch left before."""
    candle_parts(prices).write.mode("overwrite").parquet(f"{home}/candle_parts/{BATCH}={batch}")


def open_candles(spark: SparkSession, home: str, empty: DataFrame) -> DataFrame:
    """The candles of all stored parts. ``empty`` (prices, of which no row is read) gives the types."""
    schema = candle_parts(empty).schema
    no_rows(spark, schema).write.mode("ignore").parquet(f"{home}/candle_parts/{BATCH}=_none")
    return candles(merged_parts(spark.read.schema(schema).parquet(f"{home}/candle_parts")))
