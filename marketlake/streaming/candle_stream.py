"""Daily candles as a stateful stream: windows in Spark's state store, with what came too late beside them.

New price files are read as a stream with an event-time watermark. Each pair and day is a window whose candle is kept
in the state store and updated by every batch; a window that the watermark has passed is closed, and Spark drops the
prices that come for it later. These are found as the prices of a batch whose window the batch did not update, and
stored apart, so no price is lost.

Every batch replaces what it wrote itself, so one that is repeated after a failure counts once. The newest batch that
has a window has its candle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import scratch, stored
from marketlake.sources.literals import no_rows

_PRICE = T.DecimalType(20, 8)
CANDLES = T.StructType(
    [T.StructField("Pair_ID", T.LongType()), T.StructField("Day", T.DateType())]
    + [T.StructField(x, _PRICE) for x in ("Open", "High", "Low", "Close")]
    + [T.StructField("Trades", T.LongType())]
)
LATE = T.StructType().add("Pair_ID", T.LongType()).add("Timestamp", T.TimestampNTZType()).add("Price_Hist_ID", T.LongType()).add("Price", _PRICE)
BATCH = "batch"


def load_candle_stream(
    spark: SparkSession, landing: str, schema: T.StructType, home: str, delay: str = "1 day", files_per_batch: int = 1000
) -> int:
    """One scheduled run: the Parquet price files under ``landing`` (Pair_ID, Timestamp, Price_Hist_ID, Price) that no
    earlier run has seen. ``delay`` is by how much prices may be older than the newest one of earlier batches. Returns
    the number of late prices. Prices without a time or a value are left out."""
    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    ticks = landed.select(*(F.col(x.name).cast(x.dataType) for x in LATE)).filter("Timestamp IS NOT NULL AND Price IS NOT NULL")
    tick = F.struct("Timestamp", "Price_Hist_ID", "Price")
    windows = (
        ticks.withColumn("time", F.col("Timestamp").cast("timestamp")).withWatermark("time", delay)
        .groupBy("Pair_ID", F.window("time", "1 day").alias("window"))
        .agg(F.min(tick).alias("first"), F.max(tick).alias("last"), F.max("Price").alias("High"), F.min("Price").alias("Low"), F.count(F.lit(1)).alias("Trades"))
    ).select(
        "Pair_ID", F.col("window.start").cast("date").alias("Day"), F.col("first.Price").alias("Open"), "High", "Low",
        F.col("last.Price").alias("Close"), "Trades",
    )
    late = []

    def each(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            rows = stored(batch, "candle-batch")
            updated = rows.filter("Trades IS NOT NULL").select(*CANDLES.names)
            updated.write.mode("overwrite").parquet(f"{home}/candles/{BATCH}={batch_id}")
            prices = rows.filter("Trades IS NULL").withColumn("Day", F.to_date("Timestamp"))
            missed = stored(prices.join(updated.select("Pair_ID", "Day"), ["Pair_ID", "Day"], "left_anti").select(*LATE.names), "late")
            missed.write.mode("overwrite").parquet(f"{home}/late/{BATCH}={batch_id}")
            late.append(missed.count())

    run = (
        windows.unionByName(ticks, allowMissingColumns=True)
        .writeStream.outputMode("update").foreachBatch(each)
        .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return sum(late)


def _open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    no_rows(spark, schema).write.mode("ignore").parquet(f"{path}/{BATCH}=-1")
    return spark.read.schema(full).parquet(path)


def open_candles(spark: SparkSession, home: str) -> DataFrame:
    """The candles as of the last batch."""
    newest = F.max_by(F.struct(*(x for x in CANDLES.names if x not in ("Pair_ID", "Day"))), BATCH).alias("newest")
    return _open(spark, f"{home}/candles", CANDLES).groupBy("Pair_ID", "Day").agg(newest).select("Pair_ID", "Day", "newest.*")


def open_late(spark: SparkSession, home: str) -> DataFrame:
    """The prices that came when their day was closed."""
    return _open(spark, f"{home}/late", LATE).drop(BATCH)
