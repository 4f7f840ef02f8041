"""New files of a folder, batch by batch, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.session import scratch, stored


def each_new_batch(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    load: Callable[[DataFrame], int],
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    files_per_batch: int = 1000,
) -> int:
    """Call ``load`` for the Parquet files under ``folder`` that no earlier run has seen; returns the sum.

    One call is one scheduled run, and the checkpoint is its memory. A batch is bounded by its number of
    files; it is written to the shared folder first, since a load goes over it several times, and removed
    afterwards. A batch that is repeated after a failure must add nothing twice: loads compare keys.
    ``prepare`` is part of the stream, so that only the columns it needs are read.
    """
    added = []
    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def each(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            added.append(load(stored(batch, "batch")))

    run = (
        prepare(landed)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return sum(added)
