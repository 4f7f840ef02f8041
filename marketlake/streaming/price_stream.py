"""The scheduled fact load: new price files since the last run, added to the fact table by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.plans.loads import load_facts
from marketlake.streaming.files import each_new_batch


def load_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    to_facts: Callable[[DataFrame], DataFrame],
    star: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> int:
    """Load the Parquet price files under ``landing`` that no earlier run has seen.

    ``to_facts`` turns landed rows into TIME_ID, PAIR_ID, SOURCE_ID, PRICE. Returns the number of facts added.
    """
    return each_new_batch(
        spark, landing, schema, checkpoint, lambda batch: load_facts(spark, batch, star), to_facts, files_per_batch
    )
