"""Shuffle a corpus into shards of equal row counts with a two-pass external shuffle, in DataFrame code only.

Pass one scatters the records uniformly, by a seeded hash, into buckets that fit in a task's memory. Pass two
loads each bucket, puts it in a canonical order, shuffles it (``shuffle`` of Spark is an inside-out Fisher-Yates
shuffle) and writes it. Buckets follow each other, so a record's place in the whole is its place in its
bucket after the rows of the buckets before, and shard s takes the places from s*N/shards on: counts differ by one
at most (law ``rows``).

Bucket i is partition i, so the seed of its shuffle is ``seed + i``: the same rows give the same shards on
every run and after a lost executor. The number of buckets follows the bytes; the only thing that passes
through one task is one row per bucket. Which bucket takes a record depends on its doc_id and text, so copies
of a text under other ids are spread; rows that repeat id and text share a bucket, until a bucket has more than twice its
bytes: then they are dealt over all.

Defined cases: a null text has 0 bytes; null ids are ids like any other; repeated rows each get a slot; an
empty table gives no rows. All columns of the documents are kept: the record is written as one struct column, so no
name can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.joins import join_dimension
from marketlake.session import new_folder, stored

BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 200_000  # beyond so many the buckets grow: 100 TB make buckets of 500 MB
_REPEATS = 100  # rows of one key and text that are dealt out of a crowded bucket


def text_size(text) -> F.Column:
    """UTF-8 bytes of a text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shuffle_into_shards(
    docs: DataFrame, folder: str, shards: int = 16, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Write the documents to ``folder`` as shard=0, 1, ..., and return them as they were written:
    shard int, slot long, record struct of all columns. Files hold their rows in slot order."""
    spark = docs.sparkSession
    total, rows = docs.agg(F.coalesce(F.sum(text_size(F.col(text))), F.lit(0)), F.count(F.lit(1))).first()
    bucket_bytes = max(bucket_bytes, total // MOST_BUCKETS)
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(buckets)).cast("int")
    records = docs.select(
        bucket.alias("_bucket"),
        F.xxhash64(F.lit(seed + 1), F.col(key), F.col(text)).alias("_order"),
        F.struct(*(docs[c] for c in docs.columns)).alias("record"),
        F.monotonically_increasing_id().alias("_row"),
    )

    def sized(records: DataFrame) -> DataFrame:
        size = F.sum(text_size(F.col(f"record.`{text}`"))).alias("_bytes")
        return stored(records.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"), size), "buckets")

    sizes = sized(records)
    crowded = sizes.filter(F.col("_bytes") > 2 * bucket_bytes).select("_bucket")
    if not crowded.isEmpty():
        # Rows that repeat a key and a text are dealt over all buckets, by their places in the files.
        repeats = join_dimension(records.select("_bucket", "_order"), crowded, "_bucket").groupBy("_order").count()
        repeats = stored(repeats.filter(F.col("count") > _REPEATS).select("_order", F.lit(True).alias("_repeat")), "repeats")
        dealt = F.pmod(F.xxhash64("_order", "_row"), F.lit(buckets)).cast("int")
        records = join_dimension(records, repeats, "_order", "left").withColumn("_bucket", F.when(F.col("_repeat"), dealt).otherwise(F.col("_bucket")))
        sizes = sized(records)
    records = records.select("_bucket", "_order", "record")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    shuffled = (
        # One small row per bucket: 12 bytes for every bucket_bytes of text.
        records.join(F.broadcast(starts), "_bucket")
        .repartitionById(buckets, F.col("_bucket"))
        .groupBy("_bucket", "_start")
        .agg(F.array_sort(F.collect_list(F.struct("_order", "record"))).alias("_all"))
        .select("_start", F.posexplode(F.shuffle("_all", F.lit(seed))))
    )
    placed = shuffled.select((F.col("_start") + F.col("pos")).alias("_place"), F.col("col.record").alias("record"))
    shard = F.expr(f"cast(_place * {shards} div {max(rows, 1)} as int)")
    slot = F.expr(f"_place - (shard * {rows}L + {shards - 1}) div {shards}")
    placed.withColumn("shard", shard).select("shard", slot.alias("slot"), "record").sortWithinPartitions(
        "shard", "slot"
    ).write.partitionBy("shard").parquet(folder)
    kind = next(f.dataType.simpleString() for f in records.schema if f.name == "record")
    return spark.read.schema(f"slot long, record {kind}, shard int").parquet(folder).select("shard", "slot", "record")


def shard_table(docs: DataFrame, shards: int = 16, seed: int = 42, **options) -> DataFrame:
    """``shuffle_into_shards`` into a new folder of the shared working folder."""
    return shuffle_into_shards(docs, new_folder(docs.sparkSession, "shards"), shards, seed, **options)
