"""Landed API payloads: tickers, quotes, asset map, candles.

Fetching is somebody else's job; these readers take the files it left. Records that do not parse
are kept beside the good ones (see :func:`set_aside`) instead of being lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.schemas import CANDLE_FIELDS, CORRUPT


def _json(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .json(path)
    )


def read_tickers(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Ticker prices: one object per line, or a JSON list of objects. Prices stay text."""
    return _json(spark, path, schemas.TICKER, multiline)


def set_aside(records: DataFrame, required: str) -> tuple[DataFrame, DataFrame]:
    """Split into records that parsed and have the ``required`` field, and all others."""
    bad = F.col(CORRUPT).isNotNull() | F.col(required).isNull()
    return records.filter(~bad).drop(CORRUPT), records.filter(bad)


def read_quotes(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Quote payloads as landed: ``data`` maps each asset to its tags and prices; ``landed`` is the
    time of the file. ``set_aside(..., "data")`` gives the payloads that did not parse."""
    return _json(spark, path, schemas.QUOTES, multiline).withColumn("landed", F.col("_metadata.file_modification_time"))


def flatten_quotes(payloads: DataFrame, currency: str = "USD") -> DataFrame:
    """One row per asset: symbol, Raw_Tags (empty if missing), Global_Price_USD (NULL if missing), and the
    other columns of the payload. Payloads without ``data`` have no rows: set them aside first."""
    others = [c for c in payloads.columns if c not in ("data", CORRUPT)]
    return payloads.select(*others, F.explode("data").alias("symbol", "asset")).select(
        *others,
        "symbol",
        F.coalesce(F.col("asset.tags"), F.array().cast("array<string>")).alias("Raw_Tags"),
        F.try_element_at(F.col("asset.quote"), F.lit(currency))["price"].cast(schemas.PRICE).alias("Global_Price_USD"),
    )


def parse_quotes(payloads: DataFrame, text: str) -> DataFrame:
    """Quote payloads held as JSON text in a column, flattened."""
    data = F.from_json(text, T.StructType([schemas.QUOTES["data"]]))
    return flatten_quotes(payloads.select(data.alias("payload")).select("payload.data"))


def read_asset_map(spark: SparkSession, path: str, enveloped: bool = False, multiline: bool = False) -> DataFrame:
    """The asset map: id, symbol, name, rank, and the text of what did not parse (see :func:`set_aside`);
    ``enveloped`` if the list sits under ``data``."""
    if not enveloped:
        return _json(spark, path, schemas.ASSET, multiline)
    asset = T.StructType([f for f in schemas.ASSET if f.name != CORRUPT])
    envelope = T.StructType().add("data", T.ArrayType(asset)).add(CORRUPT, T.StringType())
    return _json(spark, path, envelope, multiline).select(CORRUPT, F.inline_outer("data")).select(*schemas.ASSET.names)


def read_candles(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Candle payloads as text column ``value``.

    A payload is a JSON list of lists without the symbol in it, so it is landed in folders
    ``symbol=...`` below ``path`` and the symbol comes back as a partition column.
    """
    return spark.read.text(path, wholetext=whole_files)


def _whole(candles: Column) -> Column:
    """Whether this is a list of candles, all with a time and a close."""
    whole = F.forall(candles, lambda c: c.isNotNull() & _field(c, "timestamp").isNotNull() & _field(c, "close").isNotNull())
    return F.coalesce(whole, F.lit(False))


def set_aside_candles(payloads: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Payloads that are a list of candles with a time and a close, and all others."""
    good = _whole(F.from_json(text, "array<array<string>>"))
    return payloads.filter(good), payloads.filter(~good)


def candles_and_rejects(payloads: DataFrame, text: str = "value") -> DataFrame:
    """Both in one pass: a row per candle as :func:`parse_candles` gives it, and a row per payload that does not
    parse, with its text in the column for corrupt records."""
    others = [c for c in payloads.columns if c != text]
    parsed = payloads.withColumn("_candles", F.from_json(text, "array<array<string>>")).withColumn("_good", _whole(F.col("_candles")))
    rows = parsed.select(
        *others, F.when(~F.col("_good"), F.col(text)).alias(CORRUPT), F.explode_outer(F.when(F.col("_good"), F.col("_candles"))).alias("candle")
    )
    fields = [F.try_element_at("candle", F.lit(i)).alias(name) for i, name in enumerate(CANDLE_FIELDS, start=1)]
    return rows.filter(F.col("candle").isNotNull() | F.col(CORRUPT).isNotNull()).select(*others, CORRUPT, *fields)


def _field(candle: Column, name: str) -> Column:
    return F.try_element_at(candle, F.lit(CANDLE_FIELDS.index(name) + 1))


def parse_candles(payloads: DataFrame, text: str = "value") -> DataFrame:
    """One row per candle with its twelve fields as text, next to the payload's other columns. Payloads that do
    not parse have no rows: see :func:`set_aside_candles`."""
    others = [c for c in payloads.columns if c != text]
    candle = F.explode(F.from_json(text, "array<array<string>>")).alias("candle")
    fields: list[Column] = [
        F.try_element_at("candle", F.lit(i)).alias(name) for i, name in enumerate(CANDLE_FIELDS, start=1)
    ]
    return payloads.select(*others, candle).select(*others, *fields)


def read_candle_list(spark: SparkSession, path: str) -> DataFrame:
    """Candle payloads of any size: a row per candle with its twelve fields as text, and a row per text that is none, in
    the column for corrupt records; next to the partition columns of ``path``.

    A payload is one JSON list of lists, on one line or many. It is read as text cut at the brackets that end its candles, so
    Spark gives one file to many tasks and no task holds more than its split. What opens the list, what closes it and
    the commas between are taken off, and every candle is parsed by itself: a broken one rejects itself only.
    """
    pieces = spark.read.option("lineSep", "]").text(path)
    others = [c for c in pieces.columns if c != "value"]
    # A candle that is not closed runs on to the next one's opening bracket.
    opened = pieces.select(*others, F.explode(F.split("value", r"\[")).alias("body"))
    body = F.regexp_replace("body", r"^[\s,]+|[\s,]+$", "")
    parsed = opened.select(*others, body.alias("body")).filter("body != ''")
    parsed = parsed.withColumn("_candle", F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>"))
    good = F.coalesce(_field(F.col("_candle"), "timestamp").isNotNull() & _field(F.col("_candle"), "close").isNotNull(), F.lit(False))
    fields = [F.when(good, F.try_element_at("_candle", F.lit(i))).alias(name) for i, name in enumerate(CANDLE_FIELDS, start=1)]
    return parsed.select(*others, F.when(~good, F.col("body")).alias(CORRUPT), *fields)
