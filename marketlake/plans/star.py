"""The star schema: dimensions, facts, exports and the category view.

A fact is joined once: its dimensions are put together first, and that one frame is broadcast if it
is counted small, else joined by a single shuffle of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.temporal import calendar_parts
from marketlake.operators.joins import join_dimension
from marketlake.operators.ranking import first_per_key
from marketlake.operators.upsert import upsert_with_ids
from marketlake.plans.normalise import EXCHANGE, REFERENCE
from marketlake.schemas import DIM_SOURCE
from marketlake.sources.literals import literal_rows

# The rows the source dimension starts with.
SOURCE_SEED = ((1, EXCHANGE), (2, REFERENCE))
# The member that prices without a source belong to.
UNKNOWN_SOURCE = "unknown"

_STAR_PARTS = {p.upper(): p for p in ("day", "month", "year", "quarter", "hour", "minute", "second")}
_EXPORT_PARTS = {p.capitalize(): p for p in ("year", "month", "day", "quarter")}


def unique_metadata(metadata: DataFrame, key: str = "symbol") -> DataFrame:
    """One asset per symbol: the best rank; unranked assets come last, ties go to the lower id."""
    return first_per_key(metadata, key, F.col("rank").asc_nulls_last(), F.col("id").asc_nulls_last())


def with_assets(pair: DataFrame, currency: DataFrame) -> DataFrame:
    """Pairs with name and type of their base and quote asset: currency in two roles."""
    def role(prefix: str, id_column: str) -> DataFrame:
        return currency.select(
            F.col("Currency_ID").alias(id_column),
            F.col("Currency_Name").alias(f"{prefix}_CURRENCY"),
            F.col("Asset_Type").alias(f"{prefix}_ASSET_TYPE"),
        )

    based = pair.join(role("BASE", "Base_Currency_ID"), "Base_Currency_ID")
    return based.join(role("QUOTE", "Quote_Currency_ID"), "Quote_Currency_ID")


def enriched_prices(prices: DataFrame, pair: DataFrame, currency: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every price with its base currency, category and the metadata of that currency, if any.

    Names match whatever their case, so the metadata is made unique on the upper-case symbol.
    """
    names = currency.select(
        F.col("Currency_ID").alias("Base_Currency_ID"), "Currency_Name", F.upper("Currency_Name").alias("_symbol")
    )
    meta = unique_metadata(metadata.withColumn("_symbol", F.upper("symbol")), "_symbol")
    described = names.join(meta.select("_symbol", "symbol", "name"), "_symbol", "left")
    dimension = pair.select("Pair_ID", "Base_Currency_ID", "Manual_Category").join(described, "Base_Currency_ID")
    return join_dimension(prices, dimension, "Pair_ID", bound=pair).select(
        "Timestamp", "Currency_Name", "Price", "Manual_Category", "symbol", "name"
    )


def fact_pairs(prices: DataFrame, pair: DataFrame, currency: DataFrame) -> DataFrame:
    known = currency.select(F.col("Currency_ID").alias("Base_Currency_ID"))
    dimension = pair.select("Pair_ID", "Pair_Name", "Base_Currency_ID").join(known, "Base_Currency_ID")
    return join_dimension(prices, dimension, "Pair_ID", bound=pair).select(
        F.col("Timestamp").alias("TIME_ID"),
        F.col("Base_Currency_ID").alias("Currency_ID"),
        "Pair_ID",
        "Pair_Name",
        "Price",
    )


def dim_time(times: DataFrame, column: str = "Timestamp") -> DataFrame:
    """One row per distinct time, with its seven calendar parts."""
    distinct = times.select(F.col(column).alias("TIME_ID")).distinct()
    return distinct.select("TIME_ID", *calendar_parts(F.col("TIME_ID"), _STAR_PARTS))


def export_dim_time(prices: DataFrame) -> DataFrame:
    distinct = prices.select("Timestamp").distinct()
    return distinct.select("Timestamp", *calendar_parts(F.col("Timestamp"), _EXPORT_PARTS))


def dim_currency(currency: DataFrame) -> DataFrame:
    return currency.select("Currency_ID", "Currency_Name", "Asset_Type")


def dim_pair(pair: DataFrame, currency: DataFrame) -> DataFrame:
    return with_assets(pair, currency).select(
        F.col("Pair_ID").alias("PAIR_ID"),
        F.col("Pair_Name").alias("PAIR_NAME"),
        F.col("Manual_Category").alias("CATEGORY_NAME"),
        "BASE_CURRENCY",
        "BASE_ASSET_TYPE",
        "QUOTE_CURRENCY",
        "QUOTE_ASSET_TYPE",
    )


def seed_sources(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, DIM_SOURCE, SOURCE_SEED)


def dim_source(existing: DataFrame, prices: DataFrame) -> DataFrame:
    """The source dimension with the sources of these prices; known ones keep their id. Prices without a
    source add the member ``unknown``."""
    seen = prices.select(_source().alias("SOURCE_NAME")).distinct()
    return upsert_with_ids(existing, seen, "SOURCE_NAME", (), "SOURCE_ID")


def _source() -> Column:
    return F.coalesce("Source", F.lit(UNKNOWN_SOURCE))


def fact_price(prices: DataFrame, sources: DataFrame | None = None, source_id: int = 1) -> DataFrame:
    """TIME_ID, PAIR_ID, SOURCE_ID, PRICE in load order of columns.

    With the source dimension each price gets the id of its own source, else all get ``source_id``. No price
    is left out: one whose source the dimension lacks has a NULL id, which the foreign-key check shows.
    """
    if sources is None:
        rows = prices.withColumn("SOURCE_ID", F.lit(source_id))
    else:
        named = prices.withColumn("Source", _source())
        rows = join_dimension(named, sources.withColumnRenamed("SOURCE_NAME", "Source"), "Source", "left")
    return rows.select(
        F.col("Timestamp").alias("TIME_ID"),
        F.col("Pair_ID").cast("bigint").alias("PAIR_ID"),
        "SOURCE_ID",
        F.col("Price").alias("PRICE"),
    )


def category_performance(fact: DataFrame, pairs: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Prices with category and day parts, for facts with a row in every dimension.

    The time dimension can be as long as the fact, so it is not counted first; Spark broadcasts it
    if its files are small. Where the foreign key to it has been checked, leave ``times`` out: the
    parts then come from TIME_ID itself, and the second large join goes.
    """
    named = join_dimension(fact, pairs.select("PAIR_ID", "PAIR_NAME", "CATEGORY_NAME"), "PAIR_ID")
    if times is None:
        parts = calendar_parts(F.col("TIME_ID"), {p: p.lower() for p in ("DAY", "MONTH", "YEAR")})
        return named.select("PAIR_NAME", "PRICE", "CATEGORY_NAME", *parts, "TIME_ID")
    dated = named.join(times.select("TIME_ID", "DAY", "MONTH", "YEAR"), "TIME_ID")
    return dated.select("PAIR_NAME", "PRICE", "CATEGORY_NAME", "DAY", "MONTH", "YEAR", "TIME_ID")
