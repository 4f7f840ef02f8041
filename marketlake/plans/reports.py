"""The report queries over the normalised tables and the ticker list.

Orders that a report asks for end in a unique column: the result is then the same on every run,
and the range sort can split a value that most rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.classify import category_or_default
from marketlake.functions.values import to_price
from marketlake.operators.incremental import high_water_mark
from marketlake.operators.joins import join_dimension
from marketlake.operators.ranking import top_rows, with_position
from marketlake.plans.star import with_assets

# Quote assets that count as US dollars.
DOLLAR_QUOTES = ("USDT", "USD")


def pairs_by_category(pair: DataFrame) -> DataFrame:
    category = category_or_default(F.col("Manual_Category"))
    rows = pair.select("Pair_Name", category.alias("Manual_Category"))
    return rows.orderBy(F.col("Manual_Category").desc_nulls_last(), "Pair_Name")


def category_counts(pair: DataFrame) -> DataFrame:
    return pair.groupBy("Manual_Category").agg(F.count(F.lit(1)).alias("Number_of_Pairs"))


def currency_audit(currency: DataFrame) -> DataFrame:
    """Stored type, reference price and tags; the tags as JSON text."""
    return currency.select(
        "Currency_Name", "Asset_Type", "Global_Price_USD", F.to_json("Raw_Tags").alias("Raw_Tags")
    )


def price_against_reference(
    prices: DataFrame, pair: DataFrame, currency: DataFrame, dollar_quotes: Sequence[str] = DOLLAR_QUOTES
) -> DataFrame:
    """Exchange price next to the global price of the base asset, and their difference.

    ``comparable`` tells whether both are in dollars; a price quoted in another asset is not.
    """
    base = currency.select(F.col("Currency_ID").alias("Base_Currency_ID"), F.col("Global_Price_USD").alias("Global_Avg"))
    quote = currency.select(
        F.col("Currency_ID").alias("Quote_Currency_ID"),
        F.col("Currency_Name").isin(*dollar_quotes).alias("comparable"),
    )
    dimension = pair.join(base, "Base_Currency_ID").join(quote, "Quote_Currency_ID", "left")
    dimension = dimension.select("Pair_ID", "Pair_Name", "Manual_Category", "Global_Avg", "comparable")
    return join_dimension(prices, dimension, "Pair_ID", bound=pair).select(
        "Pair_Name",
        F.col("Manual_Category").alias("Mapped_Category"),
        F.col("Price").alias("Exchange_Price"),
        "Global_Avg",
        (F.col("Price") - F.col("Global_Avg")).alias("Price_Difference"),
        "Timestamp",
        "Price_Hist_ID",
        "comparable",
    )


def latest_against_reference(
    prices: DataFrame, pair: DataFrame, currency: DataFrame, count: int = 10, day: str | None = None, **options
) -> DataFrame:
    """The newest ``count`` rows of the comparison.

    With ``day``, the date partition column of a stored price table, its newest day is tried first:
    if that has enough rows, no other day is read.
    """
    order = F.col("Timestamp").desc_nulls_last(), F.col("Price_Hist_ID").desc()
    if day:
        newest = high_water_mark(prices, day)
        if newest is None:
            return price_against_reference(prices, pair, currency, **options).limit(0)
        recent = prices.filter(F.col(day) == F.lit(str(newest)).cast("date"))
        rows = top_rows(price_against_reference(recent, pair, currency, **options), count, *order)
        if rows.count() == count:
            return rows
    return top_rows(price_against_reference(prices, pair, currency, **options), count, *order)


def linked_prices(
    prices: DataFrame, pair: DataFrame, currency: DataFrame, quotes: Sequence[str] | None = None
) -> DataFrame:
    """All normalised tables joined, newest price first; ``quotes`` keeps only these quote assets."""
    assets = with_assets(pair, currency)
    if quotes is not None:
        assets = assets.filter(F.col("QUOTE_CURRENCY").isin(*quotes))
    reference = currency.select(F.col("Currency_ID").alias("Base_Currency_ID"), "Global_Price_USD")
    dimension = assets.join(reference, "Base_Currency_ID").select(
        "Pair_ID",
        F.col("BASE_CURRENCY").alias("Base_Asset"),
        F.col("BASE_ASSET_TYPE").alias("Base_Type"),
        F.col("QUOTE_CURRENCY").alias("Quote_Asset"),
        F.col("QUOTE_ASSET_TYPE").alias("Quote_Type"),
        F.col("Pair_Name").alias("Trading_Pair"),
        F.col("Manual_Category").alias("Market_Sector"),
        F.col("Global_Price_USD").alias("Global_Ref"),
    )
    rows = join_dimension(prices, dimension, "Pair_ID", bound=pair if quotes is None else None)
    newest = rows.orderBy(F.col("Timestamp").desc_nulls_last(), F.col("Price_Hist_ID").desc())
    return newest.select(
        "Base_Asset", "Base_Type", "Quote_Asset", "Quote_Type", "Trading_Pair", "Market_Sector",
        F.col("Price").alias("Market_Price"), "Global_Ref", F.col("Timestamp").alias("Retrieved_At"),
    )


def price_links(prices: DataFrame, pair: DataFrame, currency: DataFrame) -> DataFrame:
    """base_currency, quote_currency, pair_name, price, timestamp: do the keys link?"""
    dimension = with_assets(pair, currency).select("Pair_ID", "Pair_Name", "BASE_CURRENCY", "QUOTE_CURRENCY")
    return join_dimension(prices, dimension, "Pair_ID", bound=pair).select(
        F.col("BASE_CURRENCY").alias("base_currency"),
        F.col("QUOTE_CURRENCY").alias("quote_currency"),
        F.col("Pair_Name").alias("pair_name"),
        F.col("Price").alias("price"),
        F.col("Timestamp").alias("timestamp"),
    )


def quoted_in(tickers: DataFrame, quote: str = "USDT") -> DataFrame:
    """Tickers of one quote asset with their price as a number."""
    return tickers.filter(F.col("symbol").endswith(quote)).withColumn("price", to_price(F.col("price")))


def _by_price(tickers: DataFrame):
    """Highest price first; the remaining columns break ties."""
    return [F.col("price").desc_nulls_last(), *[c for c in tickers.columns if c != "price"]]


def highest_prices(tickers: DataFrame, count: int = 10, quote: str = "USDT") -> DataFrame:
    rows = quoted_in(tickers, quote)
    return top_rows(rows, count, *_by_price(rows))


def price_positions(tickers: DataFrame, quote: str | None = "USDT") -> DataFrame:
    """Tickers with their 0-based position by price, the highest first."""
    rows = tickers.withColumn("price", to_price(F.col("price"))) if quote is None else quoted_in(tickers, quote)
    return with_position(rows, *_by_price(rows))
