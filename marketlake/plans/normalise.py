"""Landed tickers and quotes to the normalised currency, pair and price tables.

There is no loop over symbols: each table is one DataFrame over all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.classify import CATEGORY_KEYWORDS, asset_type, tag_categories
from marketlake.functions.symbols import MARKETS, base_of, is_market, quote_of
from marketlake.functions.temporal import as_of, from_epoch_millis
from marketlake.functions.values import is_priced, to_price
from marketlake.operators.joins import join_dimension
from marketlake.operators.ranking import first_per_key
from marketlake.operators.upsert import upsert_with_ids

CURRENCY_UPDATES = ("Global_Price_USD", "Raw_Tags")
PAIR_UPDATES = ("Manual_Category",)

# The two price sources in the order of their ids.
EXCHANGE = "Binance"
REFERENCE = "CoinMarketCap"


def one_quote(quotes: DataFrame) -> DataFrame:
    """One quote per symbol: the one landed last (where ``landed`` says when), then one with a price, the higher
    price, and the tags as text, so that the choice is the same on every run."""
    order = [F.col("Global_Price_USD").desc_nulls_last(), F.to_json("Raw_Tags")]
    if "landed" in quotes.columns:
        order.insert(0, F.col("landed").desc_nulls_last())
    return first_per_key(quotes, "symbol", *order).select("symbol", "Raw_Tags", "Global_Price_USD")


def only_markets(tickers: DataFrame, markets: Sequence[str] = MARKETS) -> DataFrame:
    return tickers.filter(is_market(F.col("symbol"), markets))


def split_symbols(tickers: DataFrame, every_occurrence: bool = False) -> DataFrame:
    """Add the base and quote asset of each ticker's symbol."""
    symbol = F.col("symbol")
    return tickers.withColumns({"base": base_of(symbol, every_occurrence), "quote": quote_of(symbol)})


def currency_rows(tickers: DataFrame, quotes: DataFrame) -> DataFrame:
    """Currency_Name, Asset_Type, Global_Price_USD, Raw_Tags of every base and quote asset.

    Names are made distinct before the quotes are joined: a quote asset stands in most symbols. Of
    several quotes for a symbol the newest counts, so there is one row per name.
    """
    assets = split_symbols(tickers).select(F.explode(F.array("base", "quote")).alias("Currency_Name")).distinct()
    quoted = one_quote(quotes).withColumnRenamed("symbol", "Currency_Name")
    return assets.join(quoted, "Currency_Name", "left").select(
        "Currency_Name",
        asset_type(F.col("Currency_Name")).alias("Asset_Type"),
        "Global_Price_USD",
        F.coalesce("Raw_Tags", F.array().cast("array<string>")).alias("Raw_Tags"),
    )


def merge_currencies(existing: DataFrame, incoming: DataFrame, keep_existing_on_null: bool = False) -> DataFrame:
    """Currency after the load: known names take the new price and tags and keep their type.

    With ``keep_existing_on_null`` an asset without a quote in this load keeps price and tags.
    """
    tags = F.col("Raw_Tags")
    if keep_existing_on_null:
        incoming = incoming.withColumn("Raw_Tags", F.when(F.size(tags) > 0, tags))
    merged = upsert_with_ids(existing, incoming, "Currency_Name", CURRENCY_UPDATES, "Currency_ID", keep_existing_on_null)
    return merged.withColumn("Raw_Tags", F.coalesce(tags, F.array().cast("array<string>")))


def pair_rows(
    tickers: DataFrame, currency: DataFrame, keywords: Mapping[str, Sequence[str]] = CATEGORY_KEYWORDS
) -> DataFrame:
    """Pair_Name, the ids of both assets, and the category that the base asset's tags give."""
    symbols = split_symbols(tickers.select("symbol").distinct())
    base = currency.select(
        F.col("Currency_Name").alias("base"),
        F.col("Currency_ID").alias("Base_Currency_ID"),
        tag_categories(F.col("Raw_Tags"), keywords).alias("Manual_Category"),
    )
    quote = currency.select(F.col("Currency_Name").alias("quote"), F.col("Currency_ID").alias("Quote_Currency_ID"))
    return join_dimension(symbols.join(base, "base"), quote, "quote").select(
        F.col("symbol").alias("Pair_Name"), "Base_Currency_ID", "Quote_Currency_ID", "Manual_Category"
    )


def merge_pairs(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Pair after the load: known names take only the new category."""
    return upsert_with_ids(existing, incoming, "Pair_Name", PAIR_UPDATES, "Pair_ID")


def price_rows(tickers: DataFrame, pair: DataFrame, moment=None, source: str = EXCHANGE) -> DataFrame:
    """Pair_ID, Price, Timestamp, Source: every ticker of a known pair, stamped with the load time."""
    names = pair.select(F.col("Pair_Name").alias("symbol"), "Pair_ID")
    return join_dimension(tickers, names, "symbol").select(
        "Pair_ID",
        to_price(F.col("price")).alias("Price"),
        as_of(moment).alias("Timestamp"),
        F.lit(source).alias("Source"),
    )


def history_rows(candles: DataFrame, pair: DataFrame, stamp: str = "timestamp") -> DataFrame:
    """Pair_ID, Price, Timestamp of every candle of a known pair.

    The price is the close. It is stamped with the time the candle opened, or with
    ``stamp="close_time"`` the time it closed.
    """
    names = pair.select(F.col("Pair_Name").alias("symbol"), "Pair_ID")
    return join_dimension(candles, names, "symbol").select(
        "Pair_ID",
        to_price(F.col("close")).alias("Price"),
        from_epoch_millis(F.col(stamp).cast("bigint")).alias("Timestamp"),
    )


def one_row_per_source(rows: DataFrame, prices: Mapping[str, str], left_out: bool = False) -> DataFrame:
    """Turn price columns into rows (Price, Source); absent and zero prices are left out.

    ``prices`` maps each source to the column with its price. With ``left_out`` only the rows that
    are otherwise left out are given, for a report.
    """
    others = [c for c in rows.columns if c not in prices.values()]
    offers = F.array(*[
        F.struct(to_price(F.col(column)).alias("Price"), F.lit(source).alias("Source"))
        for source, column in prices.items()
    ])
    priced = is_priced(F.col("Price"))
    return rows.select(*others, F.inline(offers)).filter(~priced if left_out else priced)


def delta_prices(
    tickers: DataFrame, quotes: DataFrame, pair: DataFrame, moment=None, markets: Sequence[str] | None = MARKETS
) -> DataFrame:
    """Current price of each known market from both sources, one row per source that has one.

    The quote of a market is that of its base asset.
    """
    wanted = pair.select("Pair_ID", F.col("Pair_Name").alias("symbol"))
    if markets is not None:
        wanted = only_markets(wanted, markets)
    exchange = join_dimension(tickers, wanted, "symbol").select(
        "Pair_ID", to_price(F.col("price")).alias("Price"), F.lit(EXCHANGE).alias("Source")
    )
    of_base = wanted.select("Pair_ID", base_of(F.col("symbol")).alias("symbol"))
    reference = of_base.join(one_quote(quotes), "symbol").select(
        "Pair_ID", to_price(F.col("Global_Price_USD")).alias("Price"), F.lit(REFERENCE).alias("Source")
    )
    both = exchange.unionByName(reference).filter(is_priced(F.col("Price")))
    return both.withColumn("Timestamp", as_of(moment))
