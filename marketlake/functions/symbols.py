"""Splitting a ticker symbol into its base and quote asset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote suffixes in the order they are tried, the length of the base when no
# suffix fits, and the markets that are loaded.
QUOTE_SUFFIXES = ("USDT", "BTC")
FALLBACK_BASE_LENGTH = 3
MARKETS = ("BTCUSDT", "ETHUSDT", "ETHBTC", "BNBUSDT", "SOLUSDT", "ADAUSDT", "DOTUSDT", "USDCUSDT")


def base_of(symbol: Column, every_occurrence: bool = False, suffixes: Sequence[str] = QUOTE_SUFFIXES) -> Column:
    """The base asset: the symbol without its quote suffix.

    ``every_occurrence`` removes the suffix text wherever it stands, so that the base of WBTCBTC
    is W; by default only the ending goes, giving WBTC.
    """
    base = F.substring(symbol, 1, FALLBACK_BASE_LENGTH)
    for suffix in reversed(suffixes):
        if every_occurrence:
            cut = F.replace(symbol, F.lit(suffix), F.lit(""))
        else:
            cut = F.substring(symbol, F.lit(1), F.length(symbol) - F.lit(len(suffix)))
        base = F.when(symbol.endswith(suffix), cut).otherwise(base)
    return base


def quote_of(symbol: Column, suffixes: Sequence[str] = QUOTE_SUFFIXES) -> Column:
    """The quote asset: the suffix that fits, or what follows the fallback base."""
    quote = F.substring(symbol, F.lit(FALLBACK_BASE_LENGTH + 1), F.length(symbol))
    for suffix in reversed(suffixes):
        quote = F.when(symbol.endswith(suffix), F.lit(suffix)).otherwise(quote)
    return quote


def ends_with_any(text: Column, suffixes: Sequence[str]) -> Column:
    test = F.lit(False)
    for suffix in suffixes:
        test = test | text.endswith(suffix)
    return test


def is_market(symbol: Column, markets: Sequence[str] = MARKETS) -> Column:
    return F.upper(symbol).isin(*markets)
