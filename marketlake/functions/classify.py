"""Asset type and category of a currency or pair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Assets by type, and the tag keywords of each category in reporting order.
STABLECOINS = ("USDT", "USDC", "BUSD")
MAJOR_COINS = ("BTC", "ETH", "BNB", "SOL")
CATEGORY_KEYWORDS = {
    "DeFi (Decentralized Finance)": ("defi", "decentralized-finance"),
    "Stablecoins": ("stablecoin", "asset-backed-stablecoin", "fiat-stablecoin"),
    "NFTs (Non-Fungible Tokens)": ("nft", "collectibles", "art"),
    "Gaming & Metaverse": ("gaming", "metaverse", "play-to-earn"),
    "Exchange Tokens": ("centralized-exchange", "exchange-based-tokens"),
    "Layer 1 & Layer 2": ("layer-1", "layer-2", "smart-contracts"),
    "Privacy Coins": ("privacy",),
    "AI & Big Data": ("ai-big-data", "big-data"),
}
NO_TAGS = "To be defined"
NO_MATCH = "Other / Not Mapped"


def asset_type(
    name: Column, stablecoins: Sequence[str] = STABLECOINS, major_coins: Sequence[str] = MAJOR_COINS
) -> Column:
    ticker = F.upper(name)
    return (
        F.when(ticker.isin(*stablecoins), "stablecoin").when(ticker.isin(*major_coins), "crypto").otherwise("token")
    )


def tag_categories(tags: Column, keywords: Mapping[str, Sequence[str]] = CATEGORY_KEYWORDS) -> Column:
    """Every category with a keyword among the tags, joined in the order of ``keywords``."""
    lowered = F.transform(tags, F.lower)
    matches = [
        F.when(F.arrays_overlap(lowered, F.array(*map(F.lit, words))), F.lit(category))
        for category, words in keywords.items()
    ]
    joined = F.array_join(F.array(*matches), ", ")  # skips the NULLs of categories that do not match
    return (
        F.when(F.coalesce(F.size(tags), F.lit(0)) <= 0, NO_TAGS).when(joined != "", joined).otherwise(NO_MATCH)
    )


def primary_category(categories: Column) -> Column:
    """The first entry of a comma-separated list of categories."""
    return F.btrim(F.substring_index(categories, ",", 1), F.lit(" \t\r\n"))


def category_or_default(category: Column) -> Column:
    return F.coalesce(category, F.lit(NO_TAGS))
