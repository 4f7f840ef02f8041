from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketlake.functions.classify import (
    CATEGORY_KEYWORDS,
    asset_type,
    category_or_default,
    primary_category,
    tag_categories,
)
from marketlake.functions.symbols import MARKETS, base_of, ends_with_any, is_market, quote_of
from marketlake.functions.temporal import as_of, calendar_parts, from_epoch_millis, from_offset_text, to_micros_text
from marketlake.functions.values import is_priced, to_price, try_price

PROPERTY = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def apply(spark, values, expression, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize("symbol, base, quote, base_everywhere", [
    ("BTCUSDT", "BTC", "USDT", "BTC"),
    ("USDCUSDT", "USDC", "USDT", "USDC"),
    ("ETHBTC", "ETH", "BTC", "ETH"),
    ("ADAEUR", "ADA", "EUR", "ADA"),
    ("WBTCBTC", "WBTC", "BTC", "W"),
])
def test_symbol_split(spark, symbol, base, quote, base_everywhere):
    x = F.col("x")
    row = column(spark, [symbol]).select(base_of(x), quote_of(x), base_of(x, every_occurrence=True)).first()
    assert tuple(row) == (base, quote, base_everywhere)


@PROPERTY
@given(st.lists(st.text("ABUSDTC", min_size=4, max_size=10), min_size=1, max_size=40))
def test_split_gives_back_the_symbol(spark, symbols):
    x = F.col("x")
    for symbol, base, quote in column(spark, symbols).select(x, base_of(x), quote_of(x)).collect():
        assert base + quote == symbol
        if symbol.endswith(("USDT", "BTC")):
            assert symbol.removesuffix(quote) == base


def test_asset_type(spark):
    assert apply(spark, ["usdt", "BUSD", "Sol", "ADA"], asset_type) == ["stablecoin", "stablecoin", "crypto", "token"]


@pytest.mark.parametrize("tags, expected", [
    (None, "To be defined"),
    ([], "To be defined"),
    (["pow"], "Other / Not Mapped"),
    (["DEFI"], "DeFi (Decentralized Finance)"),
    (["layer-1", "defi"], "DeFi (Decentralized Finance), Layer 1 & Layer 2"),
    (["defi-index"], "Other / Not Mapped"),
    (["defi", None], "DeFi (Decentralized Finance)"),
    (["art", "NFT", "privacy"], "NFTs (Non-Fungible Tokens), Privacy Coins"),
])
def test_tag_categories(spark, tags, expected):
    assert apply(spark, [tags], tag_categories, "array<string>") == [expected]


WORDS = sorted({w for words in CATEGORY_KEYWORDS.values() for w in words} | {"pow", "mineable"})


@PROPERTY
@given(st.lists(st.lists(st.sampled_from(WORDS + [w.upper() for w in WORDS]), max_size=5), min_size=1, max_size=30))
def test_categories_are_those_that_share_a_word(spark, tag_lists):
    for tags, found in zip(tag_lists, apply(spark, tag_lists, tag_categories, "array<string>")):
        sharing = [c for c, words in CATEGORY_KEYWORDS.items() if {t.lower() for t in tags}.intersection(words)]
        if sharing:
            assert found.split(", ") == sharing
        else:
            assert found == ("Other / Not Mapped" if tags else "To be defined")


def test_primary_category_and_default(spark):
    assert apply(spark, ["DeFi (Decentralized Finance), Layer 1 & Layer 2", " a ,b", "c"], primary_category) == [
        "DeFi (Decentralized Finance)", "a", "c"]
    assert apply(spark, [None, "x"], category_or_default) == ["To be defined", "x"]


def test_suffixes_and_markets(spark):
    assert apply(spark, ["BTCUSD", "BTCUSDT", "ETHBTC"], lambda x: ends_with_any(x, ("USD", "USDT"))) == [True, True, False]
    assert len(MARKETS) == 8
    assert apply(spark, ["btcusdt", "XRPUSDT"], is_market) == [True, False]


def test_prices(spark):
    assert apply(spark, ["75152.82000000", "0.123456785"], to_price) == [Decimal("75152.82000000"), Decimal("0.12345679")]
    assert apply(spark, ["n/a", "1"], try_price) == [None, Decimal("1.00000000")]
    with pytest.raises(PySparkException):
        apply(spark, ["n/a"], to_price)
    assert apply(spark, [Decimal("1.5"), Decimal(0), None], is_priced, "decimal(20,8)") == [True, False, False]


def test_times(spark):
    assert apply(spark, [1704067200123], from_epoch_millis, "bigint") == [datetime(2024, 1, 1, 0, 0, 0, 123000)]
    texts = ["2026-02-16T10:58:17.000+01:00", "2026-02-16T10:58:17Z", "2026-02-16 10:58:17"]
    assert set(apply(spark, texts, from_offset_text)) == {datetime(2026, 2, 16, 10, 58, 17)}
    moment = datetime(2026, 2, 16, 10, 58, 17, 1205)
    assert apply(spark, [moment], to_micros_text, "timestamp_ntz") == ["2026-02-16 10:58:17.001205"]
    assert spark.range(1).select(as_of("2026-02-16 10:58:17"), as_of(moment)).first()[:] == (
        datetime(2026, 2, 16, 10, 58, 17), moment)
    assert spark.range(1).select(as_of()).schema[0].dataType.simpleString() == "timestamp_ntz"


def test_epoch_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert apply(spark, [0], from_epoch_millis, "bigint") == [datetime(1970, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quarter_of_every_month(spark):
    months = [datetime(2024, m, 5, 6, 7, 8) for m in range(1, 13)]
    parts = calendar_parts(F.col("x"), {"q": "quarter", "m": "month", "h": "hour", "i": "minute", "s": "second", "d": "day"})
    for q, m, h, i, s, d in column(spark, months, "timestamp_ntz").select(*parts).collect():
        assert (q, h, i, s, d) == (-(-m // 3), 6, 7, 8, 5)
