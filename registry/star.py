"""Star schema queries."""

from pyspark.sql import functions as F

from marketlake.functions.temporal import to_micros_text
from marketlake.operators.sinks import publish
from marketlake.plans import star
from marketlake.session import new_folder
from registry import bindings as b
from registry.book import query

_ENRICHED = """
SELECT h."Timestamp", c.Currency_Name, h.Price, p.Manual_Category, m.symbol, m.name
FROM {hist} h JOIN {pair} p ON h.Pair_ID = p.Pair_ID
JOIN {currency} c ON p.Base_Currency_ID = c.Currency_ID
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "rank" NULLS LAST, id) AS place
                          FROM {metadata}) WHERE place = 1) m ON upper(c.Currency_Name) = upper(m.symbol)"""

_FACT_PAIRS = """
SELECT h."Timestamp" AS TIME_ID, c.Currency_ID, h.Pair_ID, p.Pair_Name, h.Price
FROM {hist} h JOIN {pair} p ON h.Pair_ID = p.Pair_ID JOIN {currency} c ON p.Base_Currency_ID = c.Currency_ID"""

_SMALL = {"hist": "price_hist", "pair": "pair", "currency": "currency", "metadata": "metadata"}
_TRADE = {"hist": "trade_hist", "pair": "trade_pair", "currency": "trade_currency", "metadata": "trade_metadata"}

_PARTS = ", ".join(
    f"CAST({part}(TIME_ID) AS INT) AS {part.upper()}"
    for part in ("day", "month", "year", "quarter", "hour", "minute", "second")
)


@query(b.sql("currency pair price_hist metadata", _ENRICHED.format(**_SMALL)))
def star_enriched(spark, folder):
    return star.enriched_prices(
        b.price_hist(spark, folder), b.pair(spark, folder), b.currency(spark, folder), b.metadata(spark, folder)
    )


@query(b.sql("trade_currency trade_pair trade_hist trade_metadata", _ENRICHED.format(**_TRADE)))
def star_enriched_trades(spark, folder):
    return star.enriched_prices(
        b.trade_hist(spark, folder),
        b.trade_pair(spark, folder),
        b.trade_currency(spark, folder),
        b.trade_metadata(spark, folder),
    )


@query("""
SELECT p_partkey AS id, p_name AS symbol, p_brand AS name, p_size AS "rank"
FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size NULLS LAST, p_partkey) AS place FROM part)
WHERE place = 1""")
def metadata_dedup(spark, folder):
    return star.unique_metadata(b.asset_meta(spark, folder))


@query(b.sql("currency pair price_hist", _FACT_PAIRS.format(**_SMALL)))
def fact_pairs(spark, folder):
    return star.fact_pairs(b.price_hist(spark, folder), b.pair(spark, folder), b.currency(spark, folder))


@query(b.sql("trade_currency trade_pair trade_hist", _FACT_PAIRS.format(**_TRADE)))
def fact_pairs_trades(spark, folder):
    return star.fact_pairs(b.trade_hist(spark, folder), b.trade_pair(spark, folder), b.trade_currency(spark, folder))


@query(b.sql("trade_hist", f"""
SELECT TIME_ID, {_PARTS} FROM (SELECT DISTINCT "Timestamp" AS TIME_ID FROM trade_hist)"""))
def dim_time(spark, folder):
    return star.dim_time(b.trade_hist(spark, folder))


@query(b.sql("price_hist", f"""
SELECT TIME_ID, {_PARTS} FROM (SELECT DISTINCT "Timestamp" AS TIME_ID FROM price_hist)"""))
def dim_time_ticks(spark, folder):
    return star.dim_time(b.price_hist(spark, folder))


@query("""
SELECT l_shipdate AS "Timestamp", CAST(year(l_shipdate) AS INT) AS "Year", CAST(month(l_shipdate) AS INT) AS "Month",
       CAST(day(l_shipdate) AS INT) AS "Day", CAST((month(l_shipdate) - 1) // 3 + 1 AS INT) AS "Quarter"
FROM (SELECT DISTINCT l_shipdate FROM lineitem)""")
def export_dim_time(spark, folder):
    return star.export_dim_time(b.trade_hist(spark, folder))


@query(b.sql("trade_currency", "SELECT Currency_ID, Currency_Name, Asset_Type FROM trade_currency"))
def dim_currency(spark, folder):
    return star.dim_currency(b.trade_currency(spark, folder))


@query(b.sql("currency pair", """
SELECT p.Pair_ID AS PAIR_ID, p.Pair_Name AS PAIR_NAME, p.Manual_Category AS CATEGORY_NAME,
       x.Currency_Name AS BASE_CURRENCY, x.Asset_Type AS BASE_ASSET_TYPE,
       y.Currency_Name AS QUOTE_CURRENCY, y.Asset_Type AS QUOTE_ASSET_TYPE
FROM pair p JOIN currency x ON p.Base_Currency_ID = x.Currency_ID
JOIN currency y ON p.Quote_Currency_ID = y.Currency_ID"""))
def dim_pair(spark, folder):
    return star.dim_pair(b.pair(spark, folder), b.currency(spark, folder))


_SOURCES = """
SELECT 1 AS SOURCE_ID, 'Binance' AS SOURCE_NAME UNION ALL SELECT 2, 'CoinMarketCap' UNION ALL
SELECT CAST(2 + row_number() OVER (ORDER BY event_type) AS INT), event_type
FROM (SELECT DISTINCT event_type FROM events)"""


def published_sources(spark, prices, home):
    """The source dimension as a stored table, since every load looks it up."""
    view = "dim_source_" + home[-32:]
    publish({view: star.dim_source(star.seed_sources(spark), prices)}, home)
    return spark.table(view)


@query(_SOURCES)
def dim_source(spark, folder):
    return star.dim_source(star.seed_sources(spark), b.price_hist(spark, folder))


@query(b.sql("price_hist", f"""+
dim_source AS ({_SOURCES})
SELECT h."Timestamp" AS TIME_ID, h.Pair_ID AS PAIR_ID, s.SOURCE_ID, h.Price AS PRICE
FROM price_hist h JOIN dim_source s ON s.SOURCE_NAME = h.Source"""))
def fact_price(spark, folder):
    prices = b.price_hist(spark, folder)
    return star.fact_price(prices, published_sources(spark, prices, new_folder(spark, "sources")))


@query(b.sql("price_hist", """
SELECT strftime("Timestamp", '%Y-%m-%d %H:%M:%S.%f') AS TIME_ID, Pair_ID AS PAIR_ID, 1 AS SOURCE_ID, Price AS PRICE
FROM price_hist"""))
def fact_price_one_source(spark, folder):
    fact = star.fact_price(b.price_hist(spark, folder))
    return fact.withColumn("TIME_ID", to_micros_text(F.col("TIME_ID")))


_PERFORMANCE = b.sql("currency pair price_hist", """
SELECT p.Pair_Name AS PAIR_NAME, h.Price AS PRICE, p.Manual_Category AS CATEGORY_NAME,
       CAST(day(h."Timestamp") AS INT) AS "DAY", CAST(month(h."Timestamp") AS INT) AS "MONTH",
       CAST(year(h."Timestamp") AS INT) AS "YEAR", h."Timestamp" AS TIME_ID
FROM price_hist h JOIN pair p ON h.Pair_ID = p.Pair_ID
JOIN currency x ON p.Base_Currency_ID = x.Currency_ID JOIN currency y ON p.Quote_Currency_ID = y.Currency_ID""")


@query(_PERFORMANCE)
def category_performance(spark, folder):
    prices = b.price_hist(spark, folder)
    pairs = star.dim_pair(b.pair(spark, folder), b.currency(spark, folder))
    return star.category_performance(star.fact_price(prices), pairs, star.dim_time(prices))


@query(_PERFORMANCE)
def category_performance_checked_times(spark, folder):
    pairs = star.dim_pair(b.pair(spark, folder), b.currency(spark, folder))
    return star.category_performance(star.fact_price(b.price_hist(spark, folder)), pairs)
