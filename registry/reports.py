"""Report queries."""

from pyspark.sql import functions as F

from marketlake.plans import reports
from registry import bindings as b
from registry.book import query

QUOTES = ("NATION_1", "NATION_2")

_LINKED = """
SELECT x.Currency_Name AS Base_Asset, x.Asset_Type AS Base_Type, y.Currency_Name AS Quote_Asset,
       y.Asset_Type AS Quote_Type, p.Pair_Name AS Trading_Pair, p.Manual_Category AS Market_Sector,
       h.Price AS Market_Price, x.Global_Price_USD AS Global_Ref, h."Timestamp" AS Retrieved_At
FROM price_hist h JOIN pair p ON h.Pair_ID = p.Pair_ID
JOIN currency x ON p.Base_Currency_ID = x.Currency_ID JOIN currency y ON p.Quote_Currency_ID = y.Currency_ID
{where} ORDER BY h."Timestamp" DESC, h.Price_Hist_ID DESC"""


def _market(spark, folder):
    return b.price_hist(spark, folder), b.pair(spark, folder), b.currency(spark, folder)


@query(b.sql("pair", "SELECT Pair_Name, Manual_Category FROM pair ORDER BY Manual_Category DESC, Pair_Name"))
def pairs_by_category(spark, folder):
    return reports.pairs_by_category(b.pair(spark, folder))


@query(b.sql("trade_pair", """
SELECT Manual_Category, count(*) AS Number_of_Pairs FROM trade_pair GROUP BY Manual_Category"""))
def category_counts(spark, folder):
    return reports.category_counts(b.trade_pair(spark, folder))


@query(b.sql("currency", """
SELECT Currency_Name, Asset_Type, Global_Price_USD, to_json(tags)::VARCHAR AS Raw_Tags
FROM currency LEFT JOIN (SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment)) AS tags
                         FROM customer GROUP BY c_nationkey) ON c_nationkey = Currency_ID"""))
def currency_audit(spark, folder):
    # Tags are distinct segments: a set whose size does not depend on the number of customers.
    tags = b.table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("Currency_ID")).agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("Raw_Tags")
    )
    return reports.currency_audit(b.currency(spark, folder).join(tags, "Currency_ID", "left"))


@query(b.sql("currency pair price_hist", f"""
SELECT p.Pair_Name, p.Manual_Category AS Mapped_Category, h.Price AS Exchange_Price, x.Global_Price_USD AS Global_Avg,
       h.Price - x.Global_Price_USD AS Price_Difference, h."Timestamp", h.Price_Hist_ID,
       y.Currency_Name IN {QUOTES} AS comparable
FROM price_hist h JOIN pair p ON h.Pair_ID = p.Pair_ID
JOIN currency x ON p.Base_Currency_ID = x.Currency_ID LEFT JOIN currency y ON p.Quote_Currency_ID = y.Currency_ID
ORDER BY h."Timestamp" DESC, h.Price_Hist_ID DESC LIMIT 10"""))
def price_vs_reference(spark, folder):
    return reports.latest_against_reference(*_market(spark, folder), dollar_quotes=QUOTES)


@query(b.sql("currency pair price_hist", _LINKED.format(where=f"WHERE y.Currency_Name IN {QUOTES}")))
def dollar_quotes(spark, folder):
    return reports.linked_prices(*_market(spark, folder), quotes=QUOTES)


@query(b.sql("currency pair price_hist", _LINKED.format(where="")))
def linked_prices(spark, folder):
    return reports.linked_prices(*_market(spark, folder))


@query(b.sql("currency pair price_hist", """
SELECT x.Currency_Name AS base_currency, y.Currency_Name AS quote_currency, p.Pair_Name AS pair_name,
       h.Price AS price, h."Timestamp" AS "timestamp"
FROM price_hist h JOIN pair p ON h.Pair_ID = p.Pair_ID
JOIN currency x ON p.Base_Currency_ID = x.Currency_ID JOIN currency y ON p.Quote_Currency_ID = y.Currency_ID"""))
def price_links(spark, folder):
    return reports.price_links(*_market(spark, folder))


@query(b.sql("ticker", """
SELECT id, symbol, CAST(price AS DECIMAL(20,8)) AS price FROM ticker WHERE symbol LIKE '%USDT'
ORDER BY CAST(price AS DECIMAL(20,8)) DESC NULLS LAST, id LIMIT 10"""))
def highest_prices(spark, folder):
    return reports.highest_prices(b.ticker(spark, folder))


@query(b.sql("ticker", """
SELECT id, symbol, CAST(price AS DECIMAL(20,8)) AS price,
       row_number() OVER (ORDER BY CAST(price AS DECIMAL(20,8)) DESC NULLS LAST, id) - 1 AS "position"
FROM ticker WHERE symbol LIKE '%USDT'"""))
def price_positions(spark, folder):
    return reports.price_positions(b.ticker(spark, folder))


@query("""
SELECT o_orderkey AS id, o_orderpriority AS symbol, CAST(o_totalprice AS DECIMAL(20,8)) AS price,
       row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(20,8)) DESC NULLS LAST, o_orderkey) - 1 AS "position"
FROM orders""")
def price_positions_trades(spark, folder):
    orders = b.table(spark, folder, "orders")
    tickers = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("symbol"), F.col("o_totalprice").alias("price")
    )
    return reports.price_positions(tickers, quote=None)
