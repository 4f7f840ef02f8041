"""Landed payloads made by Spark from the given tables, read back, flattened and normalised."""

from pyspark.sql import functions as F

from marketlake.functions.temporal import EPOCH, as_of, from_epoch_millis
from marketlake.functions.values import to_price, try_price
from marketlake.operators import sinks
from marketlake.operators.joins import missing_keys
from marketlake.plans import normalise
from marketlake.plans.star import unique_metadata
from marketlake.schemas import CORRUPT, PRICE_HIST, TICKER_EXTRACT
from marketlake.session import new_folder
from marketlake.sources import files, payloads
from registry import bindings as b
from registry.book import query
from registry.quality import WORDS, categories_sql


def quote_payloads(spark, folder):
    """One quotes payload per base asset, as the JSON text the API would have given."""
    assets = b.asset_meta(spark, folder).join(
        b.table(spark, folder, "part").select(F.col("p_partkey").alias("id"), "p_retailprice"), "id"
    )
    symbol = F.upper(F.replace(F.col("symbol"), F.lit(" "), F.lit("")))
    price = F.struct(F.col("p_retailprice").cast("decimal(30,12)").alias("price"))
    asset = F.struct(F.split("symbol", " ").alias("tags"), F.create_map(F.lit("USD"), price).alias("quote"))
    return unique_metadata(assets).select(F.to_json(F.struct(F.create_map(symbol, asset).alias("data"))).alias("value"))


def quotes(spark, folder):
    return payloads.parse_quotes(quote_payloads(spark, folder), "value")


@query(b.sql("quote", "SELECT symbol, array_to_string(tags, '|') AS tags, Global_Price_USD FROM quote"))
def quotes_flatten(spark, folder):
    landed = new_folder(spark, "quotes")
    quote_payloads(spark, folder).write.text(landed)
    flat = payloads.flatten_quotes(payloads.read_quotes(spark, landed))
    return flat.select("symbol", F.array_join("Raw_Tags", "|").alias("tags"), "Global_Price_USD")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS DECIMAL(20,8)) AS price FROM events""")
def nested_price(spark, folder):
    props = F.from_json("props", "map<string,decimal(20,8)>")
    return b.table(spark, folder, "events").select("event_id", F.try_element_at(props, F.lit("k")).alias("price"))


@query(b.sql("ticker", "SELECT symbol, CAST(price AS DECIMAL(20,8)) AS price FROM ticker"))
def ticker_files(spark, folder):
    landed = new_folder(spark, "tickers")
    b.ticker(spark, folder).select("symbol", "price").write.json(landed)
    good, _ = payloads.set_aside(payloads.read_tickers(spark, landed), "price")
    return good.select("symbol", to_price(F.col("price")).alias("price"))


@query("""
SELECT symbol, try_cast(price AS DECIMAL(20,8)) AS price
FROM (SELECT p_name AS symbol, CASE WHEN p_type = 'SMALL' THEN p_brand ELSE CAST(p_retailprice AS VARCHAR) END AS price FROM part)""")
def ticker_bad_prices(spark, folder):
    kind = F.col("p_type")
    text = F.when(kind == "SMALL", F.col("p_brand")).otherwise(F.col("p_retailprice").cast("string"))
    return b.table(spark, folder, "part").select(F.col("p_name").alias("symbol"), try_price(text).alias("price"))


@query("""SELECT p_partkey AS id, p_name AS symbol, p_brand AS name, p_size AS "rank" FROM part""")
def asset_map_files(spark, folder):
    landed = new_folder(spark, "assets")
    b.asset_meta(spark, folder).write.json(landed)
    return payloads.set_aside(payloads.read_asset_map(spark, landed), "symbol")[0]


def _broken_assets(spark, folder):
    """The asset map as landed, where the lines of one kind of parts break off."""
    landed = new_folder(spark, "assets")
    line = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("symbol"), F.col("p_brand").alias("name"), F.col("p_size").alias("rank")))
    text = F.when(F.col("p_type") == "SMALL", F.concat(F.lit('{"id":'), F.col("p_partkey").cast("string"), F.lit(',"symbol":"'), "p_name")).otherwise(line)
    b.table(spark, folder, "part").select(text.alias("value")).write.text(landed)
    return payloads.set_aside(payloads.read_asset_map(spark, landed), "symbol")


@query("""SELECT '{"id":' || p_partkey || ',"symbol":"' || p_name AS line FROM part WHERE p_type = 'SMALL'""")
def asset_map_rejects(spark, folder):
    return _broken_assets(spark, folder)[1].select(F.col(CORRUPT).alias("line"))


@query("""SELECT p_partkey AS id, p_name AS symbol, p_brand AS name, p_size AS "rank" FROM part WHERE p_type <> 'SMALL'""")
def asset_map_kept(spark, folder):
    return _broken_assets(spark, folder)[0]


def _millis(timestamp):
    """Epoch milliseconds of a zone-free time."""
    return F.timestamp_diff("MILLISECOND", F.lit(EPOCH).cast("timestamp_ntz"), timestamp)


@query("""
SELECT event_type AS symbol, date_trunc('millisecond', ts) AS open_time, CAST(value AS DECIMAL(20,8)) AS close,
       user_id AS num_trades
FROM events""")
def candle_files(spark, folder):
    # One payload per event: a list with one candle, its twelve fields in order, as text.
    millis = _millis(F.col("ts")).cast("string")
    zero = F.lit("0")
    price = F.col("value").cast("decimal(20,8)").cast("string")
    candle = F.array(millis, zero, zero, zero, price, zero, millis, zero, F.col("user_id").cast("string"), zero, zero, zero)
    landed = new_folder(spark, "candles")
    events = b.table(spark, folder, "events")
    made = events.select(F.col("event_type").alias("symbol"), F.to_json(F.array(candle)).alias("value"))
    made.write.partitionBy("symbol").text(landed)
    read = payloads.parse_candles(payloads.read_candles(spark, landed, whole_files=False))
    return read.select(
        "symbol",
        from_epoch_millis(F.col("timestamp").cast("bigint")).alias("open_time"),
        to_price(F.col("close")).alias("close"),
        F.col("num_trades").cast("bigint").alias("num_trades"),
    )


@query("""
SELECT event_type AS symbol, CASE user_id % 3 WHEN 0 THEN 'no list ' || event_id WHEN 1 THEN '{"event":' || event_id || '}'
       ELSE '[["' || event_id || '"]]' END AS payload
FROM events WHERE user_id % 5 = 0""")
def candle_rejects(spark, folder):
    # Payloads that are no JSON, no list, or a list of candles without a close; the others are whole.
    name = F.col("event_id").cast("string")
    broken = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("no list "), name)).when(
        F.col("user_id") % 3 == 1, F.concat(F.lit('{"event":'), name, F.lit("}"))
    ).otherwise(F.concat(F.lit('[["'), name, F.lit('"]]')))
    whole = F.to_json(F.array(F.array(*[name] * 12)))
    landed = new_folder(spark, "candles")
    made = b.table(spark, folder, "events").select(
        F.col("event_type").alias("symbol"), F.when(F.col("user_id") % 5 == 0, broken).otherwise(whole).alias("value")
    )
    made.write.partitionBy("symbol").text(landed)
    _, bad = payloads.set_aside_candles(payloads.read_candles(spark, landed, whole_files=False))
    return bad.select("symbol", F.col("value").alias("payload"))


@query(b.sql("price_hist", """SELECT Price_Hist_ID, Pair_ID, Price, "Timestamp", Source FROM price_hist"""))
def staging_roundtrip(spark, folder):
    staged = new_folder(spark, "staging")
    sinks.write_staging({"prices": b.price_hist(spark, folder)}, staged)
    return files.read_staging(spark, staged, "prices")


@query(b.sql("price_hist", """
SELECT Price_Hist_ID, CAST(Pair_ID AS INT) AS Pair_ID, Price, "Timestamp", Source FROM price_hist"""))
def csv_roundtrip(spark, folder):
    exported = new_folder(spark, "export")
    sinks.export_csv(b.price_hist(spark, folder), exported)
    return files.read_csv(spark, exported, PRICE_HIST)


@query(b.sql("ticker", """
SELECT symbol AS Symbol, CAST(price AS DECIMAL(20,8)) AS Price, TIMESTAMP '2026-02-04 15:51:49' AS Retrieval_Timestamp
FROM ticker"""))
def ticker_extract(spark, folder):
    stamped = b.ticker(spark, folder).select("symbol", "price", as_of("2026-02-04 15:51:49"))
    exported = new_folder(spark, "extract")
    named = stamped.toDF(*TICKER_EXTRACT.names).withColumn("Price", to_price(F.col("Price")))
    sinks.export_csv(named, exported)
    return files.read_csv(spark, exported, TICKER_EXTRACT)


# --- tickers and quotes to the normalised tables ---------------------------------------------
# When the prices were taken.
EARLIER = "2026-02-15 10:58:15"
MOMENT = "2026-02-16 10:58:15"

ASSETS = """+
split AS (SELECT id, symbol, price,
    CASE WHEN symbol LIKE '%USDT' THEN substr(symbol, 1, length(symbol) - 4)
         WHEN symbol LIKE '%BTC' THEN substr(symbol, 1, length(symbol) - 3) ELSE substr(symbol, 1, 3) END AS base,
    CASE WHEN symbol LIKE '%USDT' THEN 'USDT' WHEN symbol LIKE '%BTC' THEN 'BTC' ELSE substr(symbol, 4) END AS quote
    FROM ticker),
asset AS (SELECT CAST(row_number() OVER (ORDER BY name) AS INT) AS Currency_ID, name AS Currency_Name,
    CASE WHEN name IN ('USDT', 'USDC', 'BUSD') THEN 'stablecoin'
         WHEN name IN ('BTC', 'ETH', 'BNB', 'SOL') THEN 'crypto' ELSE 'token' END AS Asset_Type,
    q.Global_Price_USD, coalesce(q.tags, []) AS tags
    FROM (SELECT base AS name FROM split UNION SELECT quote FROM split) LEFT JOIN quote q ON q.symbol = name),
market AS (SELECT CAST(row_number() OVER (ORDER BY s.symbol) AS INT) AS Pair_ID, s.symbol AS Pair_Name,
    x.Currency_ID AS Base_Currency_ID, y.Currency_ID AS Quote_Currency_ID,
    CASE WHEN len(x.tags) = 0 THEN 'To be defined' ELSE """ + categories_sql("x.tags") + """ END AS Manual_Category
    FROM (SELECT DISTINCT symbol, base, quote FROM split) s
    JOIN asset x ON x.Currency_Name = s.base JOIN asset y ON y.Currency_Name = s.quote)
"""


def _currency(spark, folder):
    rows = normalise.currency_rows(b.ticker(spark, folder), quotes(spark, folder))
    none_yet = rows.limit(0).select(F.lit(None).cast("int").alias("Currency_ID"), *rows.columns)
    return normalise.merge_currencies(none_yet, rows)


def _pair(spark, folder):
    rows = normalise.pair_rows(b.ticker(spark, folder), _currency(spark, folder), WORDS)
    none_yet = rows.limit(0).select(F.lit(None).cast("int").alias("Pair_ID"), *rows.columns)
    return normalise.merge_pairs(none_yet, rows)


@query(b.sql("ticker quote", ASSETS + """
SELECT Currency_ID, Currency_Name, Asset_Type, Global_Price_USD, array_to_string(tags, '|') AS tags FROM asset"""))
def normalised_currency(spark, folder):
    return _currency(spark, folder).withColumn("Raw_Tags", F.array_join("Raw_Tags", "|")).withColumnRenamed("Raw_Tags", "tags")


@query(b.sql("ticker quote", ASSETS + "SELECT * FROM market"))
def normalised_pair(spark, folder):
    return _pair(spark, folder)


@query(b.sql("ticker quote", ASSETS + """
SELECT m.Pair_ID, CAST(t.price AS DECIMAL(20,8)) AS Price, TIMESTAMP '2026-02-16 10:58:15' AS "Timestamp",
       'Binance' AS Source
FROM ticker t JOIN market m ON m.Pair_Name = t.symbol"""))
def normalised_price(spark, folder):
    return normalise.price_rows(b.ticker(spark, folder), _pair(spark, folder), MOMENT)


@query(b.sql("ticker quote", ASSETS + """
SELECT m.Pair_ID, TIMESTAMP '2026-02-16 10:58:15' AS "Timestamp", o.Price, o.Source
FROM market m JOIN (
    SELECT symbol, CAST(price AS DECIMAL(20,8)) AS Price, 'Binance' AS Source FROM split
    UNION ALL
    SELECT p.symbol, q.Global_Price_USD, 'CoinMarketCap'
    FROM (SELECT DISTINCT symbol, base FROM split) p JOIN quote q ON q.symbol = p.base) o ON o.symbol = m.Pair_Name
WHERE o.Price <> 0"""))
def delta_prices(spark, folder):
    pair = _pair(spark, folder)
    return normalise.delta_prices(
        b.ticker(spark, folder), quotes(spark, folder), pair, MOMENT, markets=None
    )


_LISTED = ("REDPLATEUSDT", "SMALLWIDGETBTC", "HOTPLATEUSDT", "HOTRINGBTC", "LARGERODEUR")
_DELTA = """
SELECT m.Pair_ID, TIMESTAMP '2026-02-16 10:58:15' AS "Timestamp", o.Price, o.Source
FROM market m JOIN (
    SELECT symbol, CAST(price AS DECIMAL(20,8)) AS Price, 'Binance' AS Source FROM split WHERE {landed}
    UNION ALL
    SELECT p.symbol, q.Global_Price_USD, 'CoinMarketCap'
    FROM (SELECT DISTINCT symbol, base FROM split) p JOIN quote q ON q.symbol = p.base) o ON o.symbol = m.Pair_Name
WHERE o.Price <> 0 AND {listed}"""


@query(b.sql("ticker quote", ASSETS + _DELTA.format(landed="true", listed=f"m.Pair_Name IN {_LISTED}")))
def delta_prices_listed_markets(spark, folder):
    return normalise.delta_prices(b.ticker(spark, folder), quotes(spark, folder), _pair(spark, folder), MOMENT, _LISTED)


@query(b.sql("ticker quote", ASSETS + _DELTA.format(landed="symbol LIKE '%BTC'", listed="true")))
def delta_prices_missing_tickers(spark, folder):
    # Markets quoted in other assets have no ticker in this run: they get the reference price only.
    landed = b.ticker(spark, folder).filter(F.endswith("symbol", F.lit("BTC")))
    return normalise.delta_prices(landed, quotes(spark, folder), _pair(spark, folder), MOMENT, markets=None)


@query(b.sql("ticker", "SELECT DISTINCT symbol FROM ticker WHERE symbol NOT LIKE '%USDT'"))
def unknown_symbols(spark, folder):
    tickers = b.ticker(spark, folder)
    # The master data knows the dollar markets only.
    known = normalise.split_symbols(tickers.filter(F.endswith("symbol", F.lit("USDT")))).select("symbol").distinct()
    return missing_keys(tickers, known, "symbol")


@query(b.sql("price_hist", """
SELECT e.user_id AS Pair_ID, date_trunc('millisecond', e.ts) AS "Timestamp", CAST(e.value AS DECIMAL(20,8)) AS Price
FROM events e JOIN customer c ON c.c_custkey = e.user_id"""))
def candle_history(spark, folder):
    events = b.table(spark, folder, "events")
    names = b.pair(spark, folder).select(F.col("Pair_ID").alias("user_id"), F.col("Pair_Name").alias("symbol"))
    millis = _millis(F.col("ts")).cast("string")
    candles = events.join(names, "user_id").select(
        "symbol", millis.alias("timestamp"), F.col("value").cast("string").alias("close")
    )
    return normalise.history_rows(candles, b.pair(spark, folder))


_OFFERS = """
SELECT p_partkey AS Pair_ID, Price, Source
FROM (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(20,8)) AS Price, 'A' AS Source FROM part
      UNION ALL
      SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(p_size - 1 AS DECIMAL(20,8)) END, 'B' FROM part)
WHERE """


def _offers(spark, folder):
    second = F.when(F.col("p_type") != "SMALL", F.col("p_size") - 1)
    part = b.table(spark, folder, "part")
    return part.select(F.col("p_partkey").alias("Pair_ID"), F.col("p_retailprice").alias("a"), second.alias("b"))


@query(_OFFERS + "Price IS NOT NULL AND Price <> 0")
def dual_source(spark, folder):
    return normalise.one_row_per_source(_offers(spark, folder), {"A": "a", "B": "b"})


@query(_OFFERS + "Price IS NULL OR Price = 0")
def dual_source_left_out(spark, folder):
    return normalise.one_row_per_source(_offers(spark, folder), {"A": "a", "B": "b"}, left_out=True)
