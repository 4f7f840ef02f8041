"""Incremental loads, upserts and the scheduled stream."""

from pyspark.sql import functions as F

from marketlake.operators import incremental, upsert
from marketlake.operators.sinks import DAY, current
from marketlake.plans import loads, star
from marketlake.schemas import DIM_CATEGORY, DIM_CURRENCY, DIM_PAIR, PRICE
from marketlake.session import new_folder
from marketlake.sources import payloads
from marketlake.sources.literals import literal_rows
from marketlake.streaming.price_stream import load_new_files
from registry import bindings as b
from registry.book import SQL, query
from registry.payloads import ASSETS, EARLIER, MOMENT, quote_payloads, quotes
from registry.quality import WORDS
from registry.star import _PARTS, _SOURCES, published_sources

# What had been loaded before: prices up to a day, trades up to a day.
LOADED = "2024-01-20"
TRADES_LOADED = "2000-01-01"
KEY = ["Timestamp", "Pair_ID", "Source"]

_HIST = """SELECT Price_Hist_ID, Pair_ID, Price, "Timestamp", Source FROM price_hist"""
_STORED = """SELECT CAST(Pair_ID AS INT) AS Pair_ID, Price, "Timestamp", Source FROM price_hist"""


def _until(rows, day):
    return rows.filter(F.col("Timestamp") <= F.lit(day).cast("timestamp_ntz"))


@query(b.sql("price_hist", f"""{_HIST}
WHERE "Timestamp" > (SELECT max("Timestamp") FROM price_hist WHERE "Timestamp" <= TIMESTAMP '{LOADED}')"""))
def delta_watermark(spark, folder):
    prices = b.price_hist(spark, folder)
    mark = incremental.high_water_mark(_until(prices, LOADED), "Timestamp")
    return incremental.newer_than_mark(prices, mark, "Timestamp")


@query(b.sql("price_hist", f"""{_HIST} h WHERE NOT EXISTS (
SELECT 1 FROM price_hist t WHERE t."Timestamp" <= TIMESTAMP '{LOADED}' AND t."Timestamp" = h."Timestamp"
AND t.Pair_ID = h.Pair_ID AND t.Source = h.Source)"""))
def delta_by_key(spark, folder):
    prices = b.price_hist(spark, folder)
    return incremental.not_loaded(prices, _until(prices, LOADED), KEY, "Timestamp")


@query(b.sql("trade_hist", f"""
SELECT Pair_ID, Price, "Timestamp", Source FROM trade_hist h
WHERE "Timestamp" <= TIMESTAMP '{TRADES_LOADED}' AND NOT EXISTS (
    SELECT 1 FROM trade_hist t WHERE t.Source = 'A' AND t."Timestamp" <= TIMESTAMP '{TRADES_LOADED}'
    AND t."Timestamp" = h."Timestamp" AND t.Pair_ID = h.Pair_ID)"""))
def delta_late_rows(spark, folder):
    # Loaded so far: one source up to the mark. The other sources' rows at or before it are late.
    trades = b.trade_hist(spark, folder)
    loaded = _until(trades, TRADES_LOADED).filter("Source = 'A'")
    mark = incremental.high_water_mark(_until(trades, TRADES_LOADED), "Timestamp")
    return incremental.at_or_before_mark(trades, loaded, ["Timestamp", "Pair_ID"], mark, "Timestamp")


# --- upserts: customers with orders before a day are known, those with orders since come in ---
_EARLY = """
known AS (SELECT c_custkey AS Currency_ID, c_name AS Currency_Name, c_mktsegment AS Asset_Type, price AS Global_Price_USD
          FROM customer JOIN (SELECT o_custkey, max(CAST(o_totalprice AS DECIMAL(20,8))) AS price FROM orders
                              WHERE o_orderdate < TIMESTAMP '1998-04-15' GROUP BY o_custkey) ON o_custkey = c_custkey)"""
_LATE = """
fresh AS (SELECT c_name AS Currency_Name, 'token' AS Asset_Type, price AS Global_Price_USD
          FROM customer JOIN (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(20,8)) END) AS price
                              FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-15' GROUP BY o_custkey) ON o_custkey = c_custkey)"""


def _orders(spark, folder, when):
    return b.table(spark, folder, "orders").filter(when).withColumn("price", F.col("o_totalprice").cast(PRICE))


def _known(spark, folder):
    best = _orders(spark, folder, "o_orderdate < timestamp_ntz'1998-04-15'").groupBy("o_custkey").agg(F.max("price").alias("price"))
    customer = b.table(spark, folder, "customer")
    return customer.join(best, customer["c_custkey"] == best["o_custkey"]).select(
        F.col("c_custkey").alias("Currency_ID"),
        F.col("c_name").alias("Currency_Name"),
        F.col("c_mktsegment").alias("Asset_Type"),
        F.col("price").alias("Global_Price_USD"),
    )


def _fresh(spark, folder):
    late = _orders(spark, folder, "o_orderdate >= timestamp_ntz'1998-04-15'")
    finished = F.max(F.when(F.col("o_orderstatus") == "F", F.col("price")))
    best = late.groupBy("o_custkey").agg(finished.alias("price"))
    customer = b.table(spark, folder, "customer")
    return customer.join(best, customer["c_custkey"] == best["o_custkey"]).select(
        F.col("c_name").alias("Currency_Name"), F.lit("token").alias("Asset_Type"), F.col("price").alias("Global_Price_USD")
    )


_MERGED = """
SELECT {id} AS Currency_ID, coalesce(k.Currency_Name, f.Currency_Name) AS Currency_Name,
       coalesce(k.Asset_Type, f.Asset_Type) AS Asset_Type, {price} AS Global_Price_USD
FROM known k FULL JOIN fresh f ON k.Currency_Name = f.Currency_Name"""
_REPLACED = "CASE WHEN f.Currency_Name IS NOT NULL THEN f.Global_Price_USD ELSE k.Global_Price_USD END"


@query(f"WITH {_EARLY}, {_LATE} " + _MERGED.format(id="k.Currency_ID", price=_REPLACED))
def upsert_currency(spark, folder):
    return upsert.upsert(_known(spark, folder), _fresh(spark, folder), "Currency_Name", ["Global_Price_USD"])


@query(f"WITH {_EARLY}, {_LATE} " + _MERGED.format(id="k.Currency_ID", price="coalesce(f.Global_Price_USD, k.Global_Price_USD)"))
def upsert_currency_keep_known(spark, folder):
    return upsert.upsert(
        _known(spark, folder), _fresh(spark, folder), "Currency_Name", ["Global_Price_USD"], keep_existing_on_null=True
    )


@query(f"WITH {_EARLY}, {_LATE} " + _MERGED.format(
    id="""coalesce(k.Currency_ID, (SELECT max(Currency_ID) FROM known) +
          row_number() OVER (PARTITION BY k.Currency_ID IS NULL ORDER BY f.Currency_Name))""",
    price=_REPLACED))
def upsert_currency_new_ids(spark, folder):
    return upsert.upsert_with_ids(
        _known(spark, folder), _fresh(spark, folder), "Currency_Name", ["Global_Price_USD"], "Currency_ID"
    )


@query("""
WITH known AS (SELECT c_custkey AS Pair_ID, c_name AS Pair_Name, c_nationkey AS Base_Currency_ID, c_mktsegment AS Manual_Category
               FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-15')),
fresh AS (SELECT c_name AS Pair_Name, c_nationkey AS Base_Currency_ID, category AS Manual_Category
          FROM customer JOIN (SELECT o_custkey, max(o_orderpriority) AS category FROM orders
                              WHERE o_orderdate >= TIMESTAMP '1998-04-15' GROUP BY o_custkey) ON o_custkey = c_custkey)
SELECT k.Pair_ID, coalesce(k.Pair_Name, f.Pair_Name) AS Pair_Name,
       coalesce(k.Base_Currency_ID, f.Base_Currency_ID) AS Base_Currency_ID,
       coalesce(f.Manual_Category, k.Manual_Category) AS Manual_Category
FROM known k FULL JOIN fresh f ON k.Pair_Name = f.Pair_Name""")
def upsert_pair(spark, folder):
    customer = b.table(spark, folder, "customer")
    early = _orders(spark, folder, "o_orderdate < timestamp_ntz'1998-04-15'").select(F.col("o_custkey").alias("c_custkey"))
    late = _orders(spark, folder, "o_orderdate >= timestamp_ntz'1998-04-15'").groupBy(F.col("o_custkey").alias("c_custkey"))
    known = customer.join(early, "c_custkey", "left_semi").select(
        F.col("c_custkey").alias("Pair_ID"), F.col("c_name").alias("Pair_Name"),
        F.col("c_nationkey").alias("Base_Currency_ID"), F.col("c_mktsegment").alias("Manual_Category"),
    )
    fresh = customer.join(late.agg(F.max("o_orderpriority").alias("Manual_Category")), "c_custkey").select(
        F.col("c_name").alias("Pair_Name"), F.col("c_nationkey").alias("Base_Currency_ID"), "Manual_Category"
    )
    return upsert.upsert(known, fresh, "Pair_Name", ["Manual_Category"])


@query(b.sql("trade_hist", f"""
SELECT TIME_ID, {_PARTS} FROM (SELECT DISTINCT "Timestamp" AS TIME_ID FROM trade_hist
                               WHERE "Timestamp" > TIMESTAMP '{TRADES_LOADED}')"""))
def insert_absent_time(spark, folder):
    trades = b.trade_hist(spark, folder)
    return upsert.absent(star.dim_time(_until(trades, TRADES_LOADED)), star.dim_time(trades), "TIME_ID")


@query("""
SELECT DISTINCT c_custkey AS Currency_ID, c_name AS Currency_Name, c_mktsegment AS Asset_Type
FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderdate >= TIMESTAMP '1998-04-15'
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-15')""")
def insert_absent_currency(spark, folder):
    # Incoming rows repeat: one per late order.
    customer = b.trade_currency(spark, folder)
    late = _orders(spark, folder, "o_orderdate >= timestamp_ntz'1998-04-15'").select(F.col("o_custkey").alias("Currency_ID"))
    return loads.new_currencies(_known(spark, folder), customer.join(late, "Currency_ID"))


# --- the category-keyed load -----------------------------------------------------------------
_CATEGORIES = ((1, "BUILDING"), (2, "MACHINERY"), (3, "FURNITURE"))
_CATEGORY_SQL = "category AS (SELECT * FROM (VALUES (1, 'BUILDING'), (2, 'MACHINERY'), (3, 'FURNITURE')) v(CATEGORY_ID, CATEGORY_NAME))"
_WANTED = "(p.Pair_Name LIKE '%NATION_1' OR p.Pair_Name LIKE '%NATION_2')"


def _category_load(spark, folder):
    # Composite categories, of which the first counts; three are in the dimension.
    pair = b.pair(spark, folder).withColumn("Manual_Category", F.concat("Manual_Category", F.lit(" , Other")))
    categories = literal_rows(spark, DIM_CATEGORY, _CATEGORIES)
    return loads.category_facts(
        b.price_hist(spark, folder), pair, b.currency(spark, folder), categories, ("NATION_1", "NATION_2")
    )


@query(b.sql("currency pair price_hist", f"""+{_CATEGORY_SQL}
SELECT p.Pair_Name AS PAIR_NAME, c.Currency_ID AS CURRENCY_ID, h."Timestamp" AS TIME_ID, k.CATEGORY_ID, 1 AS SOURCE_ID, h.Price AS PRICE
FROM price_hist h JOIN pair p ON h.Pair_ID = p.Pair_ID JOIN currency c ON p.Base_Currency_ID = c.Currency_ID
JOIN category k ON k.CATEGORY_NAME = trim(string_split(p.Manual_Category || ' , Other', ',')[1])
WHERE {_WANTED}"""))
def category_facts(spark, folder):
    return _category_load(spark, folder)[0]


@query(b.sql("pair", f"""+{_CATEGORY_SQL}
SELECT p.Pair_ID, p.Pair_Name, p.Base_Currency_ID AS CURRENCY_ID, p.Manual_Category AS CATEGORY_NAME
FROM pair p WHERE {_WANTED} AND p.Manual_Category NOT IN (SELECT CATEGORY_NAME FROM category)"""))
def category_rejects(spark, folder):
    return _category_load(spark, folder)[1].select("Pair_ID", "Pair_Name", "CURRENCY_ID", "CATEGORY_NAME")


# --- whole loads: a part of the prices first, then all of them ------------------------------------------------------------------
_FACT = f"""+
dim_source AS ({_SOURCES})
SELECT DISTINCT h."Timestamp" AS TIME_ID, h.Pair_ID AS PAIR_ID, s.SOURCE_ID, h.Price AS PRICE
FROM price_hist h JOIN dim_source s ON s.SOURCE_NAME = h.Source"""


@query(b.sql("price_hist", _FACT))
def daily_bridge(spark, folder):
    home = new_folder(spark, "star")
    view = "dim_pair_" + home[-32:]
    prices, pair, currency = b.price_hist(spark, folder), b.pair(spark, folder), b.currency(spark, folder)
    sources = published_sources(spark, prices, home)
    for landed in (_until(prices, LOADED), prices):
        loads.daily_bridge(spark, star.fact_price(landed, sources), pair, currency, home, view)
    return loads.open_fact(spark, home).drop(DAY)


@query(b.sql("price_hist", f"""SELECT TIME_ID, {_PARTS} FROM (SELECT DISTINCT "Timestamp" AS TIME_ID FROM price_hist)"""))
def bridge_dim_time(spark, folder):
    home = new_folder(spark, "star")
    early = _until(b.price_hist(spark, folder), LOADED)
    loads.load_facts(spark, star.fact_price(early), home)
    loads.load_facts(spark, star.fact_price(b.price_hist(spark, folder)), home)
    return loads.open_dim_time(spark, home).drop(DAY)


@query(b.sql("price_hist", """
SELECT "Timestamp" AS TIME_ID, Pair_ID AS PAIR_ID, 1 AS SOURCE_ID, Price AS PRICE FROM price_hist"""))
def bridge_after_mark(spark, folder):
    home = new_folder(spark, "star")
    early = _until(b.price_hist(spark, folder), LOADED)
    for prices in (early, b.price_hist(spark, folder)):
        loads.load_facts_after_mark(spark, star.fact_price(prices), home)
    return loads.open_fact(spark, home).drop(DAY)


@query(b.sql("price_hist", _STORED))
def history_reload(spark, folder):
    home = new_folder(spark, "history")
    prices = b.price_hist(spark, folder)
    loads.reload_history(_until(prices, LOADED), home)
    loads.reload_history(prices, home)
    return loads.open_prices(spark, home).drop(DAY)


def _history_bridge(spark, folder):
    """A part of the history, bridged; then all of it in its place, bridged twice."""
    home = new_folder(spark, "bridge")
    prices, pair, currency = b.price_hist(spark, folder), b.pair(spark, folder), b.currency(spark, folder)
    view = "dim_pair_" + home[-32:]
    loads.reload_history(_until(prices, LOADED).withColumn("Price", F.col("Price") + 1), home)
    loads.bridge(spark, pair, currency, home, view)
    loads.reload_history(prices, home)
    added = [loads.bridge(spark, pair, currency, home, view) for _ in range(2)]
    if added[1]:
        raise AssertionError(f"the second run added {added[1]} facts")
    return home, view


@query(b.sql("price_hist", _FACT))
def history_bridge(spark, folder):
    home, _ = _history_bridge(spark, folder)
    return loads.open_fact(spark, loads.star_folder(spark, home)).drop(DAY)


@query(_SOURCES)
def stored_dim_source(spark, folder):
    return loads.open_sources(spark, _history_bridge(spark, folder)[0])


@query(f"SELECT CAST(PAIR_ID AS INT) AS PAIR_ID, * EXCLUDE (PAIR_ID) FROM ({SQL['dim_pair']})")
def published_dim_pair(spark, folder):
    home, view = _history_bridge(spark, folder)
    return current(spark, view, DIM_PAIR, f"{home}/dim_pair")


# Prices without a source or without a time, as a broken feed would give them.
@query(b.sql("price_hist", """
SELECT CAST(Pair_ID AS INT) AS Pair_ID, Price, CASE WHEN Pair_ID % 7 <> 0 THEN "Timestamp" END AS "Timestamp",
       CASE WHEN Pair_ID % 3 <> 0 THEN Source END AS Source
FROM price_hist"""))
def delta_null_keys(spark, folder):
    home = new_folder(spark, "nulls")
    prices = b.price_hist(spark, folder).withColumns({
        "Timestamp": F.when(F.col("Pair_ID") % 7 != 0, F.col("Timestamp")),
        "Source": F.when(F.col("Pair_ID") % 3 != 0, F.col("Source")),
    })
    for batch in (prices, prices):
        loads.append_prices(spark, batch, home)
    return loads.open_prices(spark, home).drop(DAY)


def _stored_categories(spark, folder):
    home = new_folder(spark, "categories")
    pair = b.pair(spark, folder).withColumn("Manual_Category", F.concat("Manual_Category", F.lit(" , Other")))
    categories, currency = literal_rows(spark, DIM_CATEGORY, _CATEGORIES), b.currency(spark, folder)
    prices = b.price_hist(spark, folder)
    for part in (_until(prices, LOADED), prices):
        loads.load_categories(spark, part, pair, currency, categories, home, ("NATION_1", "NATION_2"))
    return home


@query(b.sql("currency pair price_hist", f"""+{_CATEGORY_SQL}
SELECT DISTINCT p.Pair_Name AS PAIR_NAME, CAST(c.Currency_ID AS INT) AS CURRENCY_ID, h."Timestamp" AS TIME_ID, k.CATEGORY_ID, 1 AS SOURCE_ID, h.Price AS PRICE
FROM price_hist h JOIN pair p ON h.Pair_ID = p.Pair_ID JOIN currency c ON p.Base_Currency_ID = c.Currency_ID
JOIN category k ON k.CATEGORY_NAME = trim(string_split(p.Manual_Category || ' , Other', ',')[1])
WHERE {_WANTED}"""))
def category_load(spark, folder):
    return loads.open_fact_pairs(spark, _stored_categories(spark, folder)).drop(DAY)


@query(b.sql("currency", "SELECT CAST(Currency_ID AS INT) AS Currency_ID, Currency_Name, Asset_Type FROM currency"))
def stored_dim_currency(spark, folder):
    return current(spark, "dim_currency", DIM_CURRENCY, _stored_categories(spark, folder))


def _master(spark, folder, moments=(EARLIER, MOMENT)):
    """Currency and pair from tickers and quotes, loaded at each moment into the same views."""
    home = new_folder(spark, "master")
    currency_view, pair_view = "currency_" + home[-32:], "pair_" + home[-32:]
    tickers = b.ticker(spark, folder)
    for moment in moments:
        loads.load_master(spark, tickers, quotes(spark, folder), home, currency_view, pair_view, moment, WORDS)
    return home, spark.table(currency_view), spark.table(pair_view)


@query(b.sql("ticker quote", ASSETS + "SELECT * FROM market"))
def master_load_pairs(spark, folder):
    return _master(spark, folder)[2]


@query(b.sql("ticker quote", ASSETS + f"""
SELECT m.Pair_ID, CAST(t.price AS DECIMAL(20,8)) AS Price, r.moment AS "Timestamp", 'Binance' AS Source
FROM ticker t JOIN market m ON m.Pair_Name = t.symbol,
(VALUES (TIMESTAMP '{EARLIER}'), (TIMESTAMP '{MOMENT}')) r(moment)"""))
def master_load_prices(spark, folder):
    home, _, _ = _master(spark, folder)
    return loads.open_prices(spark, home).drop(DAY)


@query(b.sql("ticker quote", ASSETS + f"""
, offer AS (SELECT symbol, base, CAST(price AS DECIMAL(20,8)) AS price FROM split)
SELECT TIMESTAMP '{EARLIER}' AS TIME_ID, CAST(m.Pair_ID AS BIGINT) AS PAIR_ID, 1 AS SOURCE_ID, s.price AS PRICE
FROM market m JOIN offer s ON s.symbol = m.Pair_Name
UNION
SELECT TIMESTAMP '{MOMENT}', m.Pair_ID, o.SOURCE_ID, o.PRICE
FROM market m JOIN offer s ON s.symbol = m.Pair_Name LEFT JOIN quote q ON q.symbol = s.base,
LATERAL (SELECT s.price AS PRICE, 1 AS SOURCE_ID UNION ALL SELECT q.Global_Price_USD, 2) o
WHERE o.PRICE <> 0"""))
def daily_run(spark, folder):
    # The master load's prices were never bridged: the first run finds them, the second nothing new.
    home, currency, pair = _master(spark, folder, (EARLIER,))
    for _ in range(2):
        loads.daily_run(
            spark, b.ticker(spark, folder), quotes(spark, folder), pair, currency, home, MOMENT,
            "dim_pair_" + home[-32:], markets=None,
        )
    return loads.open_fact(spark, home).drop(DAY)


@query(b.sql("ticker quote", ASSETS + "SELECT * FROM market"))
def master_load_repeated_payloads(spark, folder):
    # Quotes and tickers landed in two files each; the older quotes have other prices and no tags.
    home = new_folder(spark, "landed")
    payload = F.from_json("value", "struct<data: map<string, struct<tags: array<string>, quote: map<string, struct<price: decimal(30,12)>>>>>")
    old = F.transform_values(payload["data"], lambda k, v: v.withField("tags", F.lit(None).cast("array<string>")))
    landed = quote_payloads(spark, folder)
    landed.select(F.to_json(F.struct(old.alias("data"))).alias("value")).write.text(f"{home}/quotes/a")
    landed.write.text(f"{home}/quotes/b")
    quoted = payloads.flatten_quotes(payloads.set_aside(payloads.read_quotes(spark, f"{home}/quotes/*"), "data")[0])
    tickers = b.ticker(spark, folder)
    currency_view, pair_view = "currency_" + home[-32:], "pair_" + home[-32:]
    for moment in (EARLIER, MOMENT):
        loads.load_master(spark, tickers.unionAll(tickers), quoted, f"{home}/master", currency_view, pair_view, moment, WORDS)
    return spark.table(pair_view)


@query(b.sql("price_hist", _FACT))
def stream_incremental(spark, folder):
    home = new_folder(spark, "stream")
    events = b.table(spark, folder, "events")
    sources = published_sources(spark, b.as_prices(events), home)
    for _ in range(2):  # the second run finds no new file
        load_new_files(
            spark,
            f"{folder}/[e]vents.parquet",
            events.schema,
            lambda batch: star.fact_price(b.as_prices(batch), sources),
            f"{home}/star",
            f"{home}/checkpoint",
        )
    return loads.open_fact(spark, f"{home}/star").drop(DAY)
