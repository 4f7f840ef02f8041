"""Candles, category aggregates and source checks: what the original names or leads up to."""

from pyspark.sql import functions as F

from marketlake.functions.classify import tag_categories
from marketlake.functions.temporal import from_epoch_millis, from_offset_text
from marketlake.functions.values import to_price
from marketlake.operators import incremental, profile, upsert
from marketlake.operators.sinks import DAY, append_by_day, open_by_day
from marketlake.plans import analysis, candles
from marketlake.schemas import CORRUPT, PRICES
from marketlake.session import new_folder
from marketlake.sources import payloads
from marketlake.streaming import candle_stream
from registry import bindings as b
from registry.book import query
from registry.payloads import _millis
from registry.quality import WORDS, categories_sql

_OHLC = b.sql("price_hist", """
SELECT Pair_ID, CAST("Timestamp" AS DATE) AS Day, first(Price ORDER BY "Timestamp", Price_Hist_ID) AS Open, max(Price) AS High, min(Price) AS Low,
       last(Price ORDER BY "Timestamp", Price_Hist_ID) AS Close, count(*) AS Trades
FROM price_hist GROUP BY ALL""")


@query(_OHLC)
def daily_ohlc(spark, folder):
    return candles.daily_candles(b.price_hist(spark, folder))


@query("""
SELECT l_partkey AS Pair_ID, CAST(l_shipdate AS DATE) AS Day, first(price ORDER BY l_shipdate, id) AS Open, max(price) AS High, min(price) AS Low,
       last(price ORDER BY l_shipdate, id) AS Close, count(*) AS Trades
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(20,8)) AS price, l_orderkey * 10 + l_linenumber AS id FROM lineitem) GROUP BY ALL""")
def daily_ohlc_trades(spark, folder):
    # Ship dates have no time of day, so every day's first and last price are decided by the id alone.
    lines = b.table(spark, folder, "lineitem")
    prices = lines.select(
        F.col("l_partkey").alias("Pair_ID"), F.col("l_shipdate").alias("Timestamp"), F.col("l_extendedprice").cast("decimal(20,8)").alias("Price"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Price_Hist_ID"),
    )
    return candles.daily_candles(prices)


@query(_OHLC)
def daily_ohlc_merged(spark, folder):
    # Each source is a batch that has a part of every day; one batch is loaded twice.
    prices, home = b.price_hist(spark, folder), new_folder(spark, "candles")
    for source in ("click", "view", "signup", "click", "error", "purchase"):
        candles.add_candle_parts(prices.filter(F.col("Source") == source), home, source)
    return candles.open_candles(spark, home, prices)


_BROKEN = "event_type = 'error'"


def _large_files(spark, folder):
    """One JSON list of candles for each symbol; those of one symbol have no closing time and fields after it."""
    landed = new_folder(spark, "candle-lists")
    text = [_millis(F.col("ts")).cast("string"), *["0"] * 3, F.col("value").cast("decimal(20,8)").cast("string"), "0", _millis(F.col("ts")).cast("string"), "0"]
    quoted = [F.concat(F.lit('"'), x if not isinstance(x, str) else F.lit(x), F.lit('"')) for x in text]
    whole = F.concat(F.lit("["), F.concat_ws(", ", *quoted, F.col("user_id").cast("string"), *[F.lit('"0"')] * 3), F.lit("]"))
    broken = F.concat(F.lit("["), F.concat_ws(", ", *quoted[:4]), F.lit(', "'), F.col("event_id").cast("string"))
    events = b.table(spark, folder, "events").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("place"), F.when(F.expr(_BROKEN), broken).otherwise(whole).alias("value")
    )
    ends = events.groupBy("symbol").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    lined = events.join(F.broadcast(ends), "symbol")  # a row per symbol
    value = F.concat(
        F.when(F.col("place") == F.col("first"), "[").otherwise(""), "value", F.when(F.col("place") == F.col("last"), "]").otherwise(",")
    )
    lined.select("symbol", "place", value.alias("value")).repartition("symbol").sortWithinPartitions("symbol", "place").select(
        "symbol", "value"
    ).write.partitionBy("symbol").text(landed)
    return payloads.read_candle_list(spark, landed)


@query(f"""
SELECT event_type AS symbol, date_trunc('millisecond', ts) AS open_time, CAST(value AS DECIMAL(20,8)) AS close, user_id AS num_trades
FROM events WHERE NOT {_BROKEN}""")
def candle_large_file(spark, folder):
    read = _large_files(spark, folder).filter(F.col(CORRUPT).isNull())
    return read.select(
        "symbol",
        from_epoch_millis(F.col("timestamp").cast("bigint")).alias("open_time"),
        to_price(F.col("close")).alias("close"),
        F.col("num_trades").cast("bigint").alias("num_trades"),
    )


@query(f"SELECT event_type AS symbol, event_id FROM events WHERE {_BROKEN}")
def candle_large_file_rejects(spark, folder):
    read = _large_files(spark, folder).filter(F.col(CORRUPT).isNotNull())
    return read.select("symbol", F.regexp_extract(CORRUPT, r'"(\d+)$', 1).cast("bigint").alias("event_id"))


@query(b.sql("price_hist", """
+ ends AS (SELECT min(CAST("Timestamp" AS DATE)) AS low, max(CAST("Timestamp" AS DATE)) AS high FROM price_hist)
SELECT CAST(Pair_ID AS INT) AS Pair_ID, Price, "Timestamp", Source FROM price_hist h, ends
WHERE CAST("Timestamp" AS DATE) IN (low, high) AND NOT EXISTS (
    SELECT 1 FROM price_hist t WHERE t.Source <> 'click' AND t."Timestamp" = h."Timestamp" AND t.Pair_ID = h.Pair_ID AND t.Source = h.Source)"""))
def delta_scattered_days(spark, folder):
    # Stored in day folders: all sources but one. The batch has the first and the last day only.
    prices, home = b.price_hist(spark, folder), new_folder(spark, "days")
    typed = prices.select(F.col("Pair_ID").cast("int").alias("Pair_ID"), "Price", "Timestamp", "Source")
    append_by_day(typed.filter("Source <> 'click'"), home, "Timestamp")
    low, high = prices.agg(F.min(F.to_date("Timestamp")), F.max(F.to_date("Timestamp"))).first()
    batch = typed.filter(F.to_date("Timestamp").isin(low, high))
    return incremental.not_loaded(batch, open_by_day(spark, home, PRICES), ["Timestamp", "Pair_ID", "Source"], "Timestamp", DAY)


_ROLLUP = f"""
WITH pairs AS (
    SELECT p_partkey AS Pair_ID, string_split({categories_sql("string_split(p_name, ' ')")}, ', ') AS categories FROM part
), prices AS (
    SELECT l_partkey AS Pair_ID, strftime(l_shipdate, '%Y-%m') AS month, CAST(l_extendedprice AS DECIMAL(20,8)) AS Price FROM lineitem
), each AS (
    SELECT category, month, Price FROM prices JOIN (SELECT Pair_ID, unnest(categories) AS category FROM pairs) USING (Pair_ID)
), once AS (SELECT month, Price FROM prices JOIN pairs USING (Pair_ID))
SELECT category, month, CAST(level AS INT) AS level, n_prices, CAST(total AS DECIMAL(38,8)) AS total, least, most FROM (
    SELECT category, month, grouping(category, month) AS level, count(*) AS n_prices, sum(Price) AS total, min(Price) AS least, max(Price) AS most
    FROM each GROUP BY GROUPING SETS ((category, month), (category))
    UNION ALL
    SELECT NULL, month, 2 + grouping(month), count(*), sum(Price), min(Price), max(Price) FROM once GROUP BY GROUPING SETS ((month), ())
)"""


@query(_ROLLUP)
def category_rollup(spark, folder):
    # Parts are pairs; many names have words of several categories.
    categories = tag_categories(F.split("p_name", " "), WORDS)
    pair = b.table(spark, folder, "part").select(F.col("p_partkey").alias("Pair_ID"), categories.alias("Manual_Category"))
    prices = b.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("Pair_ID"), F.col("l_shipdate").alias("Timestamp"), F.col("l_extendedprice").cast("decimal(20,8)").alias("Price")
    )
    return analysis.category_rollup(prices, pair)


@query(b.sql("price_hist", """
+ closes AS (
    SELECT Pair_ID, CAST("Timestamp" AS DATE) AS Day, Source, last(Price ORDER BY "Timestamp", Price_Hist_ID) AS Close FROM price_hist
    WHERE Source IN ('view', 'click') GROUP BY ALL
), sides AS (
    SELECT coalesce(x.Pair_ID, y.Pair_ID) AS Pair_ID, coalesce(x.Day, y.Day) AS Day, x.Close AS First_Price, y.Close AS Second_Price,
        CASE WHEN x.Close > 0 AND y.Close > 0 THEN CAST(20000 * CAST(abs(x.Close - y.Close) * 100000000 AS HUGEINT) // CAST((x.Close + y.Close) * 100000000 AS HUGEINT) AS BIGINT) END AS Gap_Points
    FROM (SELECT * FROM closes WHERE Source = 'view') x FULL JOIN (SELECT * FROM closes WHERE Source = 'click') y ON x.Pair_ID = y.Pair_ID AND x.Day = y.Day
), gaps AS (
    SELECT Gap_Points, row_number() OVER (ORDER BY Gap_Points) AS place, count(*) OVER () AS n FROM sides WHERE Gap_Points IS NOT NULL
)
SELECT *, Gap_Points > (SELECT min(Gap_Points) FROM gaps WHERE place >= 0.9 * n) AS Outlier FROM sides"""))
def source_gap(spark, folder):
    return analysis.source_gap(b.price_hist(spark, folder), "view", "click", share=0.9)


def _landed_prices(spark, folder):
    return b.price_hist(spark, folder).select("Price_Hist_ID", "Pair_ID", "Price", "Timestamp")


@query(_OHLC)
def stream_daily_candles(spark, folder):
    # Several files and batches, then a run that finds nothing new. No price is older than the delay.
    landing, home = new_folder(spark, "landing"), new_folder(spark, "candle-stream")
    prices = _landed_prices(spark, folder)
    prices.repartition(3, "Pair_ID").write.parquet(landing)
    candle_stream.load_candle_stream(spark, landing, prices.schema, home, "1000 days", files_per_batch=2)
    candle_stream.load_candle_stream(spark, landing, prices.schema, home, "1000 days")
    return candle_stream.open_candles(spark, home)


@query(b.sql("price_hist", """
SELECT Pair_ID, "Timestamp", Price_Hist_ID, Price FROM price_hist
WHERE CAST("Timestamp" AS DATE) < (SELECT CAST(max("Timestamp") AS DATE) - 10 FROM price_hist)
  AND CAST(CAST("Timestamp" AS DATE) + 1 AS TIMESTAMP) <= (SELECT date_trunc('millisecond', max("Timestamp")) - INTERVAL 12 DAY FROM price_hist)"""))
def stream_late_prices(spark, folder):
    # The newest ten days come first, everything older in a second run: what is more than twelve days old is late.
    landing, home = new_folder(spark, "landing"), new_folder(spark, "candle-stream")
    prices = _landed_prices(spark, folder)
    newest = prices.agg(F.max(F.to_date("Timestamp"))).first()[0]
    recent = F.to_date("Timestamp") >= F.date_sub(F.lit(newest), 10)
    for part in (prices.filter(recent), prices.filter(~recent)):
        part.write.mode("append").parquet(landing)
        candle_stream.load_candle_stream(spark, landing, prices.schema, home, "12 days")
    return candle_stream.open_late(spark, home)


@query("""
SELECT * FROM (VALUES
    ('event_id', 'bigint', (SELECT count(*) FROM events WHERE event_id IS NULL), (SELECT count(event_id) FROM events), true),
    ('ts', 'timestamp_ntz', (SELECT count(*) FROM events WHERE ts IS NULL), (SELECT count(ts) FROM events), true),
    ('user_id', 'bigint', (SELECT count(*) FROM events WHERE user_id IS NULL), (SELECT count(user_id) FROM events), true),
    ('half', 'double', (SELECT count(*) FROM events WHERE event_type = 'view'), (SELECT count(*) FROM events WHERE event_type <> 'view'), true),
    ('props', 'string', (SELECT count(*) FROM events WHERE props IS NULL), (SELECT count(props) FROM events), true)
) AS t("column", dtype, nulls, non_null, near)""")
def profile_by_day(spark, folder):
    # The older days are profiled first; a second run finds the rest, a third nothing.
    home = new_folder(spark, "profiled")
    events = b.table(spark, folder, "events")
    half = F.when(F.col("event_type") != "view", F.col("value")).alias("half")
    rows = events.select("event_id", "ts", "user_id", half, "props")
    newest = F.to_date("ts") >= F.lit("2024-01-16").cast("date")
    for part in (rows.filter(~newest), rows.filter(newest), rows.filter("false")):
        append_by_day(part, f"{home}/table", "ts")
        profile.profile_new_days(spark, f"{home}/table", rows.schema, f"{home}/profile")
    found = profile.merged_profile(spark, f"{home}/profile")
    exact = profile.distinct_profile(rows).withColumnRenamed("distinct_values", "exact")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.04 * F.col("exact") + 1  # five standard errors
    return found.join(exact, "column").select("column", "dtype", "nulls", "non_null", near.alias("near"))


@query("""
SELECT user_id, event_type, day, count(*) AS copies FROM (SELECT user_id, event_type, CASE WHEN value > 1 THEN CAST(ts AS DATE) END AS day FROM events)
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_rows_by_digest(spark, folder):
    day = F.when(F.col("value") > 1, F.to_date("ts")).alias("day")
    return profile.duplicate_rows(b.table(spark, folder, "events").select("user_id", "event_type", day))


@query("""
WITH every AS (SELECT DISTINCT p_name AS name FROM part)
SELECT name, 1 AS ids, true AS alike, true AS apart FROM every""")
def upsert_currency_hash_ids(spark, folder):
    # Ids of 16 bits make some of the names collide. Two loads, and one of all.
    names = b.table(spark, folder, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("kind"))
    empty = names.select("name", F.lit(0).cast("long").alias("id")).filter("false")
    first = upsert.hash_ids(empty, names.filter("kind <> 'SMALL'"), "name", "id", bits=16)
    both = first.unionByName(upsert.hash_ids(first, names, "name", "id", bits=16))
    wide = upsert.hash_ids(empty, names, "name", "id")
    halves = upsert.hash_ids(empty, names.filter("kind = 'SMALL'"), "name", "id")
    halves = halves.unionByName(upsert.hash_ids(halves, names, "name", "id")).select("name", F.col("id").alias("other"))
    shared = both.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.lit(True).alias("shared"))
    return both.join(wide.withColumnRenamed("id", "wide"), "name").join(halves, "name").join(shared, "id", "left").groupBy("name").agg(
        F.count_distinct("id").cast("int").alias("ids"), F.bool_and(F.col("wide") == F.col("other")).alias("alike"), F.bool_and(F.col("shared").isNull()).alias("apart")
    )


@query(b.sql("price_hist", """
SELECT Pair_ID, day AS "Timestamp", Price, Source FROM (
    SELECT Pair_ID, CAST(CAST("Timestamp" AS DATE) AS TIMESTAMP) AS day, Price, Source,
        row_number() OVER (PARTITION BY Pair_ID, CAST("Timestamp" AS DATE) ORDER BY Price, Source) AS place FROM price_hist
) WHERE place = 1"""))
def one_price_per_time(spark, folder):
    # Daily times, of which most pairs have several prices: the least row stays.
    prices = b.price_hist(spark, folder).select("Pair_ID", F.to_date("Timestamp").cast("timestamp_ntz").alias("Timestamp"), "Price", "Source")
    return incremental.one_per_key(prices, ["Pair_ID", "Timestamp"])


@query("SELECT event_id, date_trunc('second', ts) AS wall_clock FROM events")
def offset_timestamps(spark, folder):
    # Exports with no zone, with Z, and with offsets: the time that is shown counts.
    events = b.table(spark, folder, "events")
    kind = F.col("event_type")
    offset = F.when(kind == "view", "Z").when(kind == "click", "+02:00").when(kind == "error", "-0530").otherwise("")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    return events.select("event_id", from_offset_text(text).alias("wall_clock"))
