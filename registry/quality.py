"""Profiles, constraint checks and classification queries."""

from pyspark.sql import functions as F

from marketlake.functions.classify import asset_type, category_or_default, primary_category, tag_categories
from marketlake.functions.symbols import base_of, quote_of
from marketlake.operators import constraints, profile
from marketlake.operators.joins import missing_keys
from registry import bindings as b
from registry.book import query

_EVENTS = ("event_id", "ts", "user_id", "event_type", "value", "props")
_EVENT_TYPES = ("bigint", "timestamp_ntz", "bigint", "string", "double", "string")

# Words of the part names by invented category; the other words belong to none.
WORDS = {
    "Fasteners": ("bolt", "anvil"),
    "Colour": ("red", "blue"),
    "Temperature": ("hot", "cold"),
    "Machined": ("gear", "rod", "plate", "ring"),
}


def categories_sql(tags: str) -> str:
    cases = " || ".join(
        f"CASE WHEN list_has_any({tags}, {list(words)}) THEN ', {category}' ELSE '' END"
        for category, words in WORDS.items()
    )
    return f"coalesce(nullif(substr({cases}, 3), ''), 'Other / Not Mapped')"


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) - count({c}) AS nulls, count({c}) AS non_null FROM events"
    for c, t in zip(_EVENTS, _EVENT_TYPES)
))
def null_profile(spark, folder):
    return profile.null_profile(b.table(spark, folder, "events"))


@query("""
SELECT * FROM (SELECT 'quality' AS "column", count(*) - count(quality) AS nulls
               FROM documents LEFT JOIN labels USING (doc_id)
               UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM documents LEFT JOIN labels USING (doc_id))
WHERE nulls > 0""")
def columns_with_nulls(spark, folder):
    # Labels cover some documents only, so the joined table really has NULLs.
    documents, labels = b.table(spark, folder, "documents"), b.table(spark, folder, "labels")
    return profile.columns_with_nulls(documents.select("doc_id").join(labels, "doc_id", "left"))


@query("""
SELECT 'full row' AS "check", CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS BIGINT) AS duplicates
UNION ALL
SELECT 'key', CAST((SELECT count(*) FROM lineitem) -
                   (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT)""")
def duplicate_profile(spark, folder):
    return profile.duplicate_profile(b.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(b.sql("ticker", """
SELECT 'full row' AS "check", (SELECT count(*) FROM ticker) - (SELECT count(*) FROM (SELECT DISTINCT symbol, price FROM ticker)) AS duplicates
UNION ALL
SELECT 'key', (SELECT count(*) FROM ticker) - (SELECT count(DISTINCT symbol) FROM ticker)"""))
def duplicate_tickers(spark, folder):
    return profile.duplicate_profile(b.ticker(spark, folder).select("symbol", "price"), ["symbol"])


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM events" for c in _EVENTS
))
def distinct_profile(spark, folder):
    return profile.distinct_profile(b.table(spark, folder, "events"))


@query("""
SELECT 'part name is unique' AS rule,
       (SELECT count(*) FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'lineitem key is unique',
       (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT 'event has a value', (SELECT count(*) FROM events WHERE value IS NULL)
UNION ALL SELECT 'event belongs to a customer',
       (SELECT count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'customer has events',
       (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL))""")
def constraint_violations(spark, folder):
    part, lineitem, events, customer = (b.table(spark, folder, t) for t in ("part", "lineitem", "events", "customer"))
    return constraints.violation_report({
        "part name is unique": constraints.repeated_keys(part, ["p_name"]),
        "lineitem key is unique": constraints.repeated_keys(lineitem, ["l_orderkey", "l_linenumber"]),
        "event has a value": constraints.null_rows(events, ["value"]),
        "event belongs to a customer": constraints.orphan_keys(events, "user_id", customer, "c_custkey"),
        "customer has events": constraints.orphan_keys(
            customer, "c_custkey", events.select("user_id").distinct(), "user_id"
        ),
    })


@query(b.sql("price_hist pair", """
SELECT DISTINCT Pair_ID FROM price_hist
WHERE Pair_ID NOT IN (SELECT Pair_ID FROM pair JOIN customer ON c_custkey = Pair_ID WHERE c_acctbal > 0)"""))
def missing_master(spark, folder):
    # Master data: the pairs of customers in credit.
    in_credit = b.table(spark, folder, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("Pair_ID"))
    master = b.pair(spark, folder).join(in_credit, "Pair_ID", "left_semi")
    return missing_keys(b.price_hist(spark, folder), master, "Pair_ID")


_SPLIT = """
SELECT id, symbol,
       CASE WHEN symbol LIKE '%USDT' THEN {usdt} WHEN symbol LIKE '%BTC' THEN {btc} ELSE substr(symbol, 1, 3) END AS base,
       CASE WHEN symbol LIKE '%USDT' THEN 'USDT' WHEN symbol LIKE '%BTC' THEN 'BTC' ELSE substr(symbol, 4) END AS quote
FROM ticker"""


@query(b.sql("ticker", _SPLIT.format(
    usdt="regexp_replace(symbol, 'USDT$', '')", btc="regexp_replace(symbol, 'BTC$', '')")))
def symbol_split(spark, folder):
    symbol = F.col("symbol")
    return b.ticker(spark, folder).select("id", symbol, base_of(symbol).alias("base"), quote_of(symbol).alias("quote"))


@query(b.sql("ticker", _SPLIT.format(usdt="replace(symbol, 'USDT', '')", btc="replace(symbol, 'BTC', '')")))
def symbol_split_every_occurrence(spark, folder):
    symbol = F.col("symbol")
    return b.ticker(spark, folder).select(
        "id", symbol, base_of(symbol, every_occurrence=True).alias("base"), quote_of(symbol).alias("quote")
    )


_REPEATED = """
SELECT id, symbol, {base} AS base, quote FROM (
    SELECT id, 'AUSDTB' || symbol || quote AS symbol, quote FROM (
        SELECT id, symbol, CASE WHEN symbol LIKE '%USDT' THEN 'USDT' WHEN symbol LIKE '%BTC' THEN 'BTC' END AS quote FROM ticker)
    WHERE quote IS NOT NULL)"""


def _repeated_suffixes(spark, folder, every_occurrence):
    tickers = b.ticker(spark, folder).filter("symbol LIKE '%USDT' OR symbol LIKE '%BTC'")
    longer = tickers.select("id", F.concat(F.lit("AUSDTB"), "symbol", quote_of(F.col("symbol"))).alias("symbol"))
    symbol = F.col("symbol")
    return longer.select("id", symbol, base_of(symbol, every_occurrence).alias("base"), quote_of(symbol).alias("quote"))


@query(b.sql("ticker", _REPEATED.format(base="replace(symbol, quote, '')")))
def symbol_split_repeated_suffix_all(spark, folder):
    return _repeated_suffixes(spark, folder, True)


@query(b.sql("ticker", _REPEATED.format(base="left(symbol, length(symbol) - length(quote))")))
def symbol_split_repeated_suffix_end(spark, folder):
    return _repeated_suffixes(spark, folder, False)


@query("""
SELECT c_custkey AS Pair_ID, coalesce(CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END, 'To be defined') AS category FROM customer""")
def category_default(spark, folder):
    given = F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment"))
    return b.table(spark, folder, "customer").select(F.col("c_custkey").alias("Pair_ID"), category_or_default(given).alias("category"))


@query("""
SELECT p_partkey AS id, CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 'stablecoin'
       WHEN p_type IN ('ECONOMY', 'LARGE', 'MEDIUM') THEN 'crypto' ELSE 'token' END AS asset_type
FROM part""")
def asset_types(spark, folder):
    kind = asset_type(F.lower("p_type"), ("PROMO", "STANDARD"), ("ECONOMY", "LARGE", "MEDIUM"))
    return b.table(spark, folder, "part").select(F.col("p_partkey").alias("id"), kind.alias("asset_type"))


@query(f"""
SELECT p_partkey AS id, {categories_sql("string_split(p_name, ' ')")} AS categories FROM part""")
def tag_category(spark, folder):
    tags = F.split(F.upper("p_name"), " ")
    return b.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), tag_categories(tags, WORDS).alias("categories")
    )


@query(f"""
SELECT id, trim(string_split(categories, ',')[1]) AS primary_category
FROM (SELECT p_partkey AS id, {categories_sql("string_split(p_name, ' ')")} AS categories FROM part)""")
def primary_categories(spark, folder):
    categories = tag_categories(F.split("p_name", " "), WORDS)
    return b.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), primary_category(categories).alias("primary_category")
    )
