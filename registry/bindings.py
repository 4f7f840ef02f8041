"""The given tables seen as market tables, once for Spark and once as SQL.

Two bindings of the same model. In the first the dimensions are small: events are prices, customers
are pairs, nations are currencies, and a pair is quoted in the nation that carries the number of its
base nation's region. In the second they grow with the data: lineitems are prices, orders are
pairs, customers are currencies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.schemas import PRICE

# SQL of each binding; `sql` puts the needed ones before a query.
VIEWS = {
    "currency": """
        SELECT n_nationkey AS Currency_ID, n_name AS Currency_Name, r_name AS Asset_Type,
               best AS Global_Price_USD
        FROM nation JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT s_nationkey, max(CAST(s_acctbal AS DECIMAL(20,8))) AS best
                   FROM supplier GROUP BY s_nationkey) ON s_nationkey = n_nationkey""",
    "pair": """
        SELECT c_custkey AS Pair_ID, c_name || q.n_name AS Pair_Name,
               b.n_nationkey AS Base_Currency_ID, q.n_nationkey AS Quote_Currency_ID,
               c_mktsegment AS Manual_Category
        FROM customer JOIN nation b ON c_nationkey = b.n_nationkey
        JOIN nation q ON q.n_nationkey = b.n_regionkey""",
    "price_hist": """
        SELECT event_id AS Price_Hist_ID, user_id AS Pair_ID, CAST(value AS DECIMAL(20,8)) AS Price,
               ts AS "Timestamp", event_type AS Source
        FROM events""",
    "metadata": """
        SELECT p_partkey AS id, replace(p_brand, 'Brand#', 'nation_') AS symbol, p_name AS name,
               p_size AS "rank"
        FROM part""",
    "trade_currency": """
        SELECT c_custkey AS Currency_ID, c_name AS Currency_Name, c_mktsegment AS Asset_Type,
               CAST(c_acctbal AS DECIMAL(20,8)) AS Global_Price_USD
        FROM customer""",
    "trade_pair": """
        SELECT o_orderkey AS Pair_ID, 'ORDER-' || CAST(o_orderkey AS VARCHAR) AS Pair_Name,
               o_custkey AS Base_Currency_ID, o_orderpriority AS Manual_Category
        FROM orders""",
    "trade_hist": """
        SELECT l_orderkey AS Pair_ID, CAST(l_extendedprice AS DECIMAL(20,8)) AS Price,
               l_shipdate AS "Timestamp", l_returnflag AS Source
        FROM lineitem""",
    "trade_metadata": """
        SELECT p_partkey AS id, 'Customer#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS symbol,
               p_name AS name, p_size AS "rank"
        FROM part""",
    "ticker": """
        SELECT p_partkey AS id,
               upper(replace(p_name, ' ', '')) ||
               CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 'USDT'
                    WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'BTC' ELSE 'EUR' END AS symbol,
               CAST(p_retailprice AS VARCHAR) AS price
        FROM part""",
    "quote": """
        SELECT upper(replace(p_name, ' ', '')) AS symbol, string_split(p_name, ' ') AS tags,
               CAST(p_retailprice AS DECIMAL(20,8)) AS Global_Price_USD
        FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size, p_partkey) AS place FROM part)
        WHERE place = 1""",
}


def sql(views: str, body: str) -> str:
    """``body`` with the named views in front of it."""
    parts = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in views.split())
    joiner = ",\n" if body.lstrip().startswith("+") else "\n"
    return f"WITH {parts}{joiner}{body.lstrip().removeprefix('+')}"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its schema is taken from the files once; a read without one is a job each time."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def currency(spark: SparkSession, folder: str) -> DataFrame:
    best = table(spark, folder, "supplier").groupBy("s_nationkey").agg(
        F.max(F.col("s_acctbal").cast(PRICE)).alias("Global_Price_USD")
    )
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    named = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return named.join(best, named["n_nationkey"] == best["s_nationkey"], "left").select(
        F.col("n_nationkey").alias("Currency_ID"),
        F.col("n_name").alias("Currency_Name"),
        F.col("r_name").alias("Asset_Type"),
        "Global_Price_USD",
    )


def pair(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    base = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("Quote_Currency_ID"))
    quote = nation.select(F.col("n_nationkey").alias("Quote_Currency_ID"), F.col("n_name").alias("quote_name"))
    customer = table(spark, folder, "customer")
    return customer.join(base, "c_nationkey").join(quote, "Quote_Currency_ID").select(
        F.col("c_custkey").alias("Pair_ID"),
        F.concat("c_name", "quote_name").alias("Pair_Name"),
        F.col("c_nationkey").alias("Base_Currency_ID"),
        "Quote_Currency_ID",
        F.col("c_mktsegment").alias("Manual_Category"),
    )


def as_prices(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("Price_Hist_ID"),
        F.col("user_id").alias("Pair_ID"),
        F.col("value").cast(PRICE).alias("Price"),
        F.col("ts").alias("Timestamp"),
        F.col("event_type").alias("Source"),
    )


def price_hist(spark: SparkSession, folder: str) -> DataFrame:
    return as_prices(table(spark, folder, "events"))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("nation_")).alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("rank"),
    )


def trade_currency(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Currency_ID"),
        F.col("c_name").alias("Currency_Name"),
        F.col("c_mktsegment").alias("Asset_Type"),
        F.col("c_acctbal").cast(PRICE).alias("Global_Price_USD"),
    )


def trade_pair(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Pair_ID"),
        F.concat(F.lit("ORDER-"), F.col("o_orderkey").cast("string")).alias("Pair_Name"),
        F.col("o_custkey").alias("Base_Currency_ID"),
        F.col("o_orderpriority").alias("Manual_Category"),
    )


def trade_hist(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Pair_ID"),
        F.col("l_extendedprice").cast(PRICE).alias("Price"),
        F.col("l_shipdate").alias("Timestamp"),
        F.col("l_returnflag").alias("Source"),
    )


def trade_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("rank"),
    )


def ticker(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_type")
    quote = F.when(kind.isin("PROMO", "STANDARD"), "USDT").when(kind.isin("ECONOMY", "LARGE"), "BTC").otherwise("EUR")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit(""))), quote).alias("symbol"),
        F.col("p_retailprice").cast("string").alias("price"),
    )


def asset_meta(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as assets whose symbol, the part name, is used many times over."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("symbol"),
        F.col("p_brand").alias("name"),
        F.col("p_size").alias("rank"),
    )
