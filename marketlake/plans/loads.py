"""Loads of the star tables: the daily bridge, the category-keyed load, the history reload.

Every load can run again after a failure or on the same input and adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.classify import CATEGORY_KEYWORDS, primary_category
from marketlake.functions.symbols import MARKETS, ends_with_any
from marketlake.operators.constraints import require_unique
from marketlake.operators.incremental import (
    Extent,
    extent,
    high_water_mark,
    newer_than_mark,
    not_loaded,
    one_per_key,
)
from marketlake.operators.joins import join_dimension, lookup
from marketlake.operators.sinks import (
    DAY,
    announce,
    append,
    append_by_day,
    current,
    current_path,
    current_paths,
    new_version,
    open_by_day,
    publish,
)
from marketlake.operators.upsert import absent
from marketlake.plans.normalise import (
    currency_rows,
    delta_prices,
    merge_currencies,
    merge_pairs,
    pair_rows,
    price_rows,
)
from marketlake.plans.star import dim_pair, dim_source, dim_time, fact_price, seed_sources
from marketlake.schemas import (
    CURRENCY,
    DIM_CURRENCY,
    DIM_PAIR,
    DIM_SOURCE,
    DIM_TIME,
    FACT_KEY,
    FACT_PAIRS,
    FACT_PRICE,
    PAIR,
    PRICE_KEY,
    PRICES,
)
from marketlake.session import scratch, stored
from marketlake.streaming.files import each_new_batch

PRICES_VIEW = "price_hist"
SOURCES_VIEW = "dim_source"


def open_fact(spark: SparkSession, star: str) -> DataFrame:
    return open_by_day(spark, f"{star}/fact_price", FACT_PRICE)


def open_dim_time(spark: SparkSession, star: str) -> DataFrame:
    return open_by_day(spark, f"{star}/dim_time", DIM_TIME)


def add_times(spark: SparkSession, facts: DataFrame, star: str, within: Extent) -> int:
    """Add the times of these facts that the time dimension lacks."""
    times = dim_time(facts.filter("TIME_ID IS NOT NULL"), "TIME_ID")
    fresh = not_loaded(times, open_dim_time(spark, star), ["TIME_ID"], "TIME_ID", DAY, within)
    return append_by_day(fresh, f"{star}/dim_time", "TIME_ID")


def load_facts(spark: SparkSession, batch: DataFrame, star: str) -> int:
    """Append the facts of a batch that the table lacks.

    A fact is its whole row: time, pair, source and price, NULL being a value like any other. So late rows, rows
    at the newest time and second prices are loaded as well, and what is already there is not.

    The times go in first, so that no fact is ever without one. They are those of the whole batch,
    which needs only its time column: facts that are already loaded have their times. The batch is
    read again for each step; give one that is stored if it is dear to compute.
    """
    size = extent(batch, "TIME_ID", FACT_KEY)
    if size.rows == 0:
        return 0
    add_times(spark, batch, star, size)
    fresh = not_loaded(batch.select(*FACT_KEY).distinct(), open_fact(spark, star), FACT_KEY, "TIME_ID", DAY, size)
    return append_by_day(fresh, f"{star}/fact_price", "TIME_ID")


def load_facts_after_mark(spark: SparkSession, batch: DataFrame, star: str) -> int:
    """Append the facts after the newest one loaded, and only those."""
    mark = high_water_mark(open_fact(spark, star), "TIME_ID", DAY, f"{star}/fact_price")
    fresh = newer_than_mark(batch, mark, "TIME_ID")
    size = extent(fresh, "TIME_ID")
    if size.rows == 0:
        return 0
    add_times(spark, fresh, star, size)
    return append_by_day(fresh, f"{star}/fact_price", "TIME_ID")


def load_master(
    spark: SparkSession,
    tickers: DataFrame,
    quotes: DataFrame,
    home: str,
    currency_view: str = "currency",
    pair_view: str = "pair",
    moment=None,
    keywords: Mapping[str, Sequence[str]] = CATEGORY_KEYWORDS,
    keep_existing_on_null: bool = False,
) -> int:
    """Merge the assets and pairs of these tickers into the master tables and append their prices.

    Both tables get a new version, announced together once both are written and their names found unique. Pairs are built
    from the stored currencies, so that all steps see the same ids. Prices come last: a load that
    stopped before them is finished by running it again with the same ``moment``.
    """
    with scratch(spark):
        version, paths = new_version(home), current_paths(spark, home)
        currency = current(spark, currency_view, CURRENCY, home, paths)
        append(merge_currencies(currency, currency_rows(tickers, quotes), keep_existing_on_null), f"{version}/currency")
        merged = spark.read.schema(CURRENCY).parquet(f"{version}/currency")
        pair = current(spark, pair_view, PAIR, home, paths)
        append(merge_pairs(pair, pair_rows(tickers, merged, keywords)), f"{version}/pair")
        pairs = spark.read.schema(PAIR).parquet(f"{version}/pair")
        for rows, keys in ((merged, ("Currency_ID", "Currency_Name")), (pairs, ("Pair_ID", "Pair_Name"))):
            require_unique(rows, keys)
        announced = {currency_view: f"{version}/currency", pair_view: f"{version}/pair"}
        announce(spark, home, {currency_view: merged, pair_view: pairs}, announced)
        return append_prices(spark, price_rows(tickers, pairs, moment), home, paths)


def daily_bridge(
    spark: SparkSession, facts: DataFrame, pair: DataFrame, currency: DataFrame, star: str, view: str = "dim_pair"
) -> int:
    """Replace the pair dimension, then append the facts of this batch that the table lacks."""
    publish({view: _typed(dim_pair(pair, currency), DIM_PAIR)}, f"{star}/dim_pair")
    return load_facts(spark, facts, star)


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with the columns and types that a table is stored with."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _prices_path(spark: SparkSession, home: str) -> str:
    return current_path(spark, PRICES_VIEW, home) or f"{home}/{PRICES_VIEW}"


def open_prices(spark: SparkSession, home: str) -> DataFrame:
    """The price history: what the last reload gave, if any, and what was appended since."""
    return open_by_day(spark, _prices_path(spark, home), PRICES)


def append_prices(spark: SparkSession, prices: DataFrame, home: str, paths: Mapping[str, str] | None = None) -> int:
    """Append to the price history what it does not have of these times, pairs and sources.

    Repeats inside one batch stay as they are; a batch that was loaded before adds nothing, also where
    its rows have no source or no time. The batch is written once: its checks and the append read that.
    """
    with scratch(spark):
        path = (current_paths(spark, home) if paths is None else paths).get(PRICES_VIEW) or f"{home}/{PRICES_VIEW}"
        prices = stored(_typed(prices, PRICES), "prices")
        fresh = not_loaded(prices, open_by_day(spark, path, PRICES), PRICE_KEY, "Timestamp", DAY)
        return append_by_day(fresh, path, "Timestamp")


def open_sources(spark: SparkSession, home: str) -> DataFrame:
    """The stored source dimension; the seed rows before the first price was bridged."""
    path = current_path(spark, SOURCES_VIEW, home)
    return spark.read.schema(DIM_SOURCE).parquet(path) if path else seed_sources(spark)


def add_sources(spark: SparkSession, prices: DataFrame, home: str) -> DataFrame:
    """The source dimension, extended by the sources of these prices and stored if there are new ones."""
    known = open_sources(spark, home)
    extended = stored(dim_source(known, prices), "sources")
    if extended.count() > known.count():
        publish({SOURCES_VIEW: extended}, home)
    return extended


def star_folder(spark: SparkSession, home: str) -> str:
    """Where the star tables of the current price history are. A reload of the history starts new ones, so that
    a corrected price replaces its fact and does not stand beside it."""
    path = current_path(spark, PRICES_VIEW, home)
    return path.rpartition("/")[0] if path else home


def bridge_prices(spark: SparkSession, home: str) -> int:
    """Add the facts and times of all stored prices that are not bridged yet, whichever load stored them.

    The files of the price history are read as a stream whose checkpoint knows the bridged ones, so a run
    reads what is new and nothing is ever left behind; a run that failed is made up for by the next.
    """
    star = star_folder(spark, home)

    def load(batch: DataFrame) -> int:
        return load_facts(spark, stored(fact_price(batch, add_sources(spark, batch, home)), "facts"), star)

    open_prices(spark, home)  # makes the folder if nothing was stored yet
    schema = T.StructType([*PRICES.fields, T.StructField(DAY, T.DateType())])
    return each_new_batch(spark, _prices_path(spark, home), schema, f"{star}/bridged", load)


def bridge(spark: SparkSession, pair: DataFrame, currency: DataFrame, home: str, view: str = "dim_pair") -> int:
    """The bridge to the star tables: replace the pair dimension, then add all facts that are missing."""
    publish({view: _typed(dim_pair(pair, currency), DIM_PAIR)}, f"{home}/dim_pair")
    return bridge_prices(spark, home)


def daily_run(
    spark: SparkSession,
    tickers: DataFrame,
    quotes: DataFrame,
    pair: DataFrame,
    currency: DataFrame,
    home: str,
    moment,
    view: str = "dim_pair",
    markets: Sequence[str] | None = MARKETS,
) -> int:
    """The scheduled run: current prices from both sources into the history, then the bridge of all prices
    that have none yet.

    ``moment`` names the run. A run that is repeated for the same moment adds nothing.
    """
    append_prices(spark, delta_prices(tickers, quotes, pair, moment, markets), home)
    return bridge(spark, pair, currency, home, view)


def category_facts(
    prices: DataFrame, pair: DataFrame, currency: DataFrame, categories: DataFrame, suffixes: tuple[str, ...] = ("USD", "USDT")
) -> tuple[DataFrame, DataFrame]:
    """Facts of dollar pairs keyed by their primary category, and the pairs whose category is unknown.

    Both the suffix and the category belong to the pair, so the lookup is done on pairs and the
    prices are joined once, to the pairs that passed.
    """
    wanted = pair.filter(ends_with_any(F.col("Pair_Name"), suffixes))
    wanted = wanted.join(currency.select(F.col("Currency_ID").alias("Base_Currency_ID")), "Base_Currency_ID")
    wanted = wanted.select(
        "Pair_ID",
        "Pair_Name",
        F.col("Base_Currency_ID").alias("CURRENCY_ID"),
        primary_category(F.col("Manual_Category")).alias("CATEGORY_NAME"),
    )
    matched, rejected = lookup(wanted, categories, "CATEGORY_NAME")
    facts = join_dimension(prices, matched, "Pair_ID").select(
        F.col("Pair_Name").alias("PAIR_NAME"),
        "CURRENCY_ID",
        F.col("Timestamp").alias("TIME_ID"),
        "CATEGORY_ID",
        F.lit(1).alias("SOURCE_ID"),
        F.col("Price").alias("PRICE"),
    )
    return facts, rejected


def new_currencies(existing: DataFrame, currency: DataFrame) -> DataFrame:
    """Currencies that the dimension lacks; known ones stay as they are."""
    return absent(existing, currency.select("Currency_ID", "Currency_Name", "Asset_Type"), "Currency_ID")


def load_categories(
    spark: SparkSession,
    prices: DataFrame,
    pair: DataFrame,
    currency: DataFrame,
    categories: DataFrame,
    home: str,
    suffixes: tuple[str, ...] = ("USD", "USDT"),
) -> tuple[int, DataFrame]:
    """The category-keyed load: times, currencies and facts of dollar pairs; the number of facts added, and the
    pairs that were left out since the dimension lacks their category.

    Facts and times are appended by key. The currency dimension, to which only new rows are added, gets a new
    version, announced when all three are written. A load that is repeated adds nothing.
    """
    facts, rejected = category_facts(prices, pair, currency, categories, suffixes)
    rejected = stored(rejected, "rejected")
    with scratch(spark):
        facts = stored(_typed(facts, FACT_PAIRS).distinct(), "facts")
        size = extent(facts, "TIME_ID", FACT_PAIRS.names)
        known = current(spark, "dim_currency", DIM_CURRENCY, home)
        version = new_version(home)
        append(known.unionByName(_typed(new_currencies(known, currency), DIM_CURRENCY)), f"{version}/dim_currency")
        added = 0
        if size.rows:
            add_times(spark, facts, home, size)
            fresh = not_loaded(facts, open_fact_pairs(spark, home), FACT_PAIRS.names, "TIME_ID", DAY, size)
            added = append_by_day(fresh, f"{home}/fact_pairs", "TIME_ID")
        stored_currency = spark.read.schema(DIM_CURRENCY).parquet(f"{version}/dim_currency")
        announce(spark, home, {"dim_currency": stored_currency}, {"dim_currency": f"{version}/dim_currency"})
    return added, rejected


def open_fact_pairs(spark: SparkSession, home: str) -> DataFrame:
    return open_by_day(spark, f"{home}/fact_pairs", FACT_PAIRS)


def reload_history(history: DataFrame, home: str, one_per_time: bool = False) -> int:
    """Replace the whole price history in one step; its facts are rebuilt by the next bridge.

    Input rows are kept as they are; ``one_per_time`` keeps one per pair and time.
    """
    if one_per_time:
        history = one_per_key(history, ["Pair_ID", "Timestamp"])
    return publish({PRICES_VIEW: _typed(history, PRICES)}, home, {PRICES_VIEW: "Timestamp"})[PRICES_VIEW]
