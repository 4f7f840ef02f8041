"""The scheduled jobs as commands: one run each, started by an outside scheduler.

    python -m marketlake.jobs master     --tickers P --quotes P --home P [--moment T]
    python -m marketlake.jobs history    --candles P --home P      (or backfill)
    python -m marketlake.jobs daily      --tickers P --quotes P --home P [--moment T]
    python -m marketlake.jobs bridge     --home P
    python -m marketlake.jobs stream     --prices P --home P       (Parquet files: Pair_ID, Price, Timestamp, Source)
    python -m marketlake.jobs candles    --prices P --home P [--delay "1 day"]    (with Price_Hist_ID)
    python -m marketlake.jobs categories --categories CSV --home P
    python -m marketlake.jobs stage      --assets P --home P --to P
    python -m marketlake.jobs export     --home P --to P

All take --shuffle-bytes (of the largest shuffle), those that read payloads --markets A,B,... or --markets all and
--multiline. Without --moment a run takes the time at which it starts; a repeated run must name the first one's.
What a run leaves out is written to HOME/rejects/<job>/<what> and counted in its output; what history and backfill
imported of each symbol is printed and written to HOME/reports/<job>/imported.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.symbols import MARKETS
from marketlake.operators.joins import missing_keys
from marketlake.operators.sinks import append, current, export_csv, write_staging
from marketlake.plans import loads, star
from marketlake.plans.normalise import EXCHANGE, history_rows, only_markets
from marketlake.schemas import CORRUPT, CURRENCY, DIM_CATEGORY, PAIR, PRICE_HIST, PRICES
from marketlake.session import build_session, scratch, shuffle_settings, stored
from marketlake.sources import files, payloads
from marketlake.streaming.candle_stream import load_candle_stream, open_candles
from marketlake.streaming.files import each_new_batch


class Run:
    """One run of a job: its options, the time it stands for, and the counts it reports."""

    def __init__(self, spark: SparkSession, options: argparse.Namespace):
        self.spark, self.options, self.home = spark, options, options.home
        now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        self.moment = getattr(options, "moment", None) or str(now)  # one time for the whole run
        self.counts: dict[str, int] = {}

    def reject(self, what: str, rows: DataFrame) -> int:
        """Keep rows that the run leaves out, and count them; nothing is written for none."""
        rows = stored(rows, what)
        self.counts[what] = rows.count()
        if self.counts[what]:
            stamped = rows.withColumn("run", F.lit(self.moment))
            append(stamped, f"{self.home}/rejects/{self.options.job.__name__}/{what}")
        return self.counts[what]

    def markets(self) -> Sequence[str] | None:
        chosen = self.options.markets
        return MARKETS if chosen is None else None if chosen == "all" else chosen.split(",")

    def landed(self) -> tuple[DataFrame, DataFrame]:
        """Tickers and quotes that parse; a run in which no quote payload does would empty prices and is stopped."""
        many = self.options.multiline
        read = stored(payloads.read_tickers(self.spark, self.options.tickers, many), "tickers")
        tickers, bad = payloads.set_aside(read, "symbol")
        self.reject("tickers", bad)
        quotes, bad = payloads.set_aside(stored(payloads.read_quotes(self.spark, self.options.quotes, many), "quotes"), "data")
        rejected = self.reject("quotes", bad)
        if rejected and quotes.isEmpty():
            raise SystemExit(f"{rejected} quote payloads, and none could be parsed: nothing was loaded")
        if self.markets() is not None:
            tickers = only_markets(tickers, self.markets())
        return tickers, payloads.flatten_quotes(quotes)

    def master(self) -> tuple[DataFrame, DataFrame]:
        return current(self.spark, "pair", PAIR, self.home), current(self.spark, "currency", CURRENCY, self.home)

    def unknown(self, rows: DataFrame, pair: DataFrame) -> None:
        """Report symbols that the master data does not have."""
        self.reject("unknown_symbols", missing_keys(rows, pair.select(F.col("Pair_Name").alias("symbol")), "symbol"))

    def candles(self) -> DataFrame:
        """Prices of the landed candles. The files are parsed once, and the counts per symbol are reported."""
        read = payloads.candles_and_rejects(payloads.read_candles(self.spark, self.options.candles))
        read = stored(read.select("symbol", "timestamp", "close", CORRUPT), "candles")
        self.reject("candles", read.filter(F.col(CORRUPT).isNotNull()).select("symbol", F.col(CORRUPT).alias("value")))
        parsed = read.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        pair = self.master()[0]
        self.unknown(parsed, pair)
        known = parsed.join(pair.select(F.col("Pair_Name").alias("symbol")), "symbol", "left_semi")
        imported = stored(known.groupBy("symbol").agg(F.count(F.lit(1)).alias("candles")), "imported")
        append(imported.withColumn("run", F.lit(self.moment)), f"{self.home}/reports/{self.options.job.__name__}/imported")
        for symbol, rows in imported.orderBy("symbol").toLocalIterator():  # no more symbols than the master data has
            self.counts[f"candles of {symbol}"] = rows
        return history_rows(parsed, pair).withColumn("Source", F.lit(EXCHANGE)).select(*PRICES.names)


def master(run: Run) -> int:
    """Currencies, pairs and prices from landed tickers and quotes."""
    return loads.load_master(run.spark, *run.landed(), run.home, moment=run.moment)


def history(run: Run) -> int:
    """Replace the price history by what the candles give."""
    return loads.reload_history(run.candles(), run.home)


def backfill(run: Run) -> int:
    """Add to the price history what the candles have and it has not."""
    return loads.append_prices(run.spark, run.candles(), run.home)


def daily(run: Run) -> int:
    """Current prices from both sources, then all prices that have none yet to the star tables."""
    tickers, quotes = run.landed()
    pair, currency = run.master()
    run.unknown(tickers, pair)
    return loads.daily_run(run.spark, tickers, quotes, pair, currency, run.home, run.moment, markets=run.markets())


def bridge(run: Run) -> int:
    """The pair dimension and all prices that have no fact yet."""
    return loads.bridge(run.spark, *run.master(), run.home)


def stream(run: Run) -> int:
    """New price files, each once, to the price history, then all prices that have none yet to the star tables."""
    def load(batch: DataFrame) -> int:
        return loads.append_prices(run.spark, batch, run.home)

    run.counts["prices"] = each_new_batch(run.spark, run.options.prices, PRICES, f"{run.home}/streamed", load)
    return bridge(run)


def candles(run: Run) -> int:
    """New price files, each once, to daily candles below HOME/candle_stream; late prices are kept beside them."""
    home = f"{run.home}/candle_stream"
    before = open_candles(run.spark, home).count()
    run.counts["late prices"] = load_candle_stream(run.spark, run.options.prices, PRICE_HIST, home, run.options.delay)
    return open_candles(run.spark, home).count() - before


def categories(run: Run) -> int:
    """Facts of dollar pairs by category, with their times and currencies."""
    known = files.read_csv(run.spark, run.options.categories, DIM_CATEGORY)
    prices = loads.open_prices(run.spark, run.home)
    added, rejected = loads.load_categories(run.spark, prices, *run.master(), known, f"{run.home}/categories")
    run.reject("unknown_categories", rejected)
    return added


def stage(run: Run) -> int:
    """Staged snapshots of the master tables, the prices and the asset map, and the prices enriched by them."""
    assets, bad = payloads.set_aside(payloads.read_asset_map(run.spark, run.options.assets, multiline=run.options.multiline), "symbol")
    run.reject("assets", bad)
    pair, currency = run.master()
    to = run.options.to
    tables = {"pair": pair, "currency": currency, "prices": loads.open_prices(run.spark, run.home), "assets": assets}
    write_staging(tables, to)
    staged = {name: files.read_staging(run.spark, to, name) for name in tables}
    enriched = star.enriched_prices(staged["prices"], staged["pair"], staged["currency"], staged["assets"])
    return write_staging({"enriched": enriched}, to)["enriched"]


def export(run: Run) -> int:
    """The star tables as CSV."""
    pair, currency = run.master()
    prices, to = loads.open_prices(run.spark, run.home), run.options.to
    export_csv(star.fact_pairs(prices, pair, currency), f"{to}/fact_pairs")
    export_csv(star.export_dim_time(prices), f"{to}/dim_time")
    export_csv(star.dim_currency(currency), f"{to}/dim_currency")
    return 0


JOBS = {
    master: ("tickers", "quotes", "home"),
    history: ("candles", "home"),
    backfill: ("candles", "home"),
    daily: ("tickers", "quotes", "home"),
    bridge: ("home",),
    stream: ("prices", "home"),
    candles: ("prices", "home"),
    categories: ("categories", "home"),
    stage: ("assets", "home", "to"),
    export: ("home", "to"),
}


def run(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marketlake")
    commands = parser.add_subparsers(required=True)
    for job, needed in JOBS.items():
        command = commands.add_parser(job.__name__, help=job.__doc__)
        command.set_defaults(job=job)
        for name in needed:
            command.add_argument(f"--{name}", required=True)
        command.add_argument("--shuffle-bytes", type=int)
        command.add_argument("--moment")
        command.add_argument("--markets")
        command.add_argument("--multiline", action="store_true")
        command.add_argument("--delay", default="1 day")
    options = parser.parse_args(arguments)
    spark = build_session()
    for key, value in shuffle_settings(options.shuffle_bytes).items() if options.shuffle_bytes else ():
        spark.conf.set(key, value)
    one = Run(spark, options)
    with scratch(spark):
        added = options.job(one)
    print(f"{options.job.__name__} {one.moment}: {added} rows added" + "".join(f", {n} {what}" for what, n in one.counts.items()))
    return added


if __name__ == "__main__":
    run()
