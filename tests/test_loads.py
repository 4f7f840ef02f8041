"""Loads that run twice, fail half-way, or get their rows late."""

import json
import os
import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake import jobs, schemas
from marketlake.operators import sinks, upsert
from marketlake.operators.incremental import at_or_before_mark, high_water_mark
from marketlake.plans import loads, normalise, reports, star
from marketlake.session import build_session, new_folder, shared_folder
from marketlake.sources import files
from marketlake.sources.literals import literal_rows, no_rows
from marketlake.streaming import price_stream
from marketlake.streaming.price_stream import load_new_files

# Sample prices.
FACTS = [(16, 3, "0.02880000"), (16, 2, "1986.47000000"), (15, 1, "68989.47000000"), (17, 5, "85.94000000"), (16, 4, "618.22000000")]


def at(second):
    return datetime(2026, 2, 16, 10, 58, second)


def facts(spark, rows):
    return literal_rows(spark, schemas.FACT_PRICE, [(str(at(s)), p, 1, x) for s, p, x in rows])


def pairs_in(frame):
    return sorted(r.PAIR_ID for r in frame.collect())


def test_late_rows_and_ties(spark):
    home = new_folder(spark, "test")
    assert loads.load_facts(spark, facts(spark, FACTS[-1:]), home) == 1  # the one at :16
    table = loads.open_fact(spark, home)
    assert high_water_mark(table, "TIME_ID") == high_water_mark(table, "TIME_ID", sinks.DAY) == at(16)
    assert high_water_mark(table, "TIME_ID", sinks.DAY, f"{home}/fact_price") == at(16)
    late = at_or_before_mark(facts(spark, FACTS), table, schemas.FACT_KEY, at(16), "TIME_ID")
    assert pairs_in(late) == [1, 2, 3]

    marked = new_folder(spark, "test")
    loads.load_facts(spark, facts(spark, FACTS[-1:]), marked)
    assert loads.load_facts_after_mark(spark, facts(spark, FACTS), marked) == 1  # only the one at :17
    assert loads.load_facts_after_mark(spark, facts(spark, FACTS), marked) == 0

    assert loads.load_facts(spark, facts(spark, FACTS), home) == 4
    assert loads.load_facts(spark, facts(spark, FACTS), home) == 0
    assert pairs_in(loads.open_fact(spark, home)) == [1, 2, 3, 4, 5]
    times = loads.open_dim_time(spark, home).collect()
    assert sorted(r.TIME_ID for r in times) == [at(15), at(16), at(17)]
    assert {(r.DAY, r.MONTH, r.YEAR, r.QUARTER, r.HOUR, r.MINUTE) for r in times} == {(16, 2, 2026, 1, 10, 58)}
    assert loads.load_facts(spark, no_rows(spark, schemas.FACT_PRICE), home) == 0


def test_a_load_that_stopped_after_the_times_is_finished_by_the_next(spark):
    home = new_folder(spark, "test")
    batch = facts(spark, FACTS)
    loads.add_times(spark, batch, home, loads.extent(batch, "TIME_ID"))
    assert loads.load_facts(spark, batch, home) == 5
    assert loads.open_dim_time(spark, home).count() == 3


def test_every_distinct_price_is_a_fact(spark):
    home = new_folder(spark, "test")
    assert loads.load_facts(spark, facts(spark, [(15, 1, "2"), (15, 1, "1"), (15, 1, "2"), (15, 2, "3")]), home) == 3
    assert loads.load_facts(spark, facts(spark, [(15, 1, "0.5"), (15, 1, "1")]), home) == 1
    assert sorted(r.PRICE for r in loads.open_fact(spark, home).collect()) == [Decimal("0.5"), Decimal(1), Decimal(2), Decimal(3)]


def test_null_keys_are_loaded_once(spark):
    home = new_folder(spark, "test")
    rows = [(1, "5", str(at(1)), None), (1, "5", None, "a"), (2, "6", None, None), (2, "6", str(at(1)), "a")]
    prices = literal_rows(spark, schemas.PRICES, rows)
    assert [loads.append_prices(spark, prices, home) for _ in range(2)] == [4, 0]
    assert loads.append_prices(spark, prices.filter("Timestamp IS NULL"), home) == 0
    assert [loads.bridge_prices(spark, home) for _ in range(2)] == [4, 0]
    sources = {r.SOURCE_NAME: r.SOURCE_ID for r in loads.open_sources(spark, home).collect()}
    assert sources == {"Binance": 1, "CoinMarketCap": 2, "a": 3, star.UNKNOWN_SOURCE: 4}
    found = sorted((r.PAIR_ID, r.SOURCE_ID, str(r.TIME_ID)) for r in loads.open_fact(spark, home).collect())
    assert found == [(1, 3, "None"), (1, 4, str(at(1))), (2, 3, str(at(1))), (2, 4, "None")]


def test_no_price_is_left_out_for_its_source(spark):
    rows = [(1, "5", str(at(1)), "Binance"), (1, "6", str(at(2)), "other"), (1, "7", str(at(3)), None)]
    facts_ = star.fact_price(literal_rows(spark, schemas.PRICES, rows), star.seed_sources(spark)).collect()
    assert sorted((r.PRICE, r.SOURCE_ID) for r in facts_) == [(Decimal(5), 1), (Decimal(6), None), (Decimal(7), None)]


def test_a_report_of_an_empty_table_is_empty(spark):
    prices = sinks.open_by_day(spark, new_folder(spark, "test"), schemas.PRICE_HIST)
    pair = no_rows(spark, schemas.PAIR)
    assert reports.latest_against_reference(prices, pair, no_rows(spark, schemas.CURRENCY), 5, day=sinks.DAY).collect() == []


def test_only_the_days_of_the_batch_are_read(spark, capsys):
    home = new_folder(spark, "test")
    loads.load_facts(spark, facts(spark, FACTS), home)
    fresh = loads.not_loaded(facts(spark, FACTS), loads.open_fact(spark, home), schemas.FACT_KEY[:3], "TIME_ID", sinks.DAY)
    fresh.explain()
    scan = next(line for line in capsys.readouterr().out.splitlines() if "FileScan" in line and "event_date" in line)
    assert "event_date" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "GreaterThanOrEqual(TIME_ID" in scan and "PRICE" not in scan.split("ReadSchema:")[1]


def test_newest_rows_come_from_the_newest_day_if_it_has_enough(spark, capsys):
    rows = [(i, 1, "5", f"2024-01-0{1 + i // 4} 10:00:0{i % 4}", "a") for i in range(8)] + [(8, 2, "6", "2024-01-02 11:00:00", "a")]
    folder = new_folder(spark, "test")
    sinks.append_by_day(literal_rows(spark, schemas.PRICE_HIST, rows), folder, "Timestamp")
    prices = sinks.open_by_day(spark, folder, schemas.PRICE_HIST)
    pair = spark.createDataFrame([(1, "ETHBTC", "A", 1, 2)], "Pair_ID int, Pair_Name string, Manual_Category string, Base_Currency_ID int, Quote_Currency_ID int")
    currency = spark.createDataFrame([(1, "ETH", Decimal(2)), (2, "BTC", None)], "Currency_ID int, Currency_Name string, Global_Price_USD decimal(20,8)")
    for count, read in ((4, 1), (6, 2)):  # the price of the unknown pair on the newest day does not count
        got = reports.latest_against_reference(prices, pair, currency, count, day=sinks.DAY)
        assert [r.Price_Hist_ID for r in got.collect()] == list(range(7, 7 - count, -1))
        assert {(r.Price_Difference, r.comparable) for r in got.collect()} == {(Decimal(3), False)}
        got.explain()
        scan = next(line for line in capsys.readouterr().out.splitlines() if "FileScan" in line)
        assert ("event_date" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]) == (read == 1)


# --- versions ---------------------------------------------------------------------------------
def test_publish_switches_only_after_all_writes(spark):
    folder = new_folder(spark, "test")
    one, two = "one_" + folder[-8:], "two_" + folder[-8:]
    assert sinks.publish({one: spark.range(3), two: spark.range(4)}, folder) == {one: 3, two: 4}
    before = spark.table(one)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.publish({one: spark.range(9), two: broken}, folder)
    assert (spark.table(one).count(), spark.table(two).count()) == (3, 4)
    # A new version may be made from the current one; who reads the old one still can.
    sinks.publish({one: spark.table(one).unionAll(spark.table(one))}, folder)
    assert (spark.table(one).count(), before.count()) == (6, 3)
    # A session that has not seen the views finds the current versions, too.
    schema = spark.range(1).schema
    assert sinks.current(spark, one, schema, folder).count() == 6
    assert sinks.current(spark, two, schema, folder).count() == 4
    assert sinks.current(spark, "three", schema, folder).count() == 0
    assert one in {t.name for t in spark.catalog.listTables()}
    assert [r.col_name for r in spark.sql(f"DESCRIBE {one}").collect()] == ["id"]


def test_reload_replaces_and_keeps_repeats_unless_asked(spark):
    folder = new_folder(spark, "test")
    rows = [(1, "5", str(at(1)), "a"), (1, "4", str(at(1)), "b"), (2, "3", str(at(1)), "a")]
    history = literal_rows(spark, schemas.PRICES, rows)
    assert loads.reload_history(history, folder) == 3
    assert loads.reload_history(history, folder) == 3 and loads.open_prices(spark, folder).count() == 3
    assert loads.reload_history(history, folder, one_per_time=True) == 2


def test_a_reload_replaces_the_facts(spark):
    home = new_folder(spark, "test")
    old = literal_rows(spark, schemas.PRICES, [(1, "5", str(at(1)), "a"), (2, "3", str(at(1)), "a")])
    new = literal_rows(spark, schemas.PRICES, [(1, "6", str(at(1)), "a"), (2, "3", str(at(1)), "a")])
    loads.append_prices(spark, old, home)
    assert loads.bridge_prices(spark, home) == 2
    loads.reload_history(new, home)
    assert [loads.bridge_prices(spark, home) for _ in range(2)] == [2, 0]
    found = loads.open_fact(spark, loads.star_folder(spark, home)).collect()
    assert sorted((r.PAIR_ID, r.PRICE) for r in found) == [(1, Decimal(6)), (2, Decimal(3))]


def test_staging_and_append(spark):
    folder = new_folder(spark, "test")
    for _ in range(2):
        assert sinks.write_staging({"prices": spark.range(5), "pairs": spark.range(2)}, folder) == {"prices": 5, "pairs": 2}
    assert spark.read.parquet(f"{folder}/prices").count() == 5
    assert [sinks.append(spark.range(2), f"{folder}/log") for _ in range(2)] == [2, 2]
    assert spark.read.parquet(f"{folder}/log").count() == 4


def test_a_day_is_clustered_and_sorted_by_time(spark, capsys):
    start = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    frame = spark.range(2000).select("id", F.timestamp_add("MINUTE", -(F.col("id") * 7919 % 2000), start).alias("t"))
    sinks.by_day(frame, "t").explain()
    text = capsys.readouterr().out
    assert "REBALANCE" in text and len(re.findall(r"Sort \[event_date#\d+ ASC NULLS FIRST, t#", text)) == 1
    folder = new_folder(spark, "test")
    sinks.append_by_day(frame, folder, "t")
    for day in ("2023-12-31", "2024-01-01"):
        times = [r.t for r in spark.read.parquet(f"{folder}/event_date={day}").collect()]
        assert times and times == sorted(times)


def test_a_day_with_most_rows_is_written_in_parts(spark):
    folder = new_folder(spark, "test")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "64k")
    try:
        day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("timestamp_ntz")
        frame = spark.range(200_000).select(F.xxhash64("id").alias("x"), day.alias("t"))
        assert sinks.append_by_day(frame, folder, "t") == 200_000
    finally:
        spark.conf.set(advisory, before)
    files = spark.read.parquet(folder).select("event_date", F.input_file_name().alias("f")).distinct()
    assert dict(files.groupBy(F.col("event_date").cast("string")).count().collect())["2024-01-01"] > 1


# --- master data and the scheduled run --------------------------------------------------------
TICKERS = [("BTCUSDT", "75152.82"), ("ETHUSDT", "2199.2"), ("ETHBTC", "0.02928"), ("ADAUSDT", "0"), ("FOOUSDT", "1")]
QUOTES = [("BTC", ["layer-1"], "75000"), ("ETH", [], "2200"), ("ADA", ["defi", "layer-1"], None), ("USDT", ["stablecoin"], "1")]


def landed(spark, tickers=TICKERS, quotes=QUOTES):
    return (
        spark.createDataFrame(tickers, "symbol string, price string"),
        spark.createDataFrame([(s, t, p and Decimal(p)) for s, t, p in quotes], "symbol string, Raw_Tags array<string>, Global_Price_USD decimal(20,8)"),
    )


def test_master_load_and_scheduled_run(spark):
    home = new_folder(spark, "test")
    currency, pair = "currency_" + home[-8:], "pair_" + home[-8:]
    args = (home, currency, pair)
    tickers, quotes = landed(spark)
    assert loads.load_master(spark, normalise.only_markets(tickers), quotes, *args, moment=at(1)) == 4
    first = {r.Currency_Name: r for r in spark.table(currency).collect()}
    assert {n: r.Asset_Type for n, r in first.items()} == {"BTC": "crypto", "ETH": "crypto", "USDT": "stablecoin", "ADA": "token"}
    assert len({r.Currency_ID for r in first.values()}) == 4
    assert {r.Pair_Name: r.Manual_Category for r in spark.table(pair).collect()} == {
        "BTCUSDT": "Layer 1 & Layer 2", "ETHUSDT": "To be defined", "ETHBTC": "To be defined",
        "ADAUSDT": "DeFi (Decentralized Finance), Layer 1 & Layer 2"}
    for r in spark.table(pair).collect():
        assert r.Pair_Name == {v.Currency_ID: k for k, v in first.items()}[r.Base_Currency_ID] + {
            v.Currency_ID: k for k, v in first.items()}[r.Quote_Currency_ID]

    # The next load: a new price for ETH, no quote for BTC, a new market.
    tickers, quotes = landed(spark, TICKERS[:2] + [("SOLUSDT", "90")], [("ETH", ["defi"], "2300"), ("SOL", ["nope"], "91")])
    assert loads.load_master(spark, tickers, quotes, *args, moment=at(2)) == 3
    second = {r.Currency_Name: r for r in spark.table(currency).collect()}
    assert {n: r.Currency_ID for n, r in second.items() if n in first} == {n: r.Currency_ID for n, r in first.items()}
    assert second["ETH"].Global_Price_USD == Decimal(2300) and second["BTC"].Global_Price_USD is None
    assert second["ADA"] == first["ADA"] and second["SOL"].Asset_Type == "crypto"
    categories = {r.Pair_Name: r.Manual_Category for r in spark.table(pair).collect()}
    assert categories["ETHUSDT"] == "DeFi (Decentralized Finance)" and categories["SOLUSDT"] == "Other / Not Mapped"
    assert loads.open_prices(spark, home).count() == 7
    # Once more for the same time, without any quote: prices are there already, and what was known stays.
    assert loads.load_master(spark, tickers, quotes.limit(0), *args, moment=at(2), keep_existing_on_null=True) == 0
    assert {r.Currency_Name: r for r in spark.table(currency).collect()} == second
    assert loads.open_prices(spark, home).count() == 7

    # The scheduled run, twice for the same moment: both sources, without the zero price. The day's
    # earlier history, the seven prices of the master loads, is bridged with it.
    tickers, quotes = landed(spark)
    for added in (7 + 6, 0):
        assert loads.daily_run(
            spark, tickers, quotes, spark.table(pair), spark.table(currency), home, at(30), view="dim_pair_" + home[-8:]
        ) == added
    names = {r.Pair_ID: r.Pair_Name for r in spark.table(pair).collect()}
    got = sorted((names[r.PAIR_ID], r.SOURCE_ID, r.PRICE) for r in loads.open_fact(spark, home).filter(F.col("TIME_ID") == F.lit(str(at(30))).cast("timestamp_ntz")).collect())
    assert got == [
        ("BTCUSDT", 1, Decimal("75152.82")), ("BTCUSDT", 2, Decimal(75000)), ("ETHBTC", 1, Decimal("0.02928")),
        ("ETHBTC", 2, Decimal(2200)), ("ETHUSDT", 1, Decimal("2199.2")), ("ETHUSDT", 2, Decimal(2200))]
    assert spark.table("dim_pair_" + home[-8:]).columns == schemas.DIM_PAIR.names


def test_stored_tables_have_the_stated_types(spark):
    home = new_folder(spark, "test")
    names = [f"{t}_{home[-8:]}" for t in ("currency", "pair")]
    loads.load_master(spark, *landed(spark), home, *names, moment=at(1))
    for name, schema in zip(names, (schemas.CURRENCY, schemas.PAIR)):
        assert spark.table(name).dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    assert loads.open_fact(spark, home).drop(sinks.DAY).dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.FACT_PRICE]


def test_missing_and_unpriced_markets(spark):
    tickers, quotes = landed(spark)
    pair = spark.createDataFrame([(1, "BTCUSDT"), (2, "ADAUSDT"), (3, "DOTUSDT"), (4, "XRPUSDT")], "Pair_ID int, Pair_Name string")
    got = normalise.delta_prices(tickers, quotes, pair, at(1))
    assert sorted((r.Pair_ID, r.Source) for r in got.collect()) == [(1, "Binance"), (1, "CoinMarketCap")]


# --- the stream -------------------------------------------------------------------------------
def test_stream_survives_a_failed_run_and_skips_seen_files(spark, monkeypatch):
    home = new_folder(spark, "test")
    landing, star_home, checkpoint = f"{home}/landing", f"{home}/star", f"{home}/checkpoint"
    facts(spark, FACTS[:3]).write.mode("append").parquet(landing)

    def run(files_per_batch=1000):
        return load_new_files(
            spark, landing, schemas.FACT_PRICE, lambda rows: rows, star_home, checkpoint, files_per_batch
        )

    def load_and_lose(*args):
        # The facts get in, and the batch fails before it is committed.
        loads.load_facts(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(price_stream, "load_facts", load_and_lose)
        with pytest.raises(Exception, match="lost"):
            run()
    assert run() == 0
    assert pairs_in(loads.open_fact(spark, star_home)) == [1, 2, 3]
    facts(spark, FACTS[2:]).write.mode("append").parquet(landing)
    assert run(files_per_batch=1) == 2
    assert run() == 0
    assert pairs_in(loads.open_fact(spark, star_home)) == [1, 2, 3, 4, 5]


# --- the jobs ---------------------------------------------------------------------------------
@pytest.fixture
def payload_files(spark, tmp_path):
    """Landed payloads, a home folder, and the options that name the payloads."""
    def quote_file(name, quotes):
        data = {s: {"tags": t, "quote": {"USD": {"price": p and float(p)}}} for s, t, p in quotes}
        (tmp_path / name).write_text(json.dumps({"data": data}))

    (tmp_path / "tickers").mkdir()
    (tmp_path / "quotes").mkdir()
    (tmp_path / "tickers" / "a.json").write_text(json.dumps([{"symbol": s, "price": p} for s, p in TICKERS]))
    quote_file("quotes/a.json", QUOTES)
    (tmp_path / "candles" / "symbol=ETHBTC").mkdir(parents=True)
    candles = [[1704067200000 + d * 86_400_000, *["1"] * 3, f"0.0{d + 1}", "1", 1704153599999, *["1"] * 5] for d in range(3)]
    (tmp_path / "candles" / "symbol=ETHBTC" / "c.json").write_text(json.dumps(candles))
    landed_files = ["--tickers", str(tmp_path / "tickers"), "--quotes", str(tmp_path / "quotes")]
    return tmp_path, new_folder(spark, "test"), landed_files, quote_file


def facts_of(spark, home):
    return loads.open_fact(spark, loads.star_folder(spark, home))


def test_jobs_from_landed_files_to_exports(spark, payload_files):
    tmp_path, home, landed_files, _ = payload_files
    moment = ["--moment", "2019-12-31 00:00:00"]
    assert [jobs.run(["master", *landed_files, "--home", home, *moment]) for _ in range(2)] == [4, 0]
    given = ["--candles", str(tmp_path / "candles"), "--home", home]
    for added in (3, 0):
        assert jobs.run(["backfill", *given]) == added
    assert loads.open_prices(spark, home).count() == 4 + 3
    for _ in range(2):
        assert jobs.run(["history", *given]) == 3
    assert loads.open_prices(spark, home).count() == 3
    assert jobs.run(["backfill", *given]) == 0
    for added in (3 + 6, 0):
        assert jobs.run(["daily", *landed_files, "--home", home, "--moment", "2020-01-01 00:00:00"]) == added
    assert jobs.run(["bridge", "--home", home]) == 0
    jobs.run(["export", "--home", home, "--to", str(tmp_path / "out")])
    out = files.read_star_export(spark, str(tmp_path / "out"))
    assert out["fact_pairs"].count() == 3 + 6
    assert out["dim_time"].count() == 3 + 1 and out["dim_currency"].count() == 4
    (tmp_path / "categories.csv").write_text("CATEGORY_ID,CATEGORY_NAME\n1,To be defined\n")
    assert [jobs.run(["categories", "--categories", str(tmp_path / "categories.csv"), "--home", home]) for _ in range(2)] == [2, 0]
    (tmp_path / "assets.json").write_text('{"id": 1, "symbol": "ETH", "name": "Ether", "rank": 2}\n{"id": 2, "sym')
    assert jobs.run(["stage", "--assets", str(tmp_path / "assets.json"), "--home", home, "--to", str(tmp_path / "staged")]) == 9
    assert spark.read.parquet(f"{home}/rejects/stage/assets").count() == 1
    with pytest.raises(SystemExit):
        jobs.run(["daily", "--home", home])


def test_master_history_and_a_failed_day_are_all_bridged(spark, payload_files, monkeypatch):
    tmp_path, home, landed_files, _ = payload_files
    day = lambda d: ["daily", *landed_files, "--home", home, "--moment", f"2026-03-0{d} 00:00:00"]
    assert jobs.run(["master", *landed_files, "--home", home, "--moment", "2026-03-01 00:00:00"]) == 4
    assert jobs.run(["backfill", "--candles", str(tmp_path / "candles"), "--home", home]) == 3
    assert jobs.run(day(2)) == 4 + 3 + 6
    with monkeypatch.context() as patch:
        patch.setattr(loads, "load_facts", lambda *args: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            jobs.run(day(3))
    assert jobs.run(day(4)) == 6 + 6
    assert facts_of(spark, home).count() == loads.open_prices(spark, home).count() == 7 + 18


def test_payloads_that_landed_twice_give_one_row_per_name(spark, payload_files):
    tmp_path, home, landed_files, quote_file = payload_files
    (tmp_path / "tickers" / "b.json").write_text((tmp_path / "tickers" / "a.json").read_text())
    quote_file("quotes/b.json", [("BTC", ["defi"], "76000")])
    os.utime(tmp_path / "quotes" / "a.json", (1, 1))
    for moment in ("2026-03-01 00:00:00", "2026-03-02 00:00:00"):
        jobs.run(["master", *landed_files, "--home", home, "--moment", moment])
        currency = sinks.current(spark, "currency", schemas.CURRENCY, home).collect()
        assert sorted(r.Currency_Name for r in currency) == ["ADA", "BTC", "ETH", "USDT"]
        assert {r.Currency_Name: r.Global_Price_USD for r in currency}["BTC"] == Decimal(76000)
        assert sinks.current(spark, "pair", schemas.PAIR, home).count() == 4


def test_an_upsert_refuses_repeated_keys(spark):
    existing = spark.createDataFrame([(1, "a", 1)], "id int, name string, x int")
    for names in (["a", "a"], ["b", "b"]):
        incoming = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, x int")
        with pytest.raises(Exception, match="more than one incoming row"):
            upsert.upsert(existing, incoming, "name", ["x"]).collect()
        with pytest.raises(Exception, match="more than one incoming row"):
            upsert.upsert_with_ids(existing, incoming, "name", ["x"], "id").collect()


def test_what_a_run_leaves_out_is_kept_and_counted(spark, payload_files, capsys):
    tmp_path, home, landed_files, quote_file = payload_files
    jobs.run(["master", *landed_files, "--home", home, "--moment", "2026-03-01 00:00:00"])
    before = sorted(sinks.current(spark, "currency", schemas.CURRENCY, home).collect())
    (tmp_path / "tickers" / "bad.json").write_text('{"symbol": "ETH\n{"price": "2.0"}\n')
    (tmp_path / "tickers" / "new.json").write_text('{"symbol": "DOTUSDT", "price": "2.0"}\n')
    (tmp_path / "candles" / "symbol=XRPBTC").mkdir()
    (tmp_path / "candles" / "symbol=XRPBTC" / "c.json").write_text('[["1704067200000", "1", "1", "1", "1"]]')
    (tmp_path / "candles" / "symbol=ETHBTC" / "bad.json").write_text("{broken")
    capsys.readouterr()
    jobs.run(["daily", *landed_files, "--home", home, "--moment", "2026-03-02 00:00:00"])
    jobs.run(["history", "--candles", str(tmp_path / "candles"), "--home", home])
    daily, history = capsys.readouterr().out.strip().splitlines()
    assert "2 tickers" in daily and "0 quotes" in daily and "1 unknown_symbols" in daily
    assert "1 candles," in history and "1 unknown_symbols" in history and "3 candles of ETHBTC" in history
    assert [r.symbol for r in spark.read.parquet(f"{home}/rejects/daily/unknown_symbols").collect()] == ["DOTUSDT"]
    assert [r.value for r in spark.read.parquet(f"{home}/rejects/history/candles").collect()] == ["{broken"]
    # Quotes that were written over several lines do not parse by line: nothing is loaded, prices stay.
    (tmp_path / "quotes" / "a.json").write_text(json.dumps({"data": {"BTC": {"tags": ["defi"]}}}, indent=1))
    with pytest.raises(SystemExit, match="none could be parsed"):
        jobs.run(["master", *landed_files, "--home", home])
    assert sorted(sinks.current(spark, "currency", schemas.CURRENCY, home).collect()) == before


def test_landed_files_are_read_once(spark, payload_files, monkeypatch):
    """The frames that a job hands on read stored rows, not the landed files again."""
    tmp_path, home, landed_files, _ = payload_files
    jobs.run(["master", *landed_files, "--home", home])
    seen = []

    def load(spark_, frame, *rest, **options):
        seen.append(frame._jdf.queryExecution().toString())
        return 0

    monkeypatch.setattr(loads, "append_prices", load)
    monkeypatch.setattr(loads, "load_master", load)
    jobs.run(["backfill", "--candles", str(tmp_path / "candles"), "--home", home])
    jobs.run(["master", *landed_files, "--home", home])
    assert len(seen) == 2 and not any(x in plan for plan in seen for x in ("FileScan text", "FileScan json"))


def test_jobs_leave_no_intermediate_folder(spark, payload_files):
    tmp_path, home, landed_files, _ = payload_files
    work = shared_folder(spark).removeprefix("file:") + "/marketlake"
    before = set(os.listdir(work)) if os.path.isdir(work) else set()
    jobs.run(["master", *landed_files, "--home", home, "--markets", "all", "--shuffle-bytes", "1000"])
    jobs.run(["daily", *landed_files, "--home", home, "--markets", "FOOUSDT"])
    after = set(os.listdir(work)) - {os.path.basename(home)}
    assert after <= before
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sinks.current(spark, "pair", schemas.PAIR, home).filter("Pair_Name = 'FOOUSDT'").count() == 1
    assert facts_of(spark, home).count() == 5 + 1


# --- settings ---------------------------------------------------------------------------------
def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert build_session() is not None and spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_without_a_shared_folder_nothing_is_written(spark, monkeypatch):
    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session names a folder")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(spark)
