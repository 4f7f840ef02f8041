"""Payload and file readers, on small files with the shapes that are landed."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.temporal import as_of
from marketlake.functions.values import to_price
from marketlake.operators import sinks
from marketlake.plans import normalise, star
from marketlake.sources import files, jdbc, payloads
from marketlake.sources.literals import literal_rows, no_rows

# Sample prices.
TICKERS = [
    ("BTCUSDT", "75152.82000000"), ("ETHUSDT", "2199.20000000"), ("ETHBTC", "0.02928000"),
    ("BNBUSDT", "742.24000000"), ("SOLUSDT", "94.17000000"),
]


def test_ticker_list_in_one_line_or_many(spark, tmp_path):
    records = [{"symbol": s, "price": p} for s, p in TICKERS]
    for name, indent in (("line", None), ("pretty", 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps(records, indent=indent))
        frame = payloads.read_tickers(spark, str(tmp_path / f"{name}.json"), multiline=indent is not None)
        good, bad = payloads.set_aside(frame, "symbol")
        assert sorted(map(tuple, good.collect())) == sorted(TICKERS)
        assert bad.count() == 0


def test_bad_tickers_are_kept_apart(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"symbol": "BTCUSDT", "price": "1.0"}\n{"symbol": "ETH\n{"price": "2.0"}\n')
    good, bad = payloads.set_aside(payloads.read_tickers(spark, str(tmp_path / "t.json")), "symbol")
    assert [tuple(r) for r in good.collect()] == [("BTCUSDT", "1.0")]
    assert bad.count() == 2


def test_quotes_with_missing_parts(spark, tmp_path):
    payload = {"status": {"error_code": 0}, "data": {
        "BTC": {"id": 1, "tags": ["mineable", "pow"], "quote": {"USD": {"price": 75100.123456789}}},
        "ADA": {"quote": {"EUR": {"price": 1.0}}},
        "DOT": {"tags": []},
    }}
    (tmp_path / "q.json").write_text(json.dumps(payload, indent=1))
    rows = payloads.flatten_quotes(payloads.read_quotes(spark, str(tmp_path / "q.json"), multiline=True)).collect()
    assert {r.symbol: (r.Raw_Tags, r.Global_Price_USD) for r in rows} == {
        "BTC": (["mineable", "pow"], Decimal("75100.12345679")), "ADA": ([], None), "DOT": ([], None)}


def test_asset_map_with_and_without_envelope(spark, tmp_path):
    assets = [{"id": 1, "symbol": "BTC", "name": "Bitcoin", "rank": 1, "platform": {"id": 2}},
              {"id": 9, "symbol": "BTC", "name": "Other", "rank": None}]
    (tmp_path / "list.json").write_text(json.dumps(assets))
    (tmp_path / "env.json").write_text(json.dumps({"data": assets}))
    expected = [(1, "BTC", "Bitcoin", 1), (9, "BTC", "Other", None)]
    (tmp_path / "broken.json").write_text('{"data": [{"id": 1}\n')
    for name, enveloped in (("list", False), ("env", True)):
        for broken in (0, 1):
            paths = str(tmp_path / f"{name}.json") if not broken else str(tmp_path / "{" f"{name},broken" "}.json")
            good, bad = payloads.set_aside(payloads.read_asset_map(spark, paths, enveloped), "symbol")
            assert sorted(map(tuple, good.collect()), key=str) == expected and bad.count() == broken


def test_candles_to_history(spark, tmp_path):
    day = 86_400_000
    for symbol in ("BTCUSDT", "XRPUSDT"):
        folder = tmp_path / f"symbol={symbol}"
        folder.mkdir()
        candles = [[1704067200000 + d * day, "1", "2", "0.5", f"{10 + d}.5", "9", 1704067200000 + (d + 1) * day - 1, "0", 3, "0", "0", "0"]
                   for d in range(3)]
        (folder / "candles.json").write_text(json.dumps(candles))
    candles = payloads.parse_candles(payloads.read_candles(spark, str(tmp_path)))
    assert candles.count() == 6 and set(schemas.CANDLE_FIELDS) < set(candles.columns)
    pair = spark.createDataFrame([(7, "BTCUSDT")], "Pair_ID int, Pair_Name string")
    rows = sorted(map(tuple, normalise.history_rows(candles, pair).collect()))
    assert rows[0] == (7, Decimal("10.50000000"), datetime(2024, 1, 1)) and len(rows) == 3
    closed = normalise.history_rows(candles, pair, stamp="close_time").agg(F.min("Timestamp")).first()[0]
    assert closed == datetime(2024, 1, 1, 23, 59, 59, 999000)


def test_ticker_extract_file(spark, tmp_path):
    landed = spark.createDataFrame(TICKERS, "symbol string, price string")
    extract = landed.select("symbol", to_price(F.col("price")), as_of("2026-02-04 15:51:49")).toDF("Symbol", "Price", "Retrieval_Timestamp")
    sinks.export_csv(extract, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    again = files.read_csv(spark, str(tmp_path / "out"), schemas.TICKER_EXTRACT)
    assert sorted(map(tuple, again.collect())) == sorted((s, Decimal(p), datetime(2026, 2, 4, 15, 51, 49)) for s, p in TICKERS)
    # The form that other tools write: a space between date and time.
    (tmp_path / "given.csv").write_text("Symbol,Price,Retrieval_Timestamp\nBTCUSDT,75152.82000000,2026-02-04 15:51:49\n")
    given = files.read_ticker_extract(spark, str(tmp_path / "given.csv")).collect()
    assert [tuple(r) for r in given] == [("BTCUSDT", Decimal("75152.82000000"), datetime(2026, 2, 4, 15, 51, 49))]


# A sample of the exported star tables.
CURRENCIES = [(1, "BTC", "crypto"), (2, "USDT", "stablecoin"), (3, "ETH", "crypto"), (7, "BNB", "crypto"), (9, "SOL", "crypto")]
PAIRS = [(1, "BTCUSDT", 1, 2), (2, "ETHUSDT", 3, 2), (3, "ETHBTC", 3, 1), (4, "BNBUSDT", 7, 2), (5, "SOLUSDT", 9, 2)]
FACTS = [
    (16, 3, 3, "ETHBTC", "0.02880000"), (16, 3, 2, "ETHUSDT", "1986.47000000"), (15, 1, 1, "BTCUSDT", "68989.47000000"),
    (17, 9, 5, "SOLUSDT", "85.94000000"), (16, 7, 4, "BNBUSDT", "618.22000000"),
]


def test_star_export_reads_back_and_is_rebuilt(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.csv").write_text(text)

    put("dim_currency", "Currency_ID,Currency_Name,Asset_Type\n" + "".join(f"{i},{n},{t}\n" for i, n, t in CURRENCIES))
    put("dim_time", "Timestamp,Year,Month,Day,Quarter\n" + "".join(f"2026-02-16T10:58:{s}.000+01:00,2026,2,16,1\n" for s in (17, 16, 15)))
    put("fact_pairs", "TIME_ID,Currency_ID,Pair_ID,Pair_Name,Price\n" + "".join(
        f"2026-02-16T10:58:{s}.000+01:00,{c},{p},{n},{x}\n" for s, c, p, n, x in FACTS))
    read = files.read_star_export(spark, str(tmp_path))
    prices = read["fact_pairs"].select("Pair_ID", "Price", F.col("TIME_ID").alias("Timestamp"))
    assert prices.filter("Timestamp IS NULL OR Price IS NULL").count() == 0
    pair = spark.createDataFrame(PAIRS, "Pair_ID bigint, Pair_Name string, Base_Currency_ID int, Quote_Currency_ID int")
    currency = read["dim_currency"]

    rebuilt = star.fact_pairs(prices, pair, currency)
    assert sorted(map(tuple, rebuilt.collect())) == sorted(map(tuple, read["fact_pairs"].collect()))
    assert sorted(map(tuple, star.export_dim_time(prices).collect())) == sorted(map(tuple, read["dim_time"].collect()))
    assert sorted(map(tuple, star.dim_currency(currency).collect())) == CURRENCIES

    sinks.export_csv(rebuilt, str(tmp_path / "again/fact_pairs"))
    sinks.export_csv(star.export_dim_time(prices), str(tmp_path / "again/dim_time"))
    sinks.export_csv(currency, str(tmp_path / "again/dim_currency"))
    for name, frame in files.read_star_export(spark, str(tmp_path / "again")).items():
        assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, read[name].collect()))


def test_literal_rows(spark):
    rows = literal_rows(spark, schemas.DIM_SOURCE, star.SOURCE_SEED)
    assert sorted(map(tuple, rows.collect())) == [(1, "Binance"), (2, "CoinMarketCap")]
    assert rows.dtypes == no_rows(spark, schemas.DIM_SOURCE).dtypes == [("SOURCE_ID", "int"), ("SOURCE_NAME", "string")]
    assert no_rows(spark, schemas.FACT_PRICE).count() == literal_rows(spark, schemas.FACT_PRICE, []).count() == 0
    rows.show()
    assert rows.limit(1).count() == 1
    assert rows.select(F.rpad("SOURCE_NAME", 14, " ")).first()[0][-1] == " "


def test_jdbc_options():
    # The readers themselves need a database, which is not started for a test.
    given = {"user": "u", "password": "p", "driver": "d"}
    options = jdbc.read_options("jdbc:x", given)
    assert options["preferTimestampNTZ"] == "true" and options["user"] == "u"
    assert jdbc.slice_options("Price_Hist_ID", 1, 1000, 8) == {
        "partitionColumn": "Price_Hist_ID", "lowerBound": "1", "upperBound": "1001", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.slice_options("Price_Hist_ID", 5, 1, 8)
    assert jdbc.write_options("jdbc:x", "FACT_PRICE", given)["truncate"] == "true"
