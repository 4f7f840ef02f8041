"""Candles, split payloads, exact days, category and source aggregates, and the candle stream."""

import random
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlake import jobs, session
from marketlake.operators import incremental, profile, upsert
from marketlake.operators.sinks import DAY, append_by_day, open_by_day
from marketlake.plans import analysis, candles
from marketlake.schemas import CANDLE_FIELDS, CORRUPT, PRICE_HIST, PRICES
from marketlake.sources import payloads
from marketlake.streaming import candle_stream

TICKS = "Price_Hist_ID long, Pair_ID long, Price decimal(20,8), Timestamp timestamp_ntz, Source string"


def ticks(count=400, seed=1):
    pick = random.Random(seed)
    rows = [
        (k, pick.choice([1, 1, 1, 2, 3]), Decimal(pick.randrange(1, 500)) / 4, datetime(2024, 1, pick.randrange(1, 6), pick.randrange(3)), pick.choice("ab"))
        for k in range(count)
    ]
    return rows + [(900, 1, None, datetime(2024, 1, 1), "a"), (901, 1, Decimal(3), None, "a"), (902, None, Decimal(3), datetime(2024, 1, 1), None)]


def ohlc_of(rows):
    days = {}
    for number, pair, price, time, _ in rows:
        if price is not None and time is not None:
            days.setdefault((pair, time.date()), []).append((time, number, price))
    out = {}
    for key, own in days.items():
        own.sort()
        prices = [p for _, _, p in own]
        out[key] = (prices[0], max(prices), min(prices), prices[-1], len(own))
    return out


def as_dict(frame):
    return {(r.Pair_ID, r.Day): (r.Open, r.High, r.Low, r.Close, r.Trades) for r in frame.collect()}


def test_candles_of_ticks_with_equal_times(spark):
    rows = ticks()
    frame = spark.createDataFrame(rows, TICKS)
    assert as_dict(candles.daily_candles(frame)) == ohlc_of(rows)
    assert candles.daily_candles(frame.filter("false")).collect() == []


def test_parts_of_days_merge_and_a_repeated_batch_counts_once(spark, tmp_path):
    rows = ticks()
    frame = spark.createDataFrame(rows, TICKS)
    assert candles.open_candles(spark, str(tmp_path), frame).collect() == []
    for batch in (0, 1, 2, 1):
        candles.add_candle_parts(frame.filter(F.col("Price_Hist_ID") % 3 == batch), str(tmp_path), str(batch))
    assert as_dict(candles.open_candles(spark, str(tmp_path), frame)) == ohlc_of(rows)


def test_candles_need_one_shuffle_after_partial_aggregation(spark, capsys):
    frame = spark.range(100_000).select(
        F.col("id").alias("Price_Hist_ID"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("Pair_ID"),
        F.lit(1).cast("decimal(20,8)").alias("Price"), F.lit("2024-01-01").cast("timestamp_ntz").alias("Timestamp"),
    )
    candles.daily_candles(frame).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan


def candle(k, close="1.5"):
    return [str(1704067200000 + k), "1", "2", "0", close, "9", "0", "0", k, "0", "0", "0"]


def text_of(value):
    return "[" + ", ".join(f'"{x}"' if isinstance(x, str) else str(x) for x in value) + "]"


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    folder = tmp_path / "symbol=BIG"
    folder.mkdir()
    (folder / "list.json").write_text("[" + ",".join(text_of(candle(k)) for k in range(20_000)) + "]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(200_000))
    try:
        read = payloads.read_candle_list(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 4
        rows = read.select("symbol", CORRUPT, "timestamp", "num_trades").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(int(r.num_trades) for r in rows) == list(range(20_000))
    assert {r.symbol for r in rows} == {"BIG"} and not any(r[CORRUPT] for r in rows)


@pytest.mark.parametrize("layout", ["{0}", "[{0}]", " [\n  {0}\n]\n", "[ {0} ]"])
def test_a_broken_candle_rejects_itself_only(spark, tmp_path, layout):
    good = [text_of(candle(k)) for k in range(4)]
    parts = [good[0], '["1704", "1"]', good[1], '["1", "2", "3", "4", "5', good[2], '["17", null, "1", "1", null]', good[3]]
    (tmp_path / "a.json").write_text(layout.format(" ,\n ".join(parts)))
    (tmp_path / "empty.json").write_text("[]")
    rows = payloads.read_candle_list(spark, str(tmp_path)).collect()
    assert sorted(r.num_trades for r in rows if r[CORRUPT] is None) == ["0", "1", "2", "3"]
    assert sorted(r[CORRUPT] for r in rows if r[CORRUPT] is not None) == sorted(['"1704", "1"', '"1", "2", "3", "4", "5', '"17", null, "1", "1", null'])
    assert rows[0].asDict().keys() == {CORRUPT, *CANDLE_FIELDS}


def test_only_the_days_of_the_batch_are_opened(spark, tmp_path):
    table = str(tmp_path / "prices")
    rows = [(k, Decimal(k), datetime(2024, 1, 1 + k), "a") for k in range(9)]
    frame = spark.createDataFrame(rows, PRICES)
    append_by_day(frame, table, "Timestamp")
    for middle in Path(table).glob("event_date=2024-01-0[2-8]/*.parquet"):
        middle.write_bytes(b"no parquet")  # an error for who opens it
        middle.with_name(f".{middle.name}.crc").unlink(missing_ok=True)
    batch = spark.createDataFrame([rows[0], rows[8], (5, Decimal(5), datetime(2024, 1, 9), "a")], PRICES)
    keys = ["Timestamp", "Pair_ID", "Source"]
    fresh = incremental.not_loaded(batch, open_by_day(spark, table, PRICES), keys, "Timestamp", DAY)
    assert [r.Pair_ID for r in fresh.collect()] == [5]
    assert incremental.extent(batch, "Timestamp").days == (date(2024, 1, 1), date(2024, 1, 9))


def test_too_many_days_fall_back_to_first_and_last(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MOST_DAYS", 1)
    rows = [(k, Decimal(k), datetime(2024, 1, 1 + k), "a") for k in range(5)]
    frame = spark.createDataFrame(rows, PRICES)
    append_by_day(frame.filter("Pair_ID <> 3"), str(tmp_path / "p"), "Timestamp")
    assert incremental.extent(frame, "Timestamp").days is None
    fresh = incremental.not_loaded(frame, open_by_day(spark, str(tmp_path / "p"), PRICES), ["Timestamp", "Pair_ID"], "Timestamp", DAY)
    assert [r.Pair_ID for r in fresh.collect()] == [3]


def test_a_pair_counts_in_each_category_and_once_in_all(spark):
    pair = spark.createDataFrame([(1, "A, B ,A"), (2, "B"), (3, None), (4, " ,")], "Pair_ID int, Manual_Category string")
    rows = [(1, 2, datetime(2024, 1, 5)), (1, 4, datetime(2024, 2, 1)), (2, 10, datetime(2024, 1, 9)), (3, 100, datetime(2024, 1, 1)), (4, 7, datetime(2024, 1, 1))]
    prices = spark.createDataFrame([(p, Decimal(x), t) for p, x, t in rows], "Pair_ID int, Price decimal(20,8), Timestamp timestamp_ntz")
    found = {(r.category, r.month, r.level): (r.n_prices, int(r.total), int(r.least), int(r.most)) for r in analysis.category_rollup(prices, pair).collect()}
    other = "Other / Not Mapped"
    assert found == {
        ("A", "2024-01", 0): (1, 2, 2, 2), ("A", "2024-02", 0): (1, 4, 4, 4), ("B", "2024-01", 0): (2, 12, 2, 10), ("B", "2024-02", 0): (1, 4, 4, 4),
        (other, "2024-01", 0): (2, 107, 7, 100), ("A", None, 1): (2, 6, 2, 4), ("B", None, 1): (3, 16, 2, 10), (other, None, 1): (2, 107, 7, 100),
        (None, "2024-01", 2): (4, 119, 2, 100), (None, "2024-02", 2): (1, 4, 4, 4), (None, None, 3): (5, 123, 2, 100),
    }


def test_sources_are_aligned_from_both_sides(spark):
    rows = [(1, "100", 1, "x"), (1, "101", 1, "y"), (1, "100", 2, "x"), (1, "150", 3, "y"), (2, "10", 1, "x"), (2, "10", 1, "y"), (2, "0", 2, "x"), (2, "5", 2, "y"), (3, "1", 1, "z")]
    rows += [(10 + k, "100", 1, s) for k in range(20) for s in "xy"] + [(50, "100", 1, "x"), (50, "300", 1, "y")]
    prices = spark.createDataFrame([(k, p, Decimal(v), datetime(2024, 1, d), s) for k, (p, v, d, s) in enumerate(rows)], TICKS)
    found = {(r.Pair_ID, r.Day.day): (r.First_Price, r.Second_Price, r.Gap_Points, r.Outlier) for r in analysis.source_gap(prices, "x", "y", 0.95).collect()}
    assert found[1, 1] == (100, 101, 99, False) and found[1, 2] == (100, None, None, None) and found[1, 3] == (None, 150, None, None)
    assert found[2, 2] == (0, 5, None, None) and found[50, 1] == (100, 300, 10000, True) and (3, 1) not in found and len(found) == 26
    assert analysis.source_gap(prices.filter("false"), "x", "y").collect() == []


def test_candle_stream_over_several_runs(spark, tmp_path):
    landing, home = str(tmp_path / "landing"), str(tmp_path / "home")
    rows = [r for r in ticks() if r[1] is not None]
    frame = spark.createDataFrame(rows, TICKS).select("Price_Hist_ID", "Pair_ID", "Price", "Timestamp")
    assert candle_stream.open_late(spark, home).collect() == []
    for part in (0, 1):
        frame.filter(F.col("Price_Hist_ID") % 2 == part).coalesce(2).write.mode("append").parquet(landing)
        assert candle_stream.load_candle_stream(spark, landing, frame.schema, home, "30 days", files_per_batch=1) == 0
    assert as_dict(candle_stream.open_candles(spark, home)) == ohlc_of(rows)
    assert candle_stream.load_candle_stream(spark, landing, frame.schema, home, "30 days") == 0
    assert as_dict(candle_stream.open_candles(spark, home)) == ohlc_of(rows)


def test_late_prices_are_kept_apart(spark, tmp_path):
    landing, home = str(tmp_path / "landing"), str(tmp_path / "home")
    schema = "Price_Hist_ID long, Pair_ID long, Price decimal(20,8), Timestamp timestamp_ntz"

    def land(*rows):
        frame = spark.createDataFrame([(k, p, Decimal(v), t) for k, p, v, t in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(landing)
        return candle_stream.load_candle_stream(spark, landing, frame.schema, home, "2 days")

    assert land((1, 1, 5, datetime(2024, 1, 10, 12)), (2, 1, 6, datetime(2024, 1, 9))) == 0
    assert land((3, 1, 7, datetime(2024, 1, 8, 1)), (4, 2, 8, datetime(2024, 1, 7, 23)), (5, 1, 9, datetime(2024, 1, 9, 1))) == 1
    assert [(r.Price_Hist_ID, r.Pair_ID) for r in candle_stream.open_late(spark, home).collect()] == [(4, 2)]
    found = as_dict(candle_stream.open_candles(spark, home))
    assert found == {
        (1, date(2024, 1, 10)): (5, 5, 5, 5, 1), (1, date(2024, 1, 9)): (6, 9, 6, 9, 2), (1, date(2024, 1, 8)): (7, 7, 7, 7, 1),
    }


def test_copies_are_found_by_digest_and_compared_as_a_whole(spark, monkeypatch):
    rows = [(1, "a", None)] * 3 + [(1, None, "a")] * 2 + [(None, "1", "a"), (2, "b", "c"), (None, None, None), (None, None, None)]
    frame = spark.createDataFrame(rows, "a int, b string, `c.d` string")
    wanted = {(1, "a", None, 3), (1, None, "a", 2), (None, None, None, 2)}
    assert set(map(tuple, profile.duplicate_rows(frame).collect())) == wanted
    monkeypatch.setattr(profile, "join_dimension", lambda fact, dimension, on, how: fact.join(dimension, on, how))
    assert set(map(tuple, profile.duplicate_rows(frame).collect())) == wanted
    assert profile.duplicate_rows(frame.filter("a = 2")).collect() == []


def test_a_table_without_copies_is_not_shuffled_in_full_width(spark, tmp_path, capsys):
    path = str(tmp_path / "wide")
    spark.range(1000).select("id", F.repeat(F.col("id").cast("string"), 200).alias("wide")).write.parquet(path)
    profile.duplicate_rows(spark.read.parquet(path)).explain()
    plan = capsys.readouterr().out
    # Only the rows whose digests repeat come to the one exchange; the digests were grouped before.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")


def test_only_new_days_are_profiled(spark, tmp_path):
    table, profiles = str(tmp_path / "t"), str(tmp_path / "p")
    rows = [(k, Decimal(k % 40), datetime(2024, 1, 1 + k % 4), None if k % 3 else "s") for k in range(400)]
    frame = spark.createDataFrame(rows, PRICES)
    append_by_day(frame.filter("day(Timestamp) <= 3"), table, "Timestamp")
    assert profile.profile_new_days(spark, table, PRICES, profiles) == 3
    for old in Path(table).glob("event_date=2024-01-0[1-3]/*.parquet"):
        old.write_bytes(b"no parquet")
        old.with_name(f".{old.name}.crc").unlink(missing_ok=True)
    append_by_day(frame.filter("day(Timestamp) = 4"), table, "Timestamp")
    assert profile.profile_new_days(spark, table, PRICES, profiles) == 1
    assert profile.profile_new_days(spark, table, PRICES, profiles) == 0
    found = {r.column: (r.nulls, r.non_null, r.distinct_values) for r in profile.merged_profile(spark, profiles).collect()}
    assert found["Source"] == (266, 134, 1) and found["Pair_ID"][:2] == (0, 400) and abs(found["Pair_ID"][2] - 400) <= 16
    assert abs(found["Price"][2] - 40) <= 2 and found["Timestamp"][2] == 4


def test_hash_ids_are_unique_and_do_not_depend_on_the_order_of_loads(spark):
    names = spark.createDataFrame([(f"n{k}", k) for k in range(60)] + [("n1", 9), (None, 3)], "name string, x int")
    none = names.select("name", F.lit(0).cast("long").alias("id")).filter("false")
    narrow = {r.name: r.id for r in upsert.hash_ids(none, names, "name", "id", bits=7).collect()}
    assert len(narrow) == 60 == len(set(narrow.values())) and max(narrow.values()) < 128
    stored = spark.createDataFrame([(n, narrow[n]) for n in ("n1", "n2")], "name string, id long")
    later = {r.name: r.id for r in upsert.hash_ids(stored, names, "name", "id", bits=7).collect()}
    assert "n1" not in later and len(later) == 58 and not set(later.values()) & {narrow["n1"], narrow["n2"]}
    wide = {r.name: r.id for r in upsert.hash_ids(none, names, "name", "id").collect()}
    part = upsert.hash_ids(none, names.filter("x > 40"), "name", "id")
    rest = upsert.hash_ids(part, names, "name", "id")
    assert {r.name: r.id for r in part.unionByName(rest).collect()} == wide
    with pytest.raises(RuntimeError, match="too few"):
        upsert.hash_ids(none, names, "name", "id", bits=5, most_rounds=6)


def test_stream_jobs_take_new_files_once(spark, tmp_path, capsys):
    home, landing = str(tmp_path / "home"), str(tmp_path / "prices")
    rows = [(k, k % 3, Decimal(k), datetime(2024, 1, 1 + k % 2, k), "Binance") for k in range(1, 13)]
    jobs.run(["bridge", "--home", home])
    for part in (rows[:8], rows[8:], []):
        if part:
            spark.createDataFrame(part, PRICE_HIST).write.mode("append").parquet(landing)
        added = jobs.run(["stream", "--prices", landing, "--home", home])
        assert added == len(part)
    assert jobs.run(["candles", "--prices", landing, "--home", home]) == 6
    assert jobs.run(["candles", "--prices", landing, "--home", home]) == 0
    assert "0 late prices" in capsys.readouterr().out
    found = as_dict(candle_stream.open_candles(spark, f"{home}/candle_stream"))
    assert found == {k: v for k, v in ohlc_of(rows).items()}


def test_settings_of_stored_jobs_are_given_back(spark, tmp_path_factory):
    own, other = session.JOB_SETTINGS
    spark.conf.set(other, "123456")
    try:
        kept = session.stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
        assert kept.count() == 7 and spark.conf.get(own, None) is None and spark.conf.get(other) == "123456"
        with pytest.raises(Exception, match="division|DIVIDE"):
            session.stored(spark.range(3).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("x")), "failed")
        assert spark.conf.get(own, None) is None
    finally:
        spark.conf.unset(other)
