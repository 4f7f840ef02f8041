from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlake.operators import constraints, incremental, joins, profile, ranking, upsert
from marketlake.plans import star

PROPERTY = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# --- metadata, positions ----------------------------------------------------------------------
def test_best_rank_wins_and_unranked_comes_last(spark):
    meta = spark.createDataFrame([(3, "BTC", "c", None), (1, "BTC", "a", 1), (2, "BTC", "b", 4000), (5, "X", "e", 7), (4, "X", "d", 7)],
                                 "id bigint, symbol string, name string, rank int")
    assert rows(star.unique_metadata(meta)) == [(1, "BTC", "a", 1), (4, "X", "d", 7)]


def test_metadata_joins_whatever_the_case(spark):
    prices = spark.createDataFrame([(1, Decimal(5), datetime(2024, 1, 1)), (2, Decimal(6), datetime(2024, 1, 1))],
                                   "Pair_ID int, Price decimal(20,8), Timestamp timestamp_ntz")
    pair = spark.createDataFrame([(1, "BTCUSDT", 1, "A"), (2, "ADAUSDT", 2, "B")], "Pair_ID int, Pair_Name string, Base_Currency_ID int, Manual_Category string")
    currency = spark.createDataFrame([(1, "BTC"), (2, "ADA")], "Currency_ID int, Currency_Name string")
    meta = spark.createDataFrame([(1, "btc", "Bitcoin", 1), (2, "BTC", "Copy", 9)], "id bigint, symbol string, name string, rank int")
    got = star.enriched_prices(prices, pair, currency, meta).select("Currency_Name", "name")
    assert rows(got) == [("ADA", None), ("BTC", "Bitcoin")]


def test_positions_equal_a_single_window(spark):
    # A third of the rows share one price; the id breaks ties.
    data = spark.range(0, 9000, numPartitions=7).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 97).alias("price"))
    got = ranking.with_position(data, F.col("price").desc(), "id")
    window = F.row_number().over(W.orderBy(F.col("price").desc(), "id")) - 1
    expected = data.withColumn("position", window.cast("bigint"))
    assert got.exceptAll(expected).count() == 0 and got.count() == 9000
    assert ranking.with_position(data.limit(0), "id").count() == 0


def test_positions_start_in_the_first_range_when_others_are_empty(spark):
    one = spark.createDataFrame([(4,)], "id bigint")
    assert rows(ranking.with_position(one, "id")) == [(4, 0)]


# --- upsert, insert if absent, ids ------------------------------------------------------------
TABLE = "Currency_ID int, Currency_Name string, Asset_Type string, Global_Price_USD double"
BATCH = "Currency_Name string, Asset_Type string, Global_Price_USD double"


def test_known_rows_take_only_the_update_columns(spark):
    existing = spark.createDataFrame([(1, "BTC", "stablecoin", 1.0), (2, "ADA", "token", 3.0)], TABLE)
    incoming = spark.createDataFrame([("BTC", "crypto", 2.0), ("SOL", "crypto", None)], BATCH)
    got = upsert.upsert(existing, incoming, "Currency_Name", ["Global_Price_USD"])
    assert got.columns == existing.columns
    assert rows(got) == rows(spark.createDataFrame(
        [(1, "BTC", "stablecoin", 2.0), (2, "ADA", "token", 3.0), (None, "SOL", "crypto", None)], TABLE))


def test_incoming_null_replaces_unless_told_otherwise(spark):
    existing = spark.createDataFrame([(1, "BTC", "crypto", 1.0)], TABLE)
    incoming = spark.createDataFrame([("BTC", "crypto", None)], BATCH)
    args = (existing, incoming, "Currency_Name", ["Global_Price_USD"])
    assert upsert.upsert(*args).first().Global_Price_USD is None
    assert upsert.upsert(*args, keep_existing_on_null=True).first().Global_Price_USD == 1.0


names = st.dictionaries(st.sampled_from("ABCDEFGH"), st.floats(0, 9, width=16), max_size=8)


@PROPERTY
@given(names, names)
def test_upsert_again_changes_nothing(spark, known, fresh):
    existing = spark.createDataFrame([(i, n, "old", p) for i, (n, p) in enumerate(known.items())], TABLE)
    incoming = spark.createDataFrame([(n, "new", p) for n, p in fresh.items()], BATCH)
    once = upsert.upsert(existing, incoming, "Currency_Name", ["Global_Price_USD"])
    assert rows(once) == rows(upsert.upsert(once, incoming, "Currency_Name", ["Global_Price_USD"]))
    got = {r.Currency_Name: (r.Asset_Type, r.Global_Price_USD) for r in once.collect()}
    assert got == {n: ("old" if n in known else "new", (known | fresh)[n]) for n in known | fresh}


def test_absent_takes_one_row_per_key(spark):
    existing = spark.createDataFrame([(1, "a")], "k int, v string")
    incoming = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b"), (3, "d")], "k int, v string")
    assert rows(upsert.absent(existing, incoming, "k")) == [(2, "b"), (3, "d")]


def test_new_ids_leave_known_ones_alone(spark):
    frame = spark.createDataFrame([(1, "BTC"), (9, "SOL"), (None, "DOT"), (None, "ADA")], "Currency_ID int, Currency_Name string")
    assert rows(upsert.with_new_ids(frame, "Currency_ID", "Currency_Name")) == [(1, "BTC"), (10, "ADA"), (11, "DOT"), (9, "SOL")]
    fresh = frame.withColumn("Currency_ID", F.lit(None).cast("int"))
    assert sorted(r[0] for r in upsert.with_new_ids(fresh, "Currency_ID", "Currency_Name").collect()) == [1, 2, 3, 4]


def test_sources_keep_their_ids(spark):
    prices = spark.createDataFrame([("Binance",), ("Kraken",), (None,), ("Kraken",)], "Source string")
    got = star.dim_source(star.seed_sources(spark), prices)
    assert rows(got) == [(1, "Binance"), (2, "CoinMarketCap"), (3, "Kraken"), (4, star.UNKNOWN_SOURCE)]


# --- incremental ------------------------------------------------------------------------------
keys = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=20)


@PROPERTY
@given(keys, keys)
def test_not_loaded_is_the_set_difference(spark, batch, loaded):
    schema = "t int, p int"
    frame, table = spark.createDataFrame(batch, schema), spark.createDataFrame(loaded, schema)
    expected = sorted(x for x in batch if x not in set(loaded))
    for limit in (0, 100):  # both ways: shuffled, and with the table thinned out first
        got = incremental.not_loaded(frame, table, ["t", "p"], "t", max_rows=limit)
        assert sorted(map(tuple, got.select("t", "p").collect())) == expected


def test_mark_of_an_empty_table_loads_everything(spark):
    frame = spark.createDataFrame([(1,), (2,)], "t int")
    assert incremental.high_water_mark(frame.limit(0), "t") is None
    assert incremental.newer_than_mark(frame, None, "t").count() == 2
    assert rows(incremental.newer_than_mark(frame, 1, "t")) == [(2,)]


# --- joins ------------------------------------------------------------------------------------
def test_lookup_sets_unknown_rows_aside(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    dimension = spark.createDataFrame([(10, "a")], "key int, name string")
    matched, rejected = joins.lookup(facts, dimension, "name")
    assert rows(matched.select("id", "key")) == [(1, 10)]
    assert rows(rejected.select("id")) == [(2,), (3,)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_is_the_same_with_and_without_broadcast(spark, how):
    fact = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    dimension = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = joins.join_dimension(fact, dimension, "k", how)
    large = joins.join_dimension(fact, dimension, "k", how, max_rows=1)
    assert rows(small) == rows(large)


# --- profile and constraints ------------------------------------------------------------------
DIRTY = [(1, "a", 1.0), (1, "a", 1.0), (1, "b", None), (2, None, 3.0), (2, None, 3.0), (2, None, 3.0)]


def test_profiles(spark):
    frame = spark.createDataFrame(DIRTY, "k int, s string, v double")
    assert rows(profile.null_profile(frame)) == [("k", "int", 0, 6), ("s", "string", 3, 3), ("v", "double", 1, 5)]
    assert rows(profile.columns_with_nulls(frame)) == [("s", 3), ("v", 1)]
    assert profile.columns_with_nulls(frame.select("k")).count() == 0
    assert rows(profile.distinct_profile(frame)) == [("k", 2), ("s", 2), ("v", 2)]
    assert rows(profile.distinct_profile(frame, approximate=True)) == [("k", 2), ("s", 2), ("v", 2)]
    for limit in (100, 0):  # few repeated keys, and too many
        assert rows(profile.duplicate_profile(frame, ["k"], limit)) == [("full row", 3), ("key", 4)]
        assert rows(profile.duplicate_profile(frame, ["s", "v"], limit)) == [("full row", 3), ("key", 3)]
        assert rows(profile.duplicate_profile(frame.limit(0), ["k"], limit)) == [("full row", 0), ("key", 0)]


def test_constraints(spark):
    frame = spark.createDataFrame(DIRTY, "k int, s string, v double")
    parent = spark.createDataFrame([(1,)], "id int")
    assert constraints.null_rows(frame, ["s", "v"]).count() == 4
    assert rows(constraints.repeated_keys(frame, ["k"])) == [(1, 3), (2, 3)]
    assert rows(constraints.orphan_keys(frame, "k", parent, "id")) == [(2, 3)]
    assert constraints.orphan_keys(frame, "s", parent.select(F.lit("a").alias("id")), "id").count() == 1
    report = constraints.violation_report({"nulls": constraints.null_rows(frame, ["s"]), "none": frame.limit(0)})
    assert rows(report) == [("none", 0), ("nulls", 3)]
