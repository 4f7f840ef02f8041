"""The physical plans of the queries: what is read, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import registry
from marketlake.operators import joins
from registry import bindings

FOLDER = "/root/testdata/sf0.001"


def plan(capsys, frame):
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


def test_flagship_shuffles_no_fact_rows(spark, capsys):
    text = plan(capsys, registry.QUERIES["star_enriched"](spark, FOLDER))
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "events.parquet" in line)
    # From the top of the plan to the scan of the fact there is a broadcast join and no exchange.
    assert not any("Exchange" in line for line in lines[:scan])
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in lines[scan]


def test_large_dimension_means_one_shuffle_of_the_fact(spark, capsys):
    # The same join with a bound that the dimension exceeds.
    orders = bindings.trade_pair(spark, FOLDER)
    fact = bindings.trade_hist(spark, FOLDER)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        text = plan(capsys, joins.join_dimension(fact, orders, "Pair_ID", max_rows=10))
    finally:
        spark.conf.set(limit, before)
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_hot_key_is_split(spark, capsys):
    # A third of the fact has one key; the shuffle join reads that partition in several tasks.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
        fact = spark.range(0, 300_000, numPartitions=8).select(key.alias("Pair_ID"), F.xxhash64("id").alias("x"))
        dimension = spark.range(1000).select(F.col("id").alias("Pair_ID"), F.col("id").alias("v"))
        joined = joins.join_dimension(fact, dimension, "Pair_ID", max_rows=10)
        assert len(joined.collect()) == 300_000
        text = plan(capsys, joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert "skew=true" in text


def test_best_rank_is_found_before_the_shuffle(spark, capsys):
    text = plan(capsys, registry.QUERIES["metadata_dedup"](spark, FOLDER))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    assert text.index("Exchange hashpartitioning") < re.search(r"WindowGroupLimit.*Partial", text).start()


def test_mark_reaches_the_scan(spark, capsys):
    text = plan(capsys, registry.QUERIES["delta_watermark"](spark, "/root/testdata/sf0.01"))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(ts,2024-01-19T", text)


def test_top_rows_need_no_full_sort(spark, capsys):
    for name in ("price_vs_reference", "highest_prices"):
        text = plan(capsys, registry.QUERIES[name](spark, FOLDER))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    text = plan(capsys, registry.QUERIES["highest_prices"](spark, FOLDER))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string,p_retailprice:double>" in text


def test_positions_use_no_window_over_the_rows(spark, capsys):
    text = plan(capsys, registry.QUERIES["price_positions"](spark, FOLDER))
    window = text.splitlines()
    depth = next(i for i, line in enumerate(window) if "Window " in line)
    assert any("HashAggregate" in line for line in window[depth:]), "the window runs on one row per range"
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["category_counts", "dim_time", "duplicate_profile", "duplicate_tickers"])
def test_grouping_is_done_before_the_shuffle(spark, capsys, name):
    lines = plan(capsys, registry.QUERIES[name](spark, FOLDER)).splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert shuffles and all("HashAggregate" in lines[i + 1] for i in shuffles)


def test_distinct_keys_come_before_the_master_lookup(spark, capsys):
    lines = plan(capsys, registry.QUERIES["missing_master"](spark, FOLDER)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "events.parquet" in line)
    assert "Exchange" in " ".join(lines[:scan]) and any("HashAggregate" in line for line in lines[scan - 3:scan])
