"""Every registered query against its SQL, and what no plan may contain."""

import re

import pytest

import registry
from marketlake.operators import incremental, joins, profile
from compare import in_order, open_tables, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.01"
# Python in the data path, rows held by the driver, and joins of everything with everything.
UNWANTED = r"EvalPython|MapInPandas|FlatMapGroups|ExistingRDD|CartesianProduct|BroadcastNestedLoopJoin"


@pytest.fixture(scope="module")
def database():
    return open_tables(FOLDER)


def test_every_query_has_sql():
    assert set(registry.SQL) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, database, capsys, name):
    frame = registry.QUERIES[name](spark, FOLDER)
    frame.explain()
    assert not re.search(UNWANTED, capsys.readouterr().out)
    columns, rows = spark_rows(frame)
    expected_columns, expected = sql_rows(database, registry.SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) and len(rows) > 0
    assert rows == expected


def is_ordered(sql):
    """Whether an ORDER BY stands outside all parentheses."""
    head, found, tail = sql.rpartition("ORDER BY")
    return bool(found) and tail.count("(") == tail.count(")") and head.count("(") == head.count(")")


ORDERED = sorted(n for n, sql in registry.SQL.items() if is_ordered(sql))


def test_reports_are_among_the_ordered_queries():
    assert {"pairs_by_category", "linked_prices", "dollar_quotes", "price_vs_reference", "highest_prices"} <= set(ORDERED)


@pytest.mark.parametrize("name", ORDERED)
def test_order_is_that_of_the_sql(spark, database, name):
    frame = registry.QUERIES[name](spark, FOLDER)
    result = database.execute(registry.SQL[name])
    expected = in_order([c[0] for c in result.description], result.fetchall())
    assert in_order(frame.columns, [tuple(r) for r in frame.collect()]) == expected


@pytest.mark.parametrize("name", [
    "star_enriched", "star_enriched_trades", "linked_prices", "category_facts", "category_rejects",
    "duplicate_profile", "delta_by_key", "normalised_price",
])
def test_same_rows_without_broadcasts(spark, database, monkeypatch, name):
    # As if every dimension and batch were too large to broadcast.
    for module in (joins, profile):
        monkeypatch.setattr(module, "fits_broadcast", lambda *args, **options: False)
    monkeypatch.setattr(incremental.not_loaded, "__defaults__", (*incremental.not_loaded.__defaults__[:-1], -1))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        columns, rows = spark_rows(registry.QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set(threshold, before)
    assert (columns, rows) == sql_rows(database, registry.SQL[name])
