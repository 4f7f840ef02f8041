"""Aggregates over prices that go beyond the reports: categories with several memberships, sources against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.classify import NO_MATCH
from marketlake.operators.joins import join_dimension
from marketlake.plans.candles import candle_parts, candles


def category_list(categories: Column) -> Column:
    """The distinct entries of a comma-separated list; one for what belongs to none."""
    entries = F.filter(F.transform(F.split(categories, ","), lambda x: F.btrim(x)), lambda x: x != "")
    found = F.array_distinct(F.coalesce(entries, F.array().cast("array<string>")))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(NO_MATCH)))


def category_rollup(prices: DataFrame, pair: DataFrame) -> DataFrame:
    """Number, sum, least and greatest of the prices by category and month, category, month, and in all.

    ``level`` is the grouping id: 0 for category and month, 1 for category, 2 for month, 3 for all. A pair of several
    categories counts in each, but once in the levels without category. Prices are added up by pair and month
    before categories multiply them, so what is expanded is short.
    """
    month = F.date_format("Timestamp", "yyyy-MM").alias("month")
    by_pair = prices.groupBy("Pair_ID", month).agg(
        F.count("Price").alias("n"), F.sum("Price").alias("total"), F.min("Price").alias("least"), F.max("Price").alias("most")
    )
    listed = pair.select("Pair_ID", category_list(F.col("Manual_Category")).alias("categories"))
    each = join_dimension(by_pair, listed, "Pair_ID").select("*", F.posexplode("categories").alias("place", "category"))
    rolled = F.grouping("category") == 1

    def once(column: str, empty) -> Column:
        return F.sum(F.when(F.col("place") == 0, F.col(column)).otherwise(F.lit(empty)))

    return each.groupingSets([[F.col("category"), F.col("month")], [F.col("category")], [F.col("month")], []], "category", "month").agg(
        F.grouping_id().cast("int").alias("level"),
        F.when(rolled, once("n", 0)).otherwise(F.sum("n")).alias("n_prices"),
        F.when(rolled, once("total", 0)).otherwise(F.sum("total")).cast("decimal(38,8)").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    ).select("category", "month", "level", "n_prices", "total", "least", "most")


def gap_points(first: Column, second: Column) -> Column:
    """The distance of two prices in whole hundredths of a per cent of their mean: 0 to 20000; NULL unless both are
    positive."""
    exact = F.call_function("div", F.abs(first - second) * F.lit(20000).cast("decimal(5,0)"), first + second)
    return F.when((first > 0) & (second > 0), exact)


def source_gap(prices: DataFrame, first: str, second: str, share: float = 0.99) -> DataFrame:
    """The closing prices of two sources next to each other, by pair and day.

    Returns Pair_ID, Day, First_Price, Second_Price (NULL where a source has none that day), Gap_Points, Outlier
    (whether the gap is above the least one that ``share`` of all gaps do not exceed). The limit comes from a histogram
    of the gaps, at most 20001 counts that merge, so it is exact and no gap is sorted.
    """
    close = candles(candle_parts(prices.filter(F.col("Source").isin(first, second)), ("Pair_ID", "Source")), ("Pair_ID", "Source"))
    # A full outer join of the two sources that needs one grouping.
    sides = close.groupBy("Pair_ID", "Day").agg(
        F.max(F.when(F.col("Source") == first, F.col("Close"))).alias("First_Price"),
        F.max(F.when(F.col("Source") == second, F.col("Close"))).alias("Second_Price"),
    ).withColumn("Gap_Points", gap_points(F.col("First_Price"), F.col("Second_Price")))
    counts = sides.filter("Gap_Points IS NOT NULL").groupBy("Gap_Points").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("Gap_Points"))
    total = F.sum("n").over(Window.partitionBy())
    limit = counts.select("Gap_Points", upto.alias("upto"), total.alias("total")).filter(F.col("upto") >= F.lit(share) * F.col("total"))
    least = limit.agg(F.min("Gap_Points")).first()[0]
    return sides.withColumn("Outlier", F.col("Gap_Points") > F.lit(least).cast("bigint"))
