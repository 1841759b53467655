"""Counts of matches by month, and of entries by community."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_month(entries: DataFrame, weight: str = "weight", year: str = "year", month: str = "month") -> DataFrame:
    """(year, month, n, total) with a last row for the grand total; entries without a month have a row of their own."""
    ym = F.struct(F.col(year).alias("year"), F.col(month).alias("month")).alias("ym")
    counted = entries.rollup(ym).agg(F.sum(weight).alias("n"), (F.grouping_id() > 0).alias("total"))
    return counted.select("ym.year", "ym.month", F.coalesce("n", F.lit(0)).alias("n"), "total")


def by_community(entries: DataFrame) -> DataFrame:
    """(subreddit, n): entries, not matches."""
    return entries.groupBy("subreddit").agg(F.count("*").alias("n"))


def by_month_and_community(entries: DataFrame, semantics: str = "documented") -> DataFrame:
    """(year, month, subreddit, n) of each month; compat: running totals up to it."""
    t = entries.groupBy("year", "month", "subreddit").agg(F.count("*").alias("n"))
    if semantics == "compat":
        w = Window.partitionBy("subreddit").orderBy("year", "month")
        t = t.withColumn("n", F.sum("n").over(w))
    return t
