"""Dashboard queries over the gold tables.

Each takes the gold tables it reads and, where time matters, ``as_of`` in place of the clock,
so a result can be reproduced. Ties are broken by the key.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.functions.dates import utc_literal


def _since(day: date, days: int) -> Column:
    """From ``days`` before ``day`` on, with no upper bound."""
    return F.col("day") >= F.date_sub(F.lit(day), days)


def trending(
    top_keywords: DataFrame, as_of: date, days: int = 7, limit: int = 25, days_seen: bool = True
) -> DataFrame:
    """Keywords by total occurrences in the last days.

    Over stored top keywords these are the days on which a keyword led; over ``keyword_counts``
    they are all of its days.
    """
    totals = [F.sum("n_occurrences").alias("total_occurrences")]
    if days_seen:
        totals.append(F.count_distinct("day").alias("days_seen"))
    return (
        top_keywords.where(_since(as_of, days)).groupBy("keyword").agg(*totals)
        .orderBy(F.desc("total_occurrences"), "keyword").limit(limit)
    )


def trending_series(
    top_keywords: DataFrame, as_of: date, days: int = 7, limit: int = 10
) -> DataFrame:
    """Daily occurrences of the leading keywords (O65). The broadcast side is ``limit`` rows."""
    recent = top_keywords.where(_since(as_of, days))
    leaders = trending(top_keywords, as_of, days, limit, days_seen=False).select("keyword")
    return (
        recent.join(F.broadcast(leaders), "keyword")
        .select("day", "keyword", "n_occurrences").orderBy("day", "keyword")
    )


def source_ranking(articles_per_source: DataFrame) -> DataFrame:
    """Sources by number of articles."""
    return articles_per_source.orderBy(F.desc("n_articles"), "source")


def source_daily(articles_per_day: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Articles per source over time."""
    return articles_per_day.where(_since(as_of, days)).orderBy("day", "source")


def keywords_all_time(top_keywords: DataFrame, limit: int = 50) -> DataFrame:
    """Keywords by occurrences over all days (O68); see ``trending`` for what the days are."""
    return (
        top_keywords.groupBy("keyword").agg(F.sum("n_occurrences").alias("n_occurrences"))
        .orderBy(F.desc("n_occurrences"), "keyword").limit(limit)
    )


class CertifiedKeywords:
    """Leading keywords over all days from stored daily lists, exact.

    ``listed`` has at most ``k`` leading keywords of each day, ``counts`` all of them. The k-th count
    of a day bounds every keyword that its list leaves out, so a keyword's total lies between its
    listed occurrences and those plus the bounds of the days that do not list it. The ``limit``-th
    listed total is a floor of the result: keywords whose bound is below it are out, those listed on
    every day that could hold them are certain, and only the rest is counted again. A keyword that
    no day lists and that reaches the floor has a floor / days or more on some day.

    Three numbers come to the driver.
    """

    def __init__(self, listed: DataFrame, counts: DataFrame, k: int, limit: int = 50):
        self._counts, self._limit = counts, limit
        days = listed.groupBy("day").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("n_occurrences")).otherwise(0).alias("bound"))
        totals = listed.join(days, "day").groupBy("keyword").agg(
            F.sum("n_occurrences").alias("n_occurrences"), F.sum("bound").alias("covered"))
        bounds = days.agg(F.coalesce(F.sum("bound"), F.lit(0)), F.count(F.lit(1))).first()
        self._left_out, self._days = bounds
        floor = totals.orderBy(F.desc("n_occurrences"), "keyword").limit(limit) \
            .agg(F.when(F.count(F.lit(1)) == limit, F.min("n_occurrences")).otherwise(0)).first()[0]
        self._floor = floor
        self._totals = totals.withColumn("missing", F.lit(self._left_out) - F.col("covered"))

    def certain(self) -> DataFrame:
        """Keywords whose listed total is their total."""
        return self._totals.where("missing = 0").select("keyword", "n_occurrences")

    def uncertain(self) -> DataFrame:
        """Keywords that may reach the floor and have to be counted again."""
        listed = self._totals.where(F.col("missing") > 0)
        reach = listed.where(F.col("n_occurrences") + F.col("missing") >= self._floor).select("keyword")
        if self._left_out < self._floor:
            return reach
        # a keyword on no list may reach the floor too
        often = self._counts.where(F.col("n_occurrences") * self._days >= self._floor).select("keyword").distinct()
        return reach.unionByName(often.join(self._totals, "keyword", "left_anti"))

    def leading(self) -> DataFrame:
        """The keywords with most occurrences, ties by keyword."""
        again = self._counts.join(self.uncertain(), "keyword", "left_semi") \
            .groupBy("keyword").agg(F.sum("n_occurrences").alias("n_occurrences"))
        return keywords_all_time(self.certain().unionByName(again), self._limit)


def daily_totals(articles_per_day: DataFrame) -> DataFrame:
    """Articles per day over all sources."""
    return (
        articles_per_day.groupBy("day").agg(F.sum("n_articles").alias("total_articles"))
        .orderBy("day")
    )


def themes(
    articles_per_theme: DataFrame, as_of: date, days: int = 7, limit: int = 15
) -> DataFrame:
    """Themes by articles in the last days."""
    return (
        articles_per_theme.where(_since(as_of, days))
        .groupBy("theme").agg(F.sum("n_articles").alias("n_articles"))
        .orderBy(F.desc("n_articles"), "theme").limit(limit)
    )


def countries(articles_per_country: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Countries by articles in the last days."""
    return (
        articles_per_country.where(_since(as_of, days))
        .groupBy("country").agg(F.sum("n_articles").alias("n_articles"))
        .orderBy(F.desc("n_articles"), "country")
    )


def total_articles(articles: DataFrame) -> DataFrame:
    """O72"""
    return articles.agg(F.count(F.lit(1)).alias("total_articles"))


def active_sources(articles_per_source: DataFrame) -> DataFrame:
    """O73"""
    return articles_per_source.agg(F.count(F.lit(1)).alias("active_sources"))


def articles_last_hours(articles: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Articles published in the last hours."""
    start = utc_literal(as_of - timedelta(hours=hours))
    return (
        articles.where(F.col("published_at") >= start)
        .agg(F.count(F.lit(1)).alias(f"last_{hours}h"))
    )


def language_distribution(articles: DataFrame) -> DataFrame:
    """Articles per language."""
    return (
        articles.groupBy("language").agg(F.count(F.lit(1)).alias("n_articles"))
        .orderBy(F.desc("n_articles"), "language")
    )


LATEST_COLUMNS = ["published_at", "source", "category", "language", "title", "url"]
LATEST_SHORT_COLUMNS = ["published_at", "source", "language", "title"]


def latest_articles(
    articles: DataFrame, columns: list[str] = LATEST_COLUMNS, limit: int = 100
) -> DataFrame:
    """The newest articles."""
    return (
        articles.orderBy(F.col("published_at").desc_nulls_last(), "id").limit(limit)
        .select(*columns)
    )
