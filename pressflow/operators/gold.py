"""Normalised silver and the gold tables built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressflow.fixed_values import (
    STOPWORDS,
    TOP_KEYWORDS_PER_DAY,
    UNKNOWN_LANGUAGE,
    UNKNOWN_SOURCE,
    UNKNOWN_THEME,
)
from pressflow.functions.country import country_of
from pressflow.functions.dates import iso_timestamp, utc_day
from pressflow.functions.keys import silver_key
from pressflow.functions.text import keyword_tokens, title_and_content
from pressflow.operators.latest import first_per_key


def silver_view(silver: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Silver with instants, days, defaults and country; undated rows are left out."""
    return (
        silver
        .withColumn("published_at", iso_timestamp(F.col("date_publication")))
        .where(F.col("published_at").isNotNull())
        .withColumn("day", utc_day(F.col("published_at")))
        .fillna({"source": UNKNOWN_SOURCE, "categorie": UNKNOWN_THEME,
                 "language": UNKNOWN_LANGUAGE, "contenu": "", "titre_article": "",
                 "word_count": 0})
        .withColumn("country", country_of(F.col("source"), countries))
    )


def _articles() -> Column:
    return F.count(F.lit(1)).alias("n_articles")


def articles_per_day(view: DataFrame) -> DataFrame:
    """O51"""
    return view.groupBy("day", "source").agg(_articles())


def articles_per_source(view: DataFrame) -> DataFrame:
    """O52"""
    return view.groupBy("source").agg(_articles(), F.max("published_at").alias("last_seen_at"))


def articles_per_theme(view: DataFrame) -> DataFrame:
    """O53"""
    return view.groupBy(F.col("categorie").alias("theme"), "day").agg(_articles())


def articles_per_country(view: DataFrame) -> DataFrame:
    """O54"""
    return view.groupBy("country", "day").agg(_articles())


def daily_tokens(view: DataFrame, *keep: str) -> DataFrame:
    """Every keyword occurrence with its day, stopwords removed (O41-O43), and the columns to keep."""
    text = title_and_content(F.col("titre_article"), F.col("contenu"))
    return (
        view.select("day", *keep, F.explode(keyword_tokens(text)).alias("token"))
        .select("day", *keep, F.lower("token").alias("keyword"))
        .where(~F.col("keyword").isin(STOPWORDS))
    )


def keyword_counts(view: DataFrame) -> DataFrame:
    """Occurrences per day and keyword (O55), summed inside each task before the shuffle."""
    return (
        daily_tokens(view).groupBy("day", "keyword")
        .agg(F.count(F.lit(1)).alias("n_occurrences"))
    )


def leading_keywords(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent keywords of each day, ties by keyword, from ``keyword_counts``.

    Each task sends at most k rows per day to the final ranking.
    """
    ranking = Window.partitionBy("day").orderBy(F.desc("n_occurrences"), "keyword")
    return (
        counts.withColumn("_rank", F.row_number().over(ranking))
        .where(F.col("_rank") <= k)
        .select("keyword", "day", "n_occurrences")
    )


def top_keywords(view: DataFrame, k: int = TOP_KEYWORDS_PER_DAY) -> DataFrame:
    """The k most frequent keywords of each day."""
    return leading_keywords(keyword_counts(view), k)


def listing() -> Column:
    """A row's place in the listing of silver."""
    return silver_key(F.col("source_key"), F.col("dt"), F.col("id"))


def first_listed(passed: DataFrame) -> DataFrame:
    """One row per id, the one that ``articles`` takes, of events that are not cleaned yet.

    Cleaning is row-local and leaves the id, the folders and the date as they are, so texts of
    other rows need none.
    """
    dated = passed.where(iso_timestamp(F.col("date_publication")).isNotNull())
    return first_per_key(dated, ["id"], [listing()])


def articles(view: DataFrame, pick=first_per_key) -> DataFrame:
    """Warehouse columns, one row per id: the first in silver listing order.

    ``pick`` is ``first_per_key`` or a function that does the same; None, if the view has one row
    per id already.
    """
    rows = view if pick is None else pick(view, ["id"], [listing()])
    return rows.select(
        "id",
        F.col("titre_article").alias("title"),
        F.col("auteur").alias("author"),
        "published_at",
        F.col("categorie").alias("category"),
        "source",
        "url",
        "language",
        F.col("contenu").alias("content"),
        "word_count",
    )
