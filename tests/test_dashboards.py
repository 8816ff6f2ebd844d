"""O64-O81 on small gold tables."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pressflow.plans import dashboards

TODAY = date(2026, 1, 31)


def days_ago(n):
    return TODAY - timedelta(days=n)


@pytest.fixture(scope="module")
def keywords(spark):
    return spark.createDataFrame(
        [("war", days_ago(0), 5), ("war", days_ago(7), 3), ("war", days_ago(8), 100),
         ("peace", days_ago(-1), 8), ("aid", days_ago(2), 8), ("old", days_ago(20), 50)],
        "keyword STRING, day DATE, n_occurrences LONG")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_trending_covers_eight_days_without_upper_bound(keywords):
    assert rows(dashboards.trending(keywords, TODAY)) == [
        ("aid", 8, 1), ("peace", 8, 1), ("war", 8, 2)]
    assert rows(dashboards.trending(keywords, TODAY, limit=2, days_seen=False)) == [
        ("aid", 8), ("peace", 8)]


def test_trending_series_keeps_leaders_only(keywords):
    assert rows(dashboards.trending_series(keywords, TODAY, limit=2)) == [
        (days_ago(2), "aid", 8), (days_ago(-1), "peace", 8)]


def test_all_time_keywords(keywords):
    assert rows(dashboards.keywords_all_time(keywords, 2)) == [("war", 108), ("old", 50)]


def test_rankings_and_totals(spark):
    per_day = spark.createDataFrame(
        [(days_ago(0), "b", 2), (days_ago(0), "a", 1), (days_ago(31), "a", 4)],
        "day DATE, source STRING, n_articles LONG")
    assert rows(dashboards.daily_totals(per_day)) == [(days_ago(31), 4), (days_ago(0), 3)]
    assert rows(dashboards.source_daily(per_day, TODAY)) == [
        (days_ago(0), "a", 1), (days_ago(0), "b", 2)]
    per_source = spark.createDataFrame(
        [("a", 5, datetime(2026, 1, 1)), ("b", 9, None), ("c", 5, None)],
        "source STRING, n_articles LONG, last_seen_at TIMESTAMP")
    assert [r[0] for r in rows(dashboards.source_ranking(per_source))] == ["b", "a", "c"]
    assert rows(dashboards.active_sources(per_source)) == [(3,)]
    per_theme = per_day.withColumnRenamed("source", "theme")
    assert rows(dashboards.themes(per_theme, TODAY, limit=1)) == [("b", 2)]
    per_country = per_day.withColumnRenamed("source", "country")
    assert rows(dashboards.countries(per_country, TODAY)) == [("b", 2), ("a", 1)]


def test_article_tiles(spark):
    now = datetime(2026, 1, 31, 12)
    published = [now, now - timedelta(minutes=59), now - timedelta(hours=1),
                 now - timedelta(hours=24), now - timedelta(hours=25), None]
    articles = spark.createDataFrame(
        [(str(i), f"t{i}", ts, "c", "s", "u", "en" if i else "fr") for i, ts in enumerate(published)],
        "id STRING, title STRING, published_at TIMESTAMP, category STRING, source STRING, url STRING, language STRING")
    assert rows(dashboards.total_articles(articles)) == [(6,)]
    assert rows(dashboards.articles_last_hours(articles, now)) == [(4,)]
    assert rows(dashboards.articles_last_hours(articles, now, 1)) == [(3,)]
    assert rows(dashboards.language_distribution(articles)) == [("en", 5), ("fr", 1)]
    latest = dashboards.latest_articles(articles, limit=6)
    assert [r["title"] for r in latest.collect()] == ["t0", "t1", "t2", "t3", "t4", "t5"]
    assert latest.columns == dashboards.LATEST_COLUMNS
    short = dashboards.latest_articles(articles, dashboards.LATEST_SHORT_COLUMNS, 1)
    assert rows(short) == [(now, "s", "fr", "t0")]


def test_limited_rankings_do_not_sort_everything(keywords):
    plan = dashboards.trending(keywords, TODAY)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    joined = dashboards.trending_series(keywords, TODAY).where(F.col("day").isNotNull())
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
