"""Gold tables on small rows and their invariants."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pressflow.fixed_values import SOURCE_COUNTRY
from pressflow.operators import gold
from pressflow.plans.pipeline import gold_tables

SCHEMA = """id STRING, titre_article STRING, auteur STRING, date_publication STRING,
    categorie STRING, contenu STRING, source STRING, url STRING, language STRING, word_count INT,
    source_key STRING, dt DATE"""


def row(id, published, title="title", content="content", source="CNN", theme="t", dt=None):
    key = (source or "unknown").replace(" ", "_")
    return (id, title, None, published, theme, content, source, f"u/{id}", "en", 1, key,
            dt or date.fromisoformat(published[:10]))


@pytest.fixture
def silver(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), SCHEMA)
    return make


def test_defaults_fill_nulls_only(spark):
    df = spark.createDataFrame(
        [("a", None, None, "2026-01-01", None, None, None, "u", None, None, "unknown", None),
         ("b", "", "", "2026-01-01", "", "", "", "u", "", 0, "unknown", None)], SCHEMA)
    a, b = gold.silver_view(df).orderBy("id").collect()
    assert (a["source"], a["categorie"], a["language"], a["country"]) == (
        "unknown", "Uncategorized", "unknown", "XX")
    assert (a["titre_article"], a["contenu"], a["word_count"], a["auteur"]) == ("", "", 0, None)
    assert (b["source"], b["categorie"], b["language"]) == ("", "", "")


def test_undated_rows_leave(silver):
    df = silver(row("a", "2026-01-01T00:00:00Z")).withColumn("date_publication", F.lit("soon"))
    assert gold.silver_view(df).isEmpty()


def test_day_is_utc_while_dt_is_as_written(silver):
    view = gold.silver_view(silver(row("a", "2026-01-01T23:30:00-05:00")))
    assert view.first()["day"] == date(2026, 1, 2)


def test_country_lookup(silver):
    rows = [row(str(i), "2026-01-01", source=s) for i, s in enumerate([*SOURCE_COUNTRY, "Other"])]
    got = {r["source"]: r["country"] for r in gold.silver_view(silver(*rows)).collect()}
    assert got == {**SOURCE_COUNTRY, "Other": "XX"}


def test_counts(silver):
    view = gold.silver_view(silver(
        row("a", "2026-01-01T01:00:00Z"), row("b", "2026-01-01T09:00:00Z", source="BBC"),
        row("c", "2026-01-01T05:00:00Z", theme=None), row("d", "2026-01-02T00:00:00Z")))

    def rows(df):
        return {tuple(r) for r in df.collect()}

    one, two = date(2026, 1, 1), date(2026, 1, 2)
    assert rows(gold.articles_per_day(view)) == {(one, "CNN", 2), (one, "BBC", 1), (two, "CNN", 1)}
    assert rows(gold.articles_per_source(view)) == {
        ("CNN", 3, datetime(2026, 1, 2)), ("BBC", 1, datetime(2026, 1, 1, 9))}
    assert rows(gold.articles_per_theme(view)) == {
        ("t", one, 2), ("Uncategorized", one, 1), ("t", two, 1)}
    assert rows(gold.articles_per_country(view)) == {("US", one, 2), ("GB", one, 1), ("US", two, 1)}


def test_top_keywords_rank_ties_by_keyword(silver):
    words = "zeta alpha beta beta the les"
    view = gold.silver_view(silver(row("a", "2026-01-01", title="Beta", content=words)))
    got = [tuple(r) for r in gold.top_keywords(view, 2).orderBy(F.desc("n_occurrences"), "keyword").collect()]
    assert [(k, n) for k, _, n in got] == [("beta", 3), ("alpha", 1)]


def test_words_do_not_join_across_articles(silver):
    view = gold.silver_view(silver(
        row("a", "2026-01-01", title="aa", content="bb"),
        row("b", "2026-01-01", title="cc", content="dd")))
    assert gold.keyword_counts(view).isEmpty()


def test_articles_keep_the_first_in_listing_order(silver):
    view = gold.silver_view(silver(
        row("a", "2026-01-02", title="later dt"), row("a", "2026-01-01", title="first"),
        row("b", "2026-01-01", title="plain", source="BBC"),
        # "-" sorts before "/", so this folder is listed before BBC's
        row("b", "2026-01-05", title="dashed", source="BBC-2")))
    got = {r["id"]: r["title"] for r in gold.articles(view).collect()}
    assert got == {"a": "first", "b": "dashed"}
    # counts see both versions
    assert gold.articles_per_day(view).agg(F.sum("n_articles")).first()[0] == 4


def test_invariants_on_the_sample(spark):
    from pressflow.plans import queries
    from tests_paths import SMALL

    tables = gold_tables(queries._silver(spark, SMALL))
    totals = {
        name: tables[name].agg(F.sum("n_articles")).first()[0]
        for name in ("articles_per_day", "articles_per_source", "articles_per_theme",
                     "articles_per_country")}
    assert len(set(totals.values())) == 1
    top = tables["top_keywords"].collect()
    assert max(Counter(r["day"] for r in top).values()) <= 50
    from pressflow.fixed_values import STOPWORDS
    assert not {r["keyword"] for r in top} & set(STOPWORDS)


def test_articles_are_chosen_before_their_texts_are_cleaned(spark):
    from pressflow.plans import queries
    from tests_paths import SMALL

    chosen = queries._gold(spark, SMALL, "articles")
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("ArrowEvalPython") < plan.index("Window")
    cleaned_first = gold.articles(queries._view(spark, SMALL))
    assert chosen.count() == cleaned_first.count() > 0
    assert chosen.exceptAll(cleaned_first).isEmpty()
