"""Feed documents to raw article events."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.functions.dates import feed_date_iso
from pressflow.functions.feedxml import FIELDS, scan
from pressflow.functions.keys import article_id
from pressflow.functions.text import ustrip
from pressflow.operators.latest import first_per_key
from pressflow.operators.skew import salted_left_join
from pressflow.schemas import RAW_COLUMNS
from pressflow.sources.pages import SOURCE_RULES, SourceRule, by_source


def _stripped(c: Column) -> Column:
    return ustrip(F.coalesce(c, F.lit("")))


def _scanned(feeds: DataFrame, max_items: int | None = None, markup: bool = False) -> DataFrame:
    """``feed_id``, ``source``, whether a document ``is_feed``, its ``items``, and the ``xml`` column.

    Documents are read in Arrow batches; ``markup`` adds that of items which cannot be used.
    """
    item = ", ".join(f"`{name}` STRING" for name in (*FIELDS, "category", "reason", "xml"))

    @F.pandas_udf(f"is_feed BOOLEAN, items ARRAY<STRUCT<{item}>>")
    def read(documents: pd.Series) -> pd.DataFrame:
        rows = []
        for document in documents:
            is_feed, items = scan(document)
            rows.append((is_feed, [
                {**dict.fromkeys((*FIELDS, "category")), **i.fields, "reason": i.reason,
                 "xml": document[i.start:i.end] if markup and i.reason else None}
                for i in items[:max_items]]))
        return pd.DataFrame(rows, columns=["is_feed", "items"])

    return feeds.select("feed_id", "source", "xml", read("xml").alias("read")).select(
        "feed_id", "source", "xml", "read.*")


def _items(scanned: DataFrame) -> DataFrame:
    return scanned.select("feed_id", "source", F.posexplode("items").alias("position", "item"))


def feed_items(
    feeds: DataFrame,
    max_items: int | None = None,
    rules: list[SourceRule] = SOURCE_RULES,
) -> DataFrame:
    """Items of each feed document (O06, O07), those without a link left out (O14). Reads
    ``feed_id``, ``source`` and ``xml``; see ``feed_rejects`` for what cannot be read.

    ``max_items`` takes the items at the head of each document only (O11), before anything is
    shuffled. As in the feed's own order, items without a link count towards the limit.
    """
    item, source = F.col("item"), F.col("source")
    default_category = by_source(source, lambda r: F.lit(r.default_category).cast("string"), rules)
    author = by_source(
        source,
        lambda r: item["dc:creator"] if r.feed_has_author else F.lit(None).cast("string"), rules)
    return (
        _items(_scanned(feeds, max_items)).where(item["reason"].isNull())
        .select(
            "feed_id", "source", "position",
            _stripped(item["title"]).alias("title"),
            _stripped(item["link"]).alias("url"),
            item["pubDate"].alias("pub_date"),
            F.coalesce(item["category"], default_category).alias("category"),
            _stripped(item["description"]).alias("summary"),
            author.alias("author"),
        )
        .where(F.col("url") != "")
    )


def feed_rejects(feeds: DataFrame) -> DataFrame:
    """What cannot be read of each feed document: ``feed_id``, ``source``, ``position``, ``reason``
    and the ``xml``.

    Reasons are ``no_channel`` for a document that is no feed, and for items ``cut_off`` (no end)
    and ``unreadable_item`` (neither title nor link).
    """
    scanned = _scanned(feeds, markup=True)
    documents = scanned.where(~F.col("is_feed")).select(
        "feed_id", "source", F.lit(None).cast("int").alias("position"),
        F.lit("no_channel").alias("reason"), "xml")
    items = _items(scanned.where("is_feed")).select(
        "feed_id", "source", "position", F.col("item.reason").alias("reason"), F.col("item.xml").alias("xml"))
    return documents.unionByName(items.where(F.col("reason").isNotNull()))


def undated_items(items: DataFrame) -> DataFrame:
    """Dates of ``feed_items`` that no form reads, with how often they occur."""
    unread = items.where(F.col("pub_date").isNotNull() & feed_date_iso(F.col("pub_date")).isNull())
    return unread.groupBy("source", "pub_date").agg(F.count(F.lit(1)).alias("n_items"))


def _with_pages(items: DataFrame, pages: DataFrame | None) -> DataFrame:
    """Items with body and author of their page; where a URL was fetched more than once, the
    first by ``page_id`` counts."""
    if pages is None:
        none = F.lit(None).cast("string")
        return items.withColumns({"page_body": none, "page_author": none})
    page = first_per_key(
        pages.select("source", "url", "page_id", "page_body", "page_author"),
        ["source", "url"], [F.asc("page_id")],
    ).drop("page_id")
    return salted_left_join(items, page, ["source", "url"], spread_by=["feed_id", "position"])


def article_events(
    items: DataFrame, pages: DataFrame | None = None, scraped_at: Column | None = None
) -> DataFrame:
    """Raw article events from feed items and extracted pages (O12, O13, O15), without those
    that lack a title (O14). ``pages`` comes from ``extract_pages``; without it, summaries are
    the content."""
    joined = _with_pages(items, pages)
    body = F.when(F.col("page_body") != "", F.col("page_body")).otherwise(F.col("summary"))
    author = F.when(F.col("author") != "", F.col("author")).otherwise(F.col("page_author"))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return (
        joined.select(
            _stripped(F.col("title")).alias("titre_article"),
            F.when(author != "", author).alias("auteur"),
            feed_date_iso(F.col("pub_date")).alias("date_publication"),
            F.when(F.col("category") != "", F.col("category")).alias("categorie"),
            _stripped(body).alias("contenu"),
            "source", "url",
            article_id(F.col("url")).alias("id"),
            (now if scraped_at is None else scraped_at).alias("scraped_at"),
        )
        .where(F.col("titre_article") != "")
        .select(*RAW_COLUMNS)
    )
