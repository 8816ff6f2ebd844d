"""The test tables read as article events, feeds and samples.

Documents have no date, title or category, so those come from ``events`` and ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.fixed_values import SOURCE_COUNTRY
from pressflow.functions.keys import article_id
from pressflow.functions.text import packed, unpacked
from pressflow.schemas import RAW_COLUMNS

# Deliveries of a document are its events: event_id div 10 = doc_id.
EVENTS_PER_DOCUMENT = 10
SCRAPED_AT = "2024-01-31T00:00:00+00:00"
# Sample sources that stand for a source with a country; the others stay as they are.
SOURCE_NAMES = {f"src{k}": name for k, name in enumerate(SOURCE_COUNTRY)}
# Text that cleaning changes, besides the article's URL: full-width letters and a ligature.
WIDE_TEXT = "ＡＢＣ ﬁn"
# Known schemas spare a job that reads file footers.
TABLES = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_utc(ts: str):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def first_events(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """``key`` and ``ts`` of the first event of each document or page."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return events.where(F.col("event_id") % EVENTS_PER_DOCUMENT == 0).select(
        F.expr(f"event_id div {EVENTS_PER_DOCUMENT}").alias(key), "ts")


def dated(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Add ``ts``, the time of the first event that belongs to each row of ``df``."""
    return df.join(first_events(spark, sf_dir, key).hint("merge"), key, "left")


def written_date(ts: str, doc_id: str):
    """A time in one of several forms, by document; some documents have none or no date at all."""
    form, bad = F.col(doc_id) % 7, F.col(doc_id) % 50
    local = F.date_format(F.col(ts) + F.expr("INTERVAL 90 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = (
        F.when(form == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(form == 3, F.date_format(ts, "yyyyMMdd"))
        .when(form == 4, F.concat(local, F.lit("+01:30")))
        .otherwise(iso_utc(ts))
    )
    return F.when(bad == 11, F.lit("")).when(bad == 13, F.lit("2024-02-30")).otherwise(written)


def articles_raw(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Documents as raw article events.

    By document, some have a blank title, dates come in several forms, some contents hold the
    article's URL or full-width letters, and every sixth is delivered under the next day too.

    What goes with a document is joined first, so the texts are shuffled once, for the join with
    that. It grows like the documents, so it is never broadcast. Where ``whole`` articles are read,
    the texts are shuffled compressed; others are not, so that filters on them come first.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    if whole:
        documents = documents.withColumn("text", packed(F.col("text")))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    again = F.when(F.col("doc_id") % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    delivered = first_events(spark, sf_dir, "doc_id").select("doc_id", "ts", F.explode(again).alias("days"))
    facts = delivered.select("doc_id", (F.col("ts") + F.make_dt_interval("days")).alias("ts")).join(
        labels, "doc_id", "full")
    name = F.col("source")
    for sample_name, source_name in SOURCE_NAMES.items():
        name = F.when(F.col("source") == sample_name, source_name).otherwise(name)
    added = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(" "), "url", F.lit(f" {WIDE_TEXT}"))).otherwise("")
    url = F.concat(F.lit("http://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"))
    return (
        documents.join(facts.hint("merge"), "doc_id", "left")
        .withColumns({"url": url, "text": unpacked(F.col("text")) if whole else F.col("text")})
        .select(
            F.when(F.col("doc_id") % 50 == 7, "\u00a0 \u3000")
            .otherwise(F.substring_index("text", "\n", 1)).alias("titre_article"),
            F.lit(None).cast("string").alias("auteur"),
            written_date("ts", "doc_id").alias("date_publication"),
            F.concat(F.lit("quality"), F.col("quality").cast("string")).alias("categorie"),
            F.concat("text", added).alias("contenu"),
            name.alias("source"),
            "url",
            article_id(F.col("url")).alias("id"),
            F.lit(SCRAPED_AT).alias("scraped_at"),
        )
        .select(*RAW_COLUMNS)
    )


def article_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as message bodies; of some documents just the title, which is no JSON, and of some
    an event without id."""
    number = F.regexp_extract("url", r"([0-9]+)$", 1).cast("bigint") % 25
    articles = articles_raw(spark, sf_dir, whole=True).withColumn("id", F.when(number != 5, F.col("id")))
    body = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    return articles.select(F.when(number == 3, F.col("titre_article")).otherwise(body).alias("value"))


def article_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a document as one more delivery of its article, later ones retitled; a
    document without events is delivered once. The text itself is not delivered again."""
    events = table(spark, sf_dir, "events").select(
        F.expr(f"event_id div {EVENTS_PER_DOCUMENT}").alias("doc_id"),
        "event_id", F.col("ts").cast("timestamp").alias("ingest_ts"))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.substring_index("text", "\n", 1).alias("title"))
    url = F.concat(F.lit("http://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"))
    return (
        dated(documents, spark, sf_dir, "doc_id")
        .join(events, "doc_id", "left")
        .withColumn("url", url)
        .select(
            F.concat_ws(" #", "title", F.col("event_id").cast("string")).alias("titre_article"),
            iso_utc("ts").alias("date_publication"),
            "source", "url", article_id(F.col("url")).alias("id"),
            F.lit(SCRAPED_AT).alias("scraped_at"),
            "ingest_ts", F.coalesce("event_id", F.lit(-1)).alias("src_offset"),
        )
    )


# Feeds list this many consecutive pages each, so a feed document stays small.
PAGES_PER_FEED = 20


# Added at the end of a page's article, in turn by page id, with the paragraphs it makes.
ADDED_MARKUP = [
    ('<p title="a>b">one</p>', ["one"]),
    ('<p>see <img alt="<p>no</p>">it</p>', ["see it"]),
    ("<p>before<textarea><p>typed</p></textarea>after</p>", ["before <p>typed</p> after"]),
    ("<p>a<div><p>b</div>c</p>", ["a", "b"]),
    ("<!-- <p>no</p> --><p>x<!-- > -->y</p>", ["x y"]),
    ("", []),
]


def _host():
    return F.regexp_extract("url", r"^https?://([^/]+)", 1)


def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the source whose rules read them, by page language, and with bylines and markup
    of several kinds."""
    pages = table(spark, sf_dir, "pages")
    lang = F.regexp_extract("html", r'<html lang="([a-z]+)"', 1)
    byline = (
        F.when((lang == "fr") & (F.col("page_id") % 2 == 0), F.concat(
            F.lit('<small class="by author"><i>by</i> <a href="/x?a>b"> '), _host(), F.lit(" </a></small>")))
        .when((lang != "fr") & (F.col("page_id") % 3 == 0), F.concat(
            F.lit('<div data-component="byline-block"><b>By</b> '), _host(), F.lit(" &amp; co</div>")))
        .when((lang != "fr") & (F.col("page_id") % 3 == 1), F.concat(
            F.lit("<span class='x ssrcss-68pt20-Text-TextContributorName'>"), _host(), F.lit("</span>")))
        .otherwise(""))
    added = F.get(F.array(*[F.lit(markup) for markup, _ in ADDED_MARKUP]),
                  (F.col("page_id") % len(ADDED_MARKUP)).cast("int"))
    html = F.replace("html", F.lit("<article"), F.concat(byline, F.lit("<article")))
    html = F.replace(html, F.lit("</article>"), F.concat(added, F.lit("</article>")))
    return pages.select(
        "page_id", "url", html.alias("html"), lang.alias("lang"),
        F.when(lang == "fr", "Hespress").otherwise("BBC News").alias("source"))


def _escaped(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _feed_date():
    """The date of a page in one of several forms, by page."""
    forms = ["EEE, dd MMM yyyy HH:mm:ss '+0000'", "d MMM yyyy h:mm:ss a", "dd-MMM-yyyy HH:mm:ss", "MMM d yyyy HH:mm:ss",
             "EEE MMM d HH:mm:ss yyyy", "EEEE d MMMM yyyy HH:mm:ss"]
    chosen = F.lit(None)
    for k, form in enumerate(forms):
        chosen = F.when(F.col("page_id") % len(forms) == k, F.date_format("ts", form)).otherwise(chosen)
    return chosen


def page_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS documents that list the pages: one per source and run of consecutive page ids."""
    titled = page_sources(spark, sf_dir).select(
        "page_id", "url", "lang", "source",
        F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"))
    pages = dated(titled, spark, sf_dir, "page_id")
    title = F.col("title")
    host = _host()
    # feeds in the other languages name no category
    categories = F.when(
        F.col("lang").isin("en", "es"),
        F.concat(F.lit("<category>"), "lang", F.lit("</category><category>"), host,
                 F.lit("</category>"))).otherwise("")
    item = F.concat(
        # an item in a comment, one named in a CDATA section, and an unclosed tag
        F.when(F.col("page_id") % 5 == 0, "<!-- <item><title>no</title><link>u</link></item> -->").otherwise(""),
        F.lit("<item><title><![CDATA[ "), title, F.lit(" ]]></title>"),
        F.lit("<link>"), _escaped(F.col("url")), F.lit("</link>"),
        F.coalesce(F.concat(F.lit("<pubDate>"), _feed_date(), F.lit("</pubDate>")), F.lit("")),
        categories,
        # some descriptions hold an ampersand and an entity that XML does not know
        F.lit("<description>"), F.when(F.col("page_id") % 3 == 0, "R&D&nbsp;")
        .when(F.col("page_id") % 3 == 1, "<![CDATA[<item>]]> <br>").otherwise(""),
        _escaped(title), F.lit("</description>"),
        F.lit("<dc:creator>"), host, F.lit("</dc:creator></item>"),
    )
    # a run of ids holds at most PAGES_PER_FEED items
    run = F.expr(f"page_id div {PAGES_PER_FEED}")
    listed = F.array_sort(F.collect_list(F.struct("page_id", "item")))
    return (
        pages.select("source", run.alias("run"), "page_id", item.alias("item"))
        .groupBy("source", "run").agg(listed.alias("listed"))
        .select(
            F.concat_ws("/", "source", "run").alias("feed_id"),
            "source",
            F.concat(
                F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'),
                F.array_join(F.col("listed.item"), ""),
                # every fourth document breaks off within an item, and others end with an item of nothing
                F.when(F.col("run") % 4 == 0, "<item><title>cut")
                .when(F.col("run") % 4 == 1, "<item>nothing</item></channel></rss>").otherwise("</channel></rss>"),
            ).alias("xml"),
        )
    )


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of one metric, a series for each event type."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit("event_value").alias("name"),
        F.create_map(F.lit("event_type"), F.col("event_type")).alias("labels"), "value")


def republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of a second load: labelled documents with a new category, and pages as new ids."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    url = F.concat(F.lit("http://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"))
    changed = documents.join(labels, "doc_id").select(
        article_id(url).alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("quality"), F.col("quality").cast("string"),
                 F.lit("-toxic"), F.col("toxic").cast("string")).alias("category"),
        url.alias("url"))
    added = table(spark, sf_dir, "pages").select(
        article_id(F.col("url")).alias("id"),
        F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"),
        F.lit("page").alias("category"), "url")
    return changed.unionByName(added)
