"""Schemas of every layer, as DDL strings Spark reads directly."""

RAW = """
    titre_article STRING, auteur STRING, date_publication STRING, categorie STRING,
    contenu STRING, source STRING, url STRING, id STRING, scraped_at STRING
"""
RAW_COLUMNS = [
    "titre_article", "auteur", "date_publication", "categorie", "contenu",
    "source", "url", "id", "scraped_at",
]

# Bronze keeps the event body verbatim beside its decoded fields, so no key is ever lost.
BRONZE = f"""
    value STRING, {RAW}, _corrupt STRING, ingest_ts TIMESTAMP, src_offset BIGINT,
    source_key STRING, dt DATE
"""

REJECTS = f"""
    {RAW}, value STRING, ingest_ts TIMESTAMP, src_offset BIGINT, dq_checked_at TIMESTAMP,
    dq_reason STRING, dt DATE
"""

SILVER = f"""
    {RAW}, language STRING, word_count INT, char_count INT, silver_processed_at TIMESTAMP,
    ingest_ts TIMESTAMP, src_offset BIGINT, source_key STRING, dt DATE
"""

# Silver as JSON objects, where the time is text.
SILVER_JSON = f"""
    {RAW}, language STRING, word_count INT, char_count INT, silver_processed_at STRING
"""

# Warehouse tables: columns with their SQL types, primary key, and columns that may not be null.
GOLD = {
    "articles": """
        id STRING, title STRING, author STRING, published_at TIMESTAMP, category STRING,
        source STRING, url STRING, language STRING, content STRING, word_count INT""",
    "articles_per_day": "day DATE, source STRING, n_articles BIGINT",
    "articles_per_source": "source STRING, n_articles BIGINT, last_seen_at TIMESTAMP",
    "articles_per_theme": "theme STRING, day DATE, n_articles BIGINT",
    "articles_per_country": "country STRING, day DATE, n_articles BIGINT",
    "top_keywords": "keyword STRING, day DATE, n_occurrences BIGINT",
}
GOLD_KEYS = {
    "articles": ["id"],
    "articles_per_day": ["day", "source"],
    "articles_per_source": ["source"],
    "articles_per_theme": ["theme", "day"],
    "articles_per_country": ["country", "day"],
    "top_keywords": ["keyword", "day"],
}
DQ_RESULTS = "run_at TIMESTAMP, check_name STRING, dimension STRING, passed BOOLEAN, details STRING"

METRICS = "ts TIMESTAMP, name STRING, labels MAP<STRING, STRING>, value DOUBLE"
