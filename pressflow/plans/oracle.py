"""The catalogue's queries in DuckDB SQL, for checking results on the same tables.

Each statement is put together from named common table expressions. The pages use four entities
and the articles one stretch of text that NFKC changes, so the SQL spells out just those.
"""

from __future__ import annotations

from pressflow.fixed_values import (
    KEYWORD_PATTERN,
    MAX_ITEMS_PER_FEED,
    MIN_CONTENT_CHARS,
    SOURCE_COUNTRY,
    STOPWORDS,
    TOP_KEYWORDS_PER_DAY,
    WHITESPACE,
    WHITESPACE_CHARS,
)
from pressflow.operators.language import BUCKETS, FACTORS
from pressflow.sources.sample import ADDED_MARKUP, PAGES_PER_FEED, SCRAPED_AT, SOURCE_NAMES, WIDE_TEXT

_blank = WHITESPACE_CHARS


def _strip(c: str) -> str:
    return f"trim({c}, '{_blank}')"


def _replace_all(c: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({c}, '{pattern}', '{by}', 'g')"


def _unescape(c: str) -> str:
    # HTML decodes these four with or without the semicolon; a cut-off title can lack it
    for name, char in [("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")]:
        c = _replace_all(c, f"&{name};?", char)
    return c


def _hidden(c: str) -> str:
    c = _replace_all(c, r"(?s)<!--.*?(?:-->|\z)")
    for tag in ("script", "style", "template"):
        c = _replace_all(c, rf"(?is)<{tag}(\s[^>]*)?>.*?(?:</{tag}(\s[^>]*)?>|\z)")
    return c


def _clean(c: str) -> str:
    text = _unescape(_replace_all(_hidden(f"coalesce({c}, '')"), r"(?s)<[!?/a-zA-Z][^>]*>"))
    text = f"replace({text}, '{WIDE_TEXT}', 'ABC fin')"
    text = _replace_all(text, f"https?://[^{WHITESPACE}]+")
    return f"trim({_replace_all(text, f'[{WHITESPACE}]+')})"


def _words(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN 0 ELSE len(string_split({c}, ' ')) END::INTEGER"


def _letters(c: str) -> str:
    padded = f"' ' || lower({c}) || ' '"
    return _replace_all(padded, r"[^\p{L}\p{M}]+")


_quoted_stopwords = ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS)
_added = " ".join(f"WHEN {k} THEN {texts}" for k, (_, texts) in enumerate(ADDED_MARKUP) if texts)
_host = "regexp_extract(url, '^https?://([^/]+)', 1)"
_countries = " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in SOURCE_COUNTRY.items())
_names = " ".join(f"WHEN '{s}' THEN '{name}'" for s, name in SOURCE_NAMES.items())
_url = "'http://' || d.source || '.example.com/' || d.doc_id"

CTES = {
    "dated": """
        SELECT e.event_id // 10 AS doc_id, e.ts + INTERVAL 1 DAY * unnest(
            CASE WHEN e.event_id % 60 = 0 THEN [0, 1] ELSE [0] END) AS ts
        FROM events e WHERE e.event_id % 10 = 0""",
    # the written form, the instant it stands for and the calendar day it shows
    "raw": f"""
        SELECT CASE WHEN d.doc_id % 50 = 7 THEN chr(160) || ' ' || chr(12288) ELSE split_part(d.text, chr(10), 1) END
                   AS titre_article,
               NULL::VARCHAR AS auteur,
               CASE WHEN d.doc_id % 50 = 11 THEN '' WHEN d.doc_id % 50 = 13 THEN '2024-02-30'
                    WHEN d.doc_id % 7 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                    WHEN d.doc_id % 7 = 2 THEN strftime(ts, '%Y-%m-%d')
                    WHEN d.doc_id % 7 = 3 THEN strftime(ts, '%Y%m%d')
                    WHEN d.doc_id % 7 = 4
                        THEN strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+01:30'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS date_publication,
               CASE WHEN d.doc_id % 50 IN (11, 13) THEN NULL
                    WHEN d.doc_id % 7 = 1 THEN date_trunc('second', ts)
                    WHEN d.doc_id % 7 IN (2, 3) THEN date_trunc('day', ts) ELSE ts END AS published_at,
               CASE WHEN d.doc_id % 7 = 4 THEN ts + INTERVAL 90 MINUTE ELSE ts END::DATE AS shown,
               'quality' || l.quality AS categorie,
               d.text || CASE WHEN d.doc_id % 4 = 0 THEN ' ' || {_url} || ' {WIDE_TEXT}' ELSE '' END
                   AS contenu,
               CASE d.source {_names} ELSE d.source END AS source, {_url} AS url, sha1({_url}) AS id,
               '{SCRAPED_AT}' AS scraped_at
        FROM documents d
        LEFT JOIN dated e ON e.doc_id = d.doc_id
        LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "tagged": f"""
        SELECT *, CASE
            WHEN coalesce({_strip('titre_article')}, '') = '' THEN 'missing_title'
            WHEN coalesce(date_publication, '') = '' THEN 'missing_date'
            WHEN published_at IS NULL THEN 'invalid_date'
            WHEN length(coalesce({_strip('contenu')}, '')) < {MIN_CONTENT_CHARS}
                THEN 'content_too_short' END AS dq_reason,
            coalesce(nullif(trim({_replace_all('source', '[^A-Za-z0-9_-]+', '_')}, '_'), ''),
                     'unknown') AS source_key,
            CASE WHEN coalesce(date_publication, '') = '' THEN left(scraped_at, 10)::DATE
                 WHEN published_at IS NULL THEN DATE '2024-01-31' ELSE shown END AS dt
        FROM raw""",
    "cleaned": f"""
        SELECT id, auteur, published_at, categorie, source, url, source_key, dt,
               {_clean('titre_article')} AS titre_article, {_clean('contenu')} AS contenu
        FROM tagged WHERE dq_reason IS NULL""",
    "silver": f"""
        SELECT *, {_words('contenu')} AS word_count, length(contenu)::INTEGER AS char_count
        FROM cleaned""",
    "viewed": f"""
        SELECT *, published_at::DATE AS day,
               coalesce(categorie, 'Uncategorized') AS theme,
               CASE source {_countries} ELSE 'XX' END AS country
        FROM silver""",
    "articles_per_day": """
        SELECT day, source, count(*) AS n_articles FROM viewed GROUP BY ALL""",
    "articles_per_source": """
        SELECT source, count(*) AS n_articles, max(published_at) AS last_seen_at
        FROM viewed GROUP BY ALL""",
    "articles_per_theme": """
        SELECT theme, day, count(*) AS n_articles FROM viewed GROUP BY ALL""",
    "articles_per_country": """
        SELECT country, day, count(*) AS n_articles FROM viewed GROUP BY ALL""",
    "tokens": f"""
        SELECT day, lower(unnest(regexp_extract_all(
            titre_article || ' ' || contenu, '{KEYWORD_PATTERN}'))) AS keyword FROM viewed""",
    "keyword_counts": f"""
        SELECT day, keyword, count(*) AS n_occurrences FROM tokens
        WHERE keyword NOT IN ({_quoted_stopwords}) GROUP BY ALL""",
    "top_keywords": f"""
        SELECT keyword, day, n_occurrences FROM keyword_counts
        QUALIFY row_number() OVER (PARTITION BY day ORDER BY n_occurrences DESC, keyword)
                <= {TOP_KEYWORDS_PER_DAY}""",
    # language: trigram buckets of the labelled documents, then of the articles
    "doc_chars": f"""
        SELECT lang, list_transform(regexp_extract_all({_letters('text')}, '(?s).'),
                                    lambda x: unicode(x)) AS c
        FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL""",
    "doc_grams": f"""
        SELECT lang, unnest(list_transform(range(1, len(c) - 1), lambda i:
            (c[i] * {FACTORS[0]} + c[i + 1] * {FACTORS[1]} + c[i + 2]) % {BUCKETS})) AS bucket
        FROM doc_chars""",
    "counts": "SELECT lang, bucket::INTEGER AS bucket, count(*) AS n FROM doc_grams GROUP BY ALL",
    "totals": "SELECT lang, sum(n)::BIGINT AS n_lang FROM counts GROUP BY lang",
    "profile": f"""
        SELECT lang, bucket, n, ln((n + 1.0) / (n_lang + {BUCKETS})) AS logp,
               ln(1.0 / (n_lang + {BUCKETS})) AS unseen
        FROM counts JOIN totals USING (lang)""",
    "article_letters": f"""
        SELECT id, CASE
            WHEN length(contenu) >= 20 AND regexp_matches(contenu, '\\p{{L}}')
                THEN {_letters('contenu')}
            WHEN length(titre_article) >= 20 AND regexp_matches(titre_article, '\\p{{L}}')
                THEN {_letters('titre_article')} END AS letters
        FROM silver""",
    "article_chars": """
        SELECT id, list_transform(regexp_extract_all(letters, '(?s).'), lambda x: unicode(x)) AS c
        FROM article_letters WHERE letters IS NOT NULL""",
    "article_grams": f"""
        SELECT id, unnest(list_transform(range(1, len(c) - 1), lambda i:
            (c[i] * {FACTORS[0]} + c[i + 1] * {FACTORS[1]} + c[i + 2]) % {BUCKETS})) AS bucket
        FROM article_chars""",
    "article_counts": "SELECT id, bucket, count(*) AS m FROM article_grams GROUP BY ALL",
    "scores": f"""
        SELECT s.id, t.lang, s.m * ln(1.0 / (t.n_lang + {BUCKETS})) + coalesce(a.gain, 0) AS score
        FROM (SELECT id, sum(m) AS m FROM article_counts GROUP BY id) s
        CROSS JOIN totals t
        LEFT JOIN (SELECT c.id, p.lang, sum(c.m * (p.logp - p.unseen)) AS gain
                   FROM article_counts c JOIN profile p USING (bucket) GROUP BY ALL) a
          ON a.id = s.id AND a.lang = t.lang""",
    "languages": """
        SELECT DISTINCT silver.id, best.lang AS language FROM silver
        LEFT JOIN (SELECT id, arg_max(lang, score) AS lang FROM scores GROUP BY id) best
          ON best.id = silver.id""",
    "articles": """
        SELECT v.id, titre_article AS title, auteur AS author, published_at, theme AS category,
               source, url, coalesce(g.language, 'unknown') AS language, contenu AS content,
               word_count
        FROM viewed v JOIN languages g ON g.id = v.id
        QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY
            'source=' || source_key || '/dt=' || dt || '/' || v.id || '.json') = 1""",
    # pages and feeds
    "sourced_pages": """
        SELECT page_id, url, html, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
               CASE regexp_extract(html, '<html lang="([a-z]+)"', 1)
                    WHEN 'fr' THEN 'Hespress' ELSE 'BBC News' END AS source
        FROM pages""",
    "page_blocks": f"""
        SELECT page_id, source, url, contains(html, '</article>') AS has_article, list_transform(
            string_split_regex(
                regexp_extract({_hidden('html')}, '(?is)<article(\\s[^>]*)?>(.*?)</article\\s*>', 2),
                '(?i)<p(\\s[^>]*)?>')[2:],
            lambda p: {_replace_all('p', '(?is)</p[\\s>].*', '')}) AS blocks
        FROM sourced_pages""",
    "page_texts": f"""
        SELECT page_id, source, url,
               CASE WHEN NOT has_article THEN NULL
                    WHEN source = 'Hespress' THEN CASE WHEN page_id % 2 = 0 THEN {_host} END
                    WHEN page_id % 3 = 0 THEN 'By ' || {_host} || ' & co'
                    WHEN page_id % 3 = 1 THEN {_host} END AS author,
               list_concat(list_transform(blocks, lambda b: {_unescape(f'''
            array_to_string(list_filter(list_transform(
                string_split_regex(b, '(?s)<[!?/a-zA-Z][^>]*>'),
                lambda t: {_strip('t')}), lambda t: t <> ''), ' ')''')}), CASE WHEN has_article THEN
                   CASE page_id % {len(ADDED_MARKUP)} {_added} ELSE []::VARCHAR[] END END) AS paragraphs
        FROM page_blocks""",
    "listed": f"""
        SELECT p.source || '/' || (page_id // {PAGES_PER_FEED}) AS feed_id, source,
               (row_number() OVER feed - 1)::INTEGER AS position,
               {_strip("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS title,
               url, CASE page_id % 6 WHEN 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0000'
                    WHEN 1 THEN strftime(ts, '%-d %b %Y %-I:%M:%S %p') WHEN 2 THEN strftime(ts, '%d-%b-%Y %H:%M:%S')
                    WHEN 3 THEN strftime(ts, '%b %-d %Y %H:%M:%S') WHEN 4 THEN strftime(ts, '%a %b %-d %H:%M:%S %Y')
                    ELSE strftime(ts, '%A %-d %B %Y %H:%M:%S') END AS pub_date, ts,
               CASE WHEN lang IN ('en', 'es') THEN lang WHEN lang = 'fr' THEN NULL
                    ELSE 'News' END AS category,
               {_strip("CASE page_id % 3 WHEN 0 THEN 'R&D' || chr(160) WHEN 1 THEN '<item> ' ELSE '' END || "
                       "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS summary,
               CASE source WHEN 'Hespress' THEN regexp_extract(url, '^https?://([^/]+)', 1)
                    END AS author
        FROM sourced_pages p LEFT JOIN events e ON e.event_id = p.page_id * 10
        WINDOW feed AS (PARTITION BY source, page_id // {PAGES_PER_FEED} ORDER BY page_id)""",
    "items": f"SELECT * FROM listed WHERE position < {MAX_ITEMS_PER_FEED}",
    # events as samples of their values
    "grown": """
        SELECT event_type, ts, CASE WHEN value < lag(value) OVER w THEN value
                                    ELSE value - lag(value) OVER w END AS increase
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)
        QUALIFY lag(ts) OVER w IS NOT NULL""",
}

# What each expression reads.
READS = {
    "dated": [], "raw": ["dated"], "tagged": ["raw"], "cleaned": ["tagged"], "silver": ["cleaned"],
    "viewed": ["silver"], "articles_per_day": ["viewed"], "articles_per_source": ["viewed"],
    "articles_per_theme": ["viewed"], "articles_per_country": ["viewed"], "tokens": ["viewed"],
    "keyword_counts": ["tokens"], "top_keywords": ["keyword_counts"],
    "doc_chars": [], "doc_grams": ["doc_chars"], "counts": ["doc_grams"], "totals": ["counts"],
    "profile": ["counts", "totals"], "article_letters": ["silver"],
    "article_chars": ["article_letters"], "article_grams": ["article_chars"],
    "article_counts": ["article_grams"], "scores": ["article_counts", "profile"],
    "languages": ["silver", "scores"], "articles": ["viewed", "languages"],
    "sourced_pages": [], "page_blocks": ["sourced_pages"], "page_texts": ["page_blocks"],
    "listed": ["sourced_pages"], "items": ["listed"], "grown": [],
}


def _with(last: str, query: str, *more: str) -> str:
    """``query`` after the expressions it needs, in the order of CTES."""
    needed, todo = set(), [last, *more]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += READS[name]
    # evaluated once each, as a view would be read several times over
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in needed]
    return "WITH " + ",\n".join(parts) + "\n" + query


def _gold_rows() -> str:
    return _with("top_keywords", """
        SELECT 'articles_per_day' AS table_name, day, source AS key, n_articles AS n FROM articles_per_day
        UNION ALL SELECT 'articles_per_source', last_seen_at::DATE, source, n_articles FROM articles_per_source
        UNION ALL SELECT 'articles_per_theme', day, theme, n_articles FROM articles_per_theme
        UNION ALL SELECT 'articles_per_country', day, country, n_articles FROM articles_per_country
        UNION ALL SELECT 'top_keywords', day, keyword, n_occurrences FROM top_keywords
        UNION ALL SELECT 'articles', published_at::DATE, id, word_count::BIGINT FROM (
            SELECT * FROM viewed QUALIFY row_number() OVER (PARTITION BY id ORDER BY
                'source=' || source_key || '/dt=' || dt || '/' || id || '.json') = 1)""",
        "articles_per_day", "articles_per_source", "articles_per_theme", "articles_per_country")


_since_7 = "day >= DATE '2024-01-30' - 7"
_since_30 = "day >= DATE '2024-01-30' - 30"


def _trending(limit: int, days_seen: bool = False) -> str:
    extra = ", count(DISTINCT day) AS days_seen" if days_seen else ""
    return _with("top_keywords", f"""
        SELECT keyword, sum(n_occurrences)::BIGINT AS total_occurrences{extra}
        FROM top_keywords WHERE {_since_7}
        GROUP BY keyword ORDER BY total_occurrences DESC, keyword LIMIT {limit}""")


def _latest(columns: str, limit: int) -> str:
    return _with("articles", f"""
        SELECT {columns} FROM (SELECT * FROM articles
        ORDER BY published_at DESC NULLS LAST, id LIMIT {limit})""")


def _gate_rows() -> str:
    reached, rows = "n_total", []
    for gate, dimension in [("missing_title", "completeness"), ("missing_date", "completeness"),
                            ("invalid_date", "validity"), ("content_too_short", "validity")]:
        rows.append(f"""
            SELECT TIMESTAMP '2024-01-31' AS run_at, '{gate}' AS check_name,
                   '{dimension}' AS dimension, {gate} = 0 AS passed,
                   '{{"n_checked":' || ({reached}) || ',"n_failed":' || {gate} || '}}' AS details
            FROM failed""")
        reached += f" - {gate}"
    counted = ", ".join(
        f"count(*) FILTER (dq_reason = '{g}') AS {g}"
        for g in ("missing_title", "missing_date", "invalid_date", "content_too_short"))
    return (_with("tagged", "SELECT * FROM (WITH failed AS (SELECT count(*) AS n_total, "
                  f"{counted} FROM tagged) {' UNION ALL '.join(rows)})"))


_delivered = f"""
    SELECT d.source AS source_key, coalesce(first.ts::DATE, left('{SCRAPED_AT}', 10)::DATE) AS dt,
           sha1({_url}) AS id,
           concat_ws(' #', split_part(d.text, chr(10), 1), e.event_id) AS titre_article,
           e.ts AS ingest_ts, coalesce(e.event_id, -1) AS src_offset
    FROM documents d
    LEFT JOIN events first ON first.event_id = d.doc_id * 10
    LEFT JOIN events e ON e.event_id // 10 = d.doc_id"""

_language_columns = "s.id, titre_article, contenu, language, word_count, char_count, source_key, dt"

ORACLE = {
    "dq_tagged": _with("tagged", "SELECT id, dq_reason FROM tagged"),
    "dq_summary": _with("tagged", """
        SELECT coalesce(dq_reason, 'ok') AS outcome, count(*) AS n_events FROM tagged GROUP BY 1"""),
    "dq_results": _gate_rows(),
    "rejects": _with("tagged", """
        SELECT id, source, titre_article, contenu, dq_reason,
               TIMESTAMP '2024-01-31' AS dq_checked_at, dt FROM tagged
        WHERE dq_reason IS NOT NULL"""),
    "silver_clean": _with("languages", f"""
        SELECT {_language_columns}, categorie FROM silver s JOIN languages g ON g.id = s.id"""),
    "silver_counts": _with("silver", """
        SELECT source, sum(word_count)::BIGINT AS n_words, sum(char_count)::BIGINT AS n_chars
        FROM silver GROUP BY source"""),
    "partition_keys": _with("tagged", """
        SELECT source_key, dt, count(*) AS n_events FROM tagged GROUP BY ALL"""),
    "bronze_latest": f"""
        SELECT source_key, dt, id, titre_article, src_offset FROM ({_delivered})
        QUALIFY row_number() OVER (PARTITION BY source_key, dt, id
                                   ORDER BY ingest_ts DESC, src_offset DESC) = 1""",
    "articles_per_day": _with("articles_per_day", "SELECT * FROM articles_per_day"),
    "articles_per_source": _with("articles_per_source", "SELECT * FROM articles_per_source"),
    "articles_per_theme": _with("articles_per_theme", "SELECT * FROM articles_per_theme"),
    "articles_per_country": _with("articles_per_country", "SELECT * FROM articles_per_country"),
    "keyword_counts": _with("keyword_counts", "SELECT * FROM keyword_counts"),
    "top_keywords": _with("top_keywords", "SELECT * FROM top_keywords"),
    "articles": _with("articles", "SELECT * FROM articles"),
    "articles_upsert": _with("silver", f"""
        , updates AS (
            SELECT sha1({_url}) AS id, split_part(d.text, chr(10), 1) AS title,
                   'quality' || quality || '-toxic' || toxic AS category, {_url} AS url
            FROM documents d JOIN labels USING (doc_id)
            UNION ALL
            SELECT sha1(url), regexp_extract(html, '(?is)<title>(.*?)</title>', 1), 'page', url
            FROM pages)
        SELECT id, titre_article AS title, coalesce(categorie, 'Uncategorized') AS category, url,
               TIMESTAMP '2024-02-01' AS ingested_at
        FROM silver WHERE id NOT IN (SELECT id FROM updates)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY dt) = 1
        UNION ALL
        SELECT id, title, category, url, TIMESTAMP '2024-02-02' FROM updates"""),
    "articles_merge": _with("silver", """
        , stored AS (
            SELECT id, titre_article AS title, coalesce(categorie, 'Uncategorized') AS category,
                   published_at >= TIMESTAMP '2024-01-30' AS again,
                   (('0x' || left(md5(id), 8))::BIGINT % 1024)::INTEGER AS bucket
            FROM silver QUALIFY row_number() OVER (PARTITION BY id ORDER BY dt) = 1)
        SELECT id, title, CASE WHEN again THEN 'revised' ELSE category END AS category,
               CASE WHEN again THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS ingested_at,
               CASE WHEN bool_or(again) OVER (PARTITION BY bucket) THEN 2 ELSE 1 END::INTEGER AS version, bucket
        FROM stored"""),
    "pk_violations": f"""
        SELECT id, count(*) AS n_rows FROM ({_delivered}) GROUP BY id
        HAVING count(*) > 1 OR id IS NULL""",
    "trending_7d": _trending(25, days_seen=True),
    "trending_7d_top25": _trending(25),
    "trending_7d_top30": _trending(30),
    "trending_7d_top10": _trending(10),
    "trending_series": _with("top_keywords", f"""
        , top10 AS (SELECT keyword FROM top_keywords WHERE {_since_7} GROUP BY keyword
                    ORDER BY sum(n_occurrences) DESC, keyword LIMIT 10)
        SELECT day, keyword, n_occurrences FROM top_keywords JOIN top10 USING (keyword)
        WHERE {_since_7}"""),
    "source_ranking": _with("articles_per_source", "SELECT * FROM articles_per_source"),
    "source_daily_30d": _with("articles_per_day", f"""
        SELECT * FROM articles_per_day WHERE {_since_30}"""),
    "keywords_all_time": _with("top_keywords", """
        SELECT keyword, sum(n_occurrences)::BIGINT AS n_occurrences FROM top_keywords
        GROUP BY keyword ORDER BY n_occurrences DESC, keyword LIMIT 50"""),
    "keywords_all_time_exact": _with("keyword_counts", """
        SELECT keyword, sum(n_occurrences)::BIGINT AS n_occurrences FROM keyword_counts
        GROUP BY keyword ORDER BY n_occurrences DESC, keyword LIMIT 50"""),
    "daily_totals": _with("articles_per_day", """
        SELECT day, sum(n_articles)::BIGINT AS total_articles FROM articles_per_day GROUP BY day"""),
    "themes_7d": _with("articles_per_theme", f"""
        SELECT theme, sum(n_articles)::BIGINT AS n_articles FROM articles_per_theme
        WHERE {_since_7} GROUP BY theme ORDER BY n_articles DESC, theme LIMIT 15"""),
    "countries_30d": _with("articles_per_country", f"""
        SELECT country, sum(n_articles)::BIGINT AS n_articles FROM articles_per_country
        WHERE {_since_30} GROUP BY country"""),
    "kpi_total": _with("viewed", "SELECT count(DISTINCT id) AS total_articles FROM viewed"),
    "kpi_sources": _with("articles_per_source",
                         "SELECT count(*) AS active_sources FROM articles_per_source"),
    "kpi_last_24h": _with("viewed", """
        SELECT count(*) AS last_24h FROM (SELECT id, min_by(published_at, dt) AS published_at
                                           FROM viewed GROUP BY id)
        WHERE published_at >= TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR"""),
    "kpi_last_1h": _with("viewed", """
        SELECT count(*) AS last_1h FROM (SELECT id, min_by(published_at, dt) AS published_at
                                           FROM viewed GROUP BY id)
        WHERE published_at >= TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR"""),
    "language_distribution": _with("articles", """
        SELECT language, count(*) AS n_articles FROM articles GROUP BY language"""),
    "latest_articles": _latest("published_at, source, category, language, title, url", 100),
    "latest_articles_short": _latest("published_at, source, language, title", 50),
    "html_strip": f"""
        SELECT page_id, text, {_words('text')} AS word_count
        FROM (SELECT page_id, {_clean('html')} AS text FROM pages)""",
    "page_paragraphs": _with("page_texts", """
        SELECT page_id, len(paragraphs)::INTEGER AS n_paragraphs,
               array_to_string(paragraphs, chr(10)) AS body, author
        FROM page_texts"""),
    "feed_items": _with("items", "SELECT * EXCLUDE (ts) FROM items"),
    "feed_rejects": _with("sourced_pages", f"""
        SELECT source || '/' || (page_id // {PAGES_PER_FEED}) AS feed_id, source,
               count(*)::INTEGER AS position,
               CASE page_id // {PAGES_PER_FEED} % 4 WHEN 0 THEN 'cut_off' ELSE 'unreadable_item' END AS reason
        FROM sourced_pages WHERE page_id // {PAGES_PER_FEED} % 4 IN (0, 1)
        GROUP BY source, page_id // {PAGES_PER_FEED}"""),
    "page_article_events": _with("listed", f"""
        SELECT title AS titre_article, coalesce(i.author, t.author) AS auteur,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS date_publication,
               category AS categorie,
               {_strip("coalesce(nullif(array_to_string(paragraphs, chr(10)), ''), summary)")} AS contenu,
               i.source, i.url, sha1(i.url) AS id, '{SCRAPED_AT}' AS scraped_at
        FROM listed i LEFT JOIN page_texts t ON t.url = i.url AND t.source = i.source
        WHERE title <> ''""", "page_texts"),
    "lang_profile": _with("profile", """
        SELECT lang, bucket, n, round(logp, 6) AS logp FROM profile"""),
    "lang_detect": _with("languages", """
        SELECT s.id, language FROM silver s JOIN languages g ON g.id = s.id"""),
    "event_value_growth_5m": _with("grown", """
        SELECT ts, round(sum(increase) / 300, 6) AS rate
        FROM (SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE * unnest(range(1, 6)) AS ts, increase
              FROM grown)
        GROUP BY ts"""),
    "event_value_growth_by_type": _with("grown", """
        SELECT time_bucket(INTERVAL 2 MINUTE, ts) + INTERVAL 2 MINUTE AS ts, event_type,
               round(sum(increase) / 120, 6) AS rate
        FROM grown WHERE regexp_full_match(event_type, 'click|view|purch.*|sign') GROUP BY 1, 2"""),
    "event_value_latest": """
        SELECT event_type, arg_max(value, ts) AS value FROM events
        WHERE regexp_full_match(event_type, 'click|view|purch.*|sign') GROUP BY 1""",
    "event_value_latest_total": """
        SELECT round(sum(value), 6) AS value FROM (SELECT arg_max(value, ts) AS value FROM events GROUP BY event_type)""",
    "stream_bronze": _with("raw", """
        SELECT id, titre_article, NULL AS unread FROM raw
        WHERE regexp_extract(url, '([0-9]+)$', 1)::BIGINT % 25 NOT IN (3, 5)
        UNION ALL SELECT NULL, titre_article, NULL FROM raw
        WHERE regexp_extract(url, '([0-9]+)$', 1)::BIGINT % 25 = 5
        UNION ALL SELECT DISTINCT NULL, NULL, titre_article FROM raw
        WHERE regexp_extract(url, '([0-9]+)$', 1)::BIGINT % 25 = 3"""),
    "dq_history": _with("tagged", """
        , bodies AS (
            SELECT *, (regexp_extract(url, '([0-9]+)$', 1)::BIGINT % 25) AS number FROM tagged),
        batches AS (
            -- a body that is no JSON holds no category
            SELECT CASE WHEN number <> 3 AND categorie IS NULL THEN 1 ELSE 0 END::BIGINT AS batch_id,
                   number <> 3 AS is_json, dq_reason FROM bodies),
        gates AS (SELECT unnest([1, 2, 3, 4]) AS place,
                  unnest(['missing_title', 'missing_date', 'invalid_date', 'content_too_short']) AS check_name,
                  unnest(['completeness', 'completeness', 'validity', 'validity']) AS dimension),
        failed AS (
            SELECT batch_id, place, check_name, dimension,
                   count(*) FILTER (is_json AND dq_reason = check_name) AS n_failed,
                   any_value(n) AS n
            FROM gates, batches JOIN (SELECT batch_id, count(*) FILTER (is_json) AS n FROM batches GROUP BY batch_id)
                 USING (batch_id) GROUP BY ALL),
        kept AS (
            SELECT count(*) AS n FROM (
                SELECT DISTINCT source_key, dt, CASE WHEN number = 3 THEN titre_article
                    WHEN number = 5 THEN titre_article || contenu || date_publication || coalesce(categorie, '') || url
                    ELSE id END AS event, number = 3 AS is_text
                FROM (SELECT * REPLACE (CASE WHEN number = 3 THEN 'unknown' ELSE source_key END AS source_key,
                                        CASE WHEN number = 3 THEN NULL ELSE dt END AS dt) FROM bodies)))
        SELECT batch_id, check_name, dimension, n_failed = 0 AS passed,
               n - coalesce(sum(n_failed) OVER (PARTITION BY batch_id ORDER BY place
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n_checked,
               n_failed, (SELECT n FROM kept) AS n_bronze
        FROM failed"""),
    "stream_continuous": _with("silver", "SELECT id, source_key, dt, word_count FROM silver"),
    "gold_summary": _with("top_keywords", """
        SELECT (SELECT count(*) FROM viewed) AS rows_silver,
               (SELECT count(*) FROM articles_per_day) AS articles_per_day,
               (SELECT count(*) FROM articles_per_source) AS articles_per_source,
               (SELECT count(*) FROM articles_per_theme) AS articles_per_theme,
               (SELECT count(*) FROM articles_per_country) AS articles_per_country,
               (SELECT count(*) FROM top_keywords) AS top_keywords,
               (SELECT count(DISTINCT id) FROM viewed) AS articles""",
        "articles_per_day", "articles_per_source", "articles_per_theme", "articles_per_country"),
    "gold_tables": _gold_rows(),
    "gold_incremental": _gold_rows(),
    "warehouse_load": _with("top_keywords", """
        SELECT (SELECT count(DISTINCT id) FROM viewed) AS articles,
               (SELECT count(*) FROM articles_per_day) AS articles_per_day,
               (SELECT count(*) FROM articles_per_source) AS articles_per_source,
               (SELECT count(*) FROM articles_per_theme) AS articles_per_theme,
               (SELECT count(*) FROM articles_per_country) AS articles_per_country,
               (SELECT count(*) FROM top_keywords) AS top_keywords""",
        "articles_per_day", "articles_per_source", "articles_per_theme", "articles_per_country"),
    "missing_table": "SELECT doc_id, quality, toxic FROM labels",
    "stream_ingest": _with("languages", f"""
        SELECT {_language_columns} FROM silver s JOIN languages g ON g.id = s.id"""),
    "stream_rejects": _with("tagged", """
        SELECT id, titre_article, contenu, dq_reason FROM tagged WHERE dq_reason IS NOT NULL"""),
    "stream_daily_counts": _with("articles_per_day", "SELECT * FROM articles_per_day"),
    "stream_daily_counts_net": _with("viewed", """
        SELECT day, source, count(*) AS n_articles FROM (
            SELECT day, source FROM viewed QUALIFY row_number() OVER (PARTITION BY id ORDER BY published_at DESC) = 1)
        GROUP BY day, source"""),
    "stream_message_rate": """
        SELECT ts, round(count(*) / 300, 6) AS rate
        FROM (SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE * unnest(range(1, 6)) AS ts
              FROM events)
        GROUP BY ts""",
}

# The same results, gained another way.
ORACLE["keywords_all_time_certified"] = ORACLE["keywords_all_time_exact"]
ORACLE["stream_counter_rate"] = ORACLE["event_value_growth_by_type"]
