"""The scheduled jobs: silver to gold, gold to the warehouse."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.fixed_values import TOP_KEYWORDS_PER_DAY
from pressflow.operators.gold import (
    articles,
    articles_per_country,
    articles_per_day,
    articles_per_source,
    articles_per_theme,
    silver_view,
    top_keywords,
)
from pressflow.operators.latest import (
    LAYER_KEYS,
    first_per_stored_key,
    last_write,
    with_event_key,
)
from pressflow.operators.quality import assert_keys
from pressflow.schemas import GOLD, GOLD_KEYS, SILVER
from pressflow.session import remove_dir, working_dir
from pressflow.sinks.lake import write_observed
from pressflow.sinks.warehouse import (
    REPLACED,
    create_tables,
    jdbc_create,
    jdbc_replace,
    jdbc_upsert,
    merge_articles,
    show_articles,
    show_tables,
    write_tables,
)
from pressflow.sources.tables import read_layer

BUILDERS = {
    "articles_per_day": articles_per_day,
    "articles_per_source": articles_per_source,
    "articles_per_theme": articles_per_theme,
    "articles_per_country": articles_per_country,
    "top_keywords": top_keywords,
    "articles": articles,
}


def gold_tables(silver: DataFrame, countries: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All gold tables over one silver DataFrame, not yet run."""
    view = silver_view(silver, countries)
    return {name: build(view) for name, build in BUILDERS.items()}


def _summary(spark: SparkSession, counts: dict[str, int], started: float) -> DataFrame:
    row = {**counts, "elapsed_sec": round(time.time() - started, 2)}
    columns = ", ".join(f"{name} {'DOUBLE' if name == 'elapsed_sec' else 'BIGINT'}" for name in row)
    return spark.createDataFrame([tuple(row.values())], columns)


def build_gold(
    spark: SparkSession, silver_path: str, gold_path: str,
    countries: dict[str, str] | None = None, top_k: int = TOP_KEYWORDS_PER_DAY,
) -> DataFrame:
    """Rebuild every gold table from silver (O58) and return the row counts.

    The counts share one narrow table of what they group by, so silver is read for it, the keywords
    and the articles. Texts are shuffled only if the list of the keys that were delivered several
    times is too large to broadcast.
    """
    started = time.time()
    folder = working_dir(spark, "gold")

    def pick(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
        return first_per_stored_key(df, keys, order, folder)

    try:
        stored = with_event_key(read_layer(spark, silver_path, SILVER))
        silver = pick(stored, LAYER_KEYS, last_write()).drop("_event")
        view = silver_view(silver, countries)
        narrow = view.select("day", "source", "categorie", "country", "published_at")
        narrow.write.parquet(f"{folder}/counted")
        counted = spark.read.schema(narrow.schema).parquet(f"{folder}/counted")
        tables = {
            **{name: build(counted) for name, build in BUILDERS.items() if name.startswith("articles_per_")},
            "top_keywords": top_keywords(view, top_k),
            "articles": articles(view, pick),
        }
        counts = {
            name: write_observed(table, f"{gold_path}/{name}")["n_rows"]
            for name, table in tables.items()
        }
    finally:
        remove_dir(spark, folder)
    per_day = read_gold(spark, gold_path)["articles_per_day"]
    rows_silver = per_day.agg(F.coalesce(F.sum("n_articles"), F.lit(0))).first()[0]
    return _summary(spark, {"rows_silver": rows_silver, **counts}, started)


def read_gold(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    """The stored gold tables; a missing one is an error."""
    return {name: spark.read.schema(s).parquet(f"{gold_path}/{name}") for name, s in GOLD.items()}


def load_warehouse(
    spark: SparkSession, gold_path: str, database: str = "gold", load_ts: Column | None = None
) -> DataFrame:
    """Replace the aggregate tables and merge the articles (O60, O61); returns row counts.

    All tables are written before the first one is switched, so a load that fails shows nothing.
    """
    started = time.time()
    create_tables(spark, database)
    tables = read_gold(spark, gold_path)
    version = write_tables(spark, {name: tables[name] for name in REPLACED}, database)
    merge_articles(spark, tables["articles"], database, load_ts)
    show_tables(spark, REPLACED, version, database)
    show_articles(spark, database)
    counts = {name: spark.table(f"{database}.{name}").count() for name in GOLD}
    return _summary(spark, counts, started)


def load_database(
    spark: SparkSession, gold_path: str, url: str, properties: dict[str, str], database: str = "gold"
) -> None:
    """The same load into a database over JDBC: tables are created where they are missing (O59),
    aggregates replaced (O60) and articles merged (O61), each table in one transaction."""
    tables = read_gold(spark, gold_path)
    for name, rows in tables.items():
        assert_keys(rows, GOLD_KEYS[name], name)
    jdbc_create(spark, url, properties, database)
    for name in REPLACED:
        jdbc_replace(tables[name], url, f"{database}.{name}", properties)
    jdbc_upsert(tables["articles"], url, f"{database}.articles", GOLD_KEYS["articles"], properties)
