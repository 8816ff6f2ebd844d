"""Gold kept up to date by the dates a batch touches.

Silver lies in folders by the date as written, and the last write of an event is picked within its
date, so whatever a batch changes, it changes for its own dates only. For each date gold keeps
partial results: counts per day and source, theme and country, keyword counts, and the articles.
Partials of different dates add up, so the tables are sums over them, and an update computes the
partials of the touched dates anew and leaves all others as they are. Batches that come late or
correct earlier ones need nothing more.

A date as written and its UTC day are at most one day apart, so a day's keywords are ranked from
the partials of three dates.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressflow.fixed_values import TOP_KEYWORDS_PER_DAY
from pressflow.functions.keys import silver_key
from pressflow.operators.gold import daily_tokens, silver_view
from pressflow.operators.latest import first_per_key, latest_stored_version
from pressflow.schemas import GOLD, SILVER
from pressflow.session import list_dirs, remove_dir, working_dir
from pressflow.sinks.commits import newest_commit
from pressflow.sinks.lake import MAX_ROWS_PER_FILE
from pressflow.sources.tables import read_layer

#: Partial results by date as written: one for each table that sums over them.
PARTIALS = {
    "per_day": "day DATE, source STRING, n_articles BIGINT, last_seen_at TIMESTAMP",
    "per_theme": "theme STRING, day DATE, n_articles BIGINT",
    "per_country": "country STRING, day DATE, n_articles BIGINT",
    "keywords": "keyword STRING, day DATE, n_occurrences BIGINT",
    "articles": f"{GOLD['articles']}, _listing STRING",
}

#: What articles are counted by.
FACTS = ["dt", "day", "source", "categorie", "country", "published_at"]


def _partials(silver: DataFrame, countries: dict[str, str] | None, folder: str) -> dict[str, DataFrame]:
    """Partials of the current ``silver`` articles. What articles are counted by is read once and kept
    in ``folder``, which must live as long as the results."""
    view = silver_view(silver, countries)
    view.select(*FACTS).write.parquet(f"{folder}/facts")
    facts = silver.sparkSession.read.schema(view.select(*FACTS).schema).parquet(f"{folder}/facts")
    counted = F.count(F.lit(1)).alias("n_articles")
    listed = view.withColumn("_listing", silver_key(F.col("source_key"), F.col("dt"), F.col("id")))
    return {
        "per_day": facts.groupBy("dt", "day", "source").agg(counted, F.max("published_at").alias("last_seen_at")),
        "per_theme": facts.groupBy("dt", F.col("categorie").alias("theme"), "day").agg(counted),
        "per_country": facts.groupBy("dt", "country", "day").agg(counted),
        "keywords": daily_tokens(view, "dt").groupBy("dt", "keyword", "day").agg(
            F.count(F.lit(1)).alias("n_occurrences")),
        "articles": first_per_key(listed, ["dt", "id"], [F.col("_listing")]).select(
            "dt", "id", F.col("titre_article").alias("title"), F.col("auteur").alias("author"), "published_at",
            F.col("categorie").alias("category"), "source", "url", "language", F.col("contenu").alias("content"),
            "word_count", "_listing"),
    }


@dataclass
class IncrementalGold:
    """Gold below ``path`` from the silver layer of the lake at ``root``."""

    root: str
    path: str
    countries: dict[str, str] | None = None

    def _applied(self, spark: SparkSession) -> int:
        done = list_dirs(spark, f"{self.path}/applied/batch_id=*/_SUCCESS")
        return max((int(p.rsplit("batch_id=", 1)[1].split("/")[0]) for p in done), default=-1)

    def touched(self, spark: SparkSession, after: int, up_to: int) -> list[date]:
        """Dates with rows of the batches ``after`` < n <= ``up_to``, from the names of folders.

        Where some of these batches were merged meanwhile, all dates of the merged batch count.
        """
        found, folders = set(), {}
        for folder in list_dirs(spark, f"{self.root}/silver/batch_id=*"):
            folders[int(folder.rsplit("=", 1)[1])] = folder
        # a batch without a silver folder had no article, or was merged into one below zero
        wanted = set(range(after + 1, up_to + 1))
        if not wanted <= folders.keys():
            wanted |= {n for n in folders if n < 0}
        for n in wanted & folders.keys():
            found |= {p.rsplit("dt=", 1)[1] for p in list_dirs(spark, f"{folders[n]}/source_key=*/dt=*")}
        return sorted(date.fromisoformat(d) for d in found)

    def update(self, spark: SparkSession) -> list[date]:
        """Bring gold up to the newest batch that counts; returns the dates it computed anew.

        The record of the batch is written last. An update that stops before computes the same dates
        again the next time; each date's partials are replaced as a whole.
        """
        newest = newest_commit(spark, self.root)
        applied = self._applied(spark)
        if newest is None or newest <= applied:
            return []
        dates = self.touched(spark, applied, newest)
        if dates:
            layer = read_layer(spark, f"{self.root}/silver", SILVER)
            folder = working_dir(spark, "update")
            try:
                # deliveries are ranked once, by their keys: texts are not shuffled for it
                silver = latest_stored_version(layer.where(F.col("dt").isin(dates)), folder)
                for name, rows in _partials(silver, self.countries, folder).items():
                    (
                        rows.hint("rebalance", "dt").write.mode("overwrite")
                        .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
                        .partitionBy("dt").parquet(f"{self.path}/{name}")
                    )
            finally:
                remove_dir(spark, folder)
        spark.createDataFrame([(newest, dates)], "batch_id BIGINT, dates ARRAY<DATE>").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/applied/batch_id={newest}")
        return dates

    def partial(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(f"{PARTIALS[name]}, dt DATE").parquet(f"{self.path}/{name}")

    def table(self, spark: SparkSession, name: str, since: date | None = None, k: int = TOP_KEYWORDS_PER_DAY) -> DataFrame:
        """A gold table. With ``since``, only days from then on, and only their partials are read."""
        source = {"articles_per_day": "per_day", "articles_per_source": "per_day", "articles_per_theme": "per_theme",
                  "articles_per_country": "per_country", "top_keywords": "keywords", "articles": "articles"}[name]
        rows = self.partial(spark, source)
        if since is not None:
            day = F.to_date("published_at") if name == "articles" else F.col("day")
            rows = rows.where((F.col("dt") >= since - timedelta(days=1)) & (day >= since))
        total = F.sum("n_articles").alias("n_articles")
        if name == "articles_per_day":
            return rows.groupBy("day", "source").agg(total)
        if name == "articles_per_source":
            return rows.groupBy("source").agg(total, F.max("last_seen_at").alias("last_seen_at"))
        if name in ("articles_per_theme", "articles_per_country"):
            return rows.groupBy(name.removeprefix("articles_per_"), "day").agg(total)
        if name == "articles":
            return first_per_key(rows.drop("dt"), ["id"], [F.col("_listing")]).drop("_listing")
        counts = rows.groupBy("keyword", "day").agg(F.sum("n_occurrences").alias("n_occurrences"))
        ranking = Window.partitionBy("day").orderBy(F.desc("n_occurrences"), "keyword")
        return counts.withColumn("_rank", F.row_number().over(ranking)).where(F.col("_rank") <= k).drop("_rank")
