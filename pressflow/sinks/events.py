"""Publishing raw article events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressflow.fixed_values import RAW_TOPIC
from pressflow.schemas import RAW_COLUMNS
from pressflow.sinks.lake import MAX_ROWS_PER_FILE


def as_messages(articles: DataFrame) -> DataFrame:
    """Key and JSON body of each event; null fields are written out."""
    body = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    return articles.select(F.col("id").alias("key"), body.alias("value"))


def publish_kafka(articles: DataFrame, bootstrap_servers: str, topic: str = RAW_TOPIC) -> None:
    """Needs Spark's Kafka connector on the class path."""
    (
        as_messages(articles).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def land_text(articles: DataFrame, path: str) -> None:
    """One JSON event per line, for a file-based stream."""
    write_lines(as_messages(articles).select("value"), path)


def write_lines(bodies: DataFrame, path: str, *folders: str) -> None:
    """Add one ``value`` per line to a folder, in folders by the other columns. The files are
    compressed, and so read by one task each: the row limit bounds them."""
    (
        bodies.write.mode("append").partitionBy(*folders).option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).text(path)
    )
