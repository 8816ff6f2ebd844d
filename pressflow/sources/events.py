"""The raw event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.fixed_values import RAW_TOPIC
from pressflow.schemas import RAW


def kafka_events(
    spark: SparkSession, bootstrap_servers: str, topic: str = RAW_TOPIC,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream the topic from its beginning. Needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingest_ts"),
        F.col("offset").alias("src_offset"),
    )


def landed_events(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream a folder of text files, one JSON event per line.

    A file has no offsets; a hash of the body stands in, so that which of two deliveries in
    one file counts as the last does not depend on task order.
    """
    reader = spark.readStream.format("text").schema("value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
        F.xxhash64("value").alias("src_offset"),
    )


def decode_events(events: DataFrame) -> DataFrame:
    """Bodies to columns (O02), other columns kept. A body that is not a JSON object leaves
    null fields and sets ``_corrupt``; a missing body is an empty event."""
    decoded = F.from_json(
        "value", f"{RAW}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    return events.withColumn("_event", decoded).select(*events.columns, "_event.*")
