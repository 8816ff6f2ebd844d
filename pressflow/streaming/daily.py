"""Windowed counts over streams (O86, O89), and counts that follow corrections."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pressflow.fixed_values import UNKNOWN_SOURCE
from pressflow.functions.dates import iso_timestamp
from pressflow.operators.latest import first_per_key, with_event_key
from pressflow.schemas import SILVER


def silver_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream the silver layer, batch after batch; merged batches repeat rows already seen."""
    silver = spark.readStream.schema(f"{SILVER}, batch_id BIGINT").parquet(path)
    return silver.where("batch_id >= 0")


def daily_counts(silver_stream: DataFrame, lateness: str | None = None) -> DataFrame:
    """Articles per day and source while they arrive.

    The state is one number per day and source, so by default all days are kept and no row
    comes too late. With a lateness bound, days beyond it expire and their late rows are left
    to the batch rebuild of gold, as is the correction of redelivered events, which count again.
    """
    dated = silver_stream.withColumn(
        "published_at", iso_timestamp(F.col("date_publication"))
    ).where(F.col("published_at").isNotNull())
    if lateness:
        dated = dated.withWatermark("published_at", lateness)
    return (
        dated
        .groupBy(F.window("published_at", "1 day"),
                 F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"))
        .agg(F.count(F.lit(1)).alias("n_articles"))
        .select(F.to_date("window.start").alias("day"), "source", "n_articles")
    )


_VERSION = "ingest_ts TIMESTAMP, src_offset BIGINT, day DATE, source STRING"
_CHANGE = "day DATE, source STRING, change INT"


def daily_changes(silver_stream: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """What each event changes in the counts per day and source while it arrives and is corrected
    (O27, O89): ``day``, ``source`` and ``change``, 1 or -1.

    The state holds the last version of each event: its order, day and source, no text. A newer
    delivery under another day or source takes the old count back, one that is not newer changes
    nothing, and so do replays. Changes add up to the counts over each event's last version.

    With ``forget_after_ms`` an event that was silent for so long is forgotten; a later correction
    of it then counts again. The RocksDB state store suits many events.
    """
    dated = with_event_key(silver_stream).select(
        "_event", "ingest_ts", "src_offset",
        F.to_date(iso_timestamp(F.col("date_publication"))).alias("day"),
        F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"))

    def change(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = state.get if state.exists else None
        newest = old
        for frame in frames:
            order = list(zip(frame["ingest_ts"], frame["src_offset"], strict=True))
            last = max(range(len(order)), key=order.__getitem__)
            if newest is None or order[last] > tuple(newest[:2]):
                row = frame.iloc[last]
                newest = (*order[last], None if pd.isna(row["day"]) else row["day"], row["source"])
        if newest is not old:
            state.update((newest[0].to_pydatetime(), int(newest[1]), newest[2], newest[3]))
        if forget_after_ms is not None:
            state.setTimeoutDuration(forget_after_ms)
        before, after = (None if v is None or v[2] is None else (v[2], v[3]) for v in (old, newest))
        if before != after:
            rows = [(*before, -1)] if before else []
            rows += [(*after, 1)] if after else []
            yield pd.DataFrame(rows, columns=["day", "source", "change"])

    timeout = GroupStateTimeout.NoTimeout if forget_after_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return dated.groupBy("_event").applyInPandasWithState(change, _CHANGE, _VERSION, "update", timeout)


def write_changes(changes: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Keep the changes of every micro-batch, summed; see ``write_updates``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("day", "source").agg(F.sum("change").alias("change")).where("change <> 0").write.mode(
            "overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        changes.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def net_counts(spark: SparkSession, path: str) -> DataFrame:
    """Articles per day and source after all changes; days that lost all theirs are left out."""
    changes = spark.read.schema("day DATE, source STRING, change BIGINT, batch_id BIGINT").parquet(path)
    return changes.groupBy("day", "source").agg(F.sum("change").alias("n_articles")).where("n_articles > 0")


def message_rate(
    stream: DataFrame, ts: str = "ingest_ts", range_: str = "5 minutes", step: str = "1 minute",
    lateness: str | None = None,
) -> DataFrame:
    """Messages per second over a sliding window of a stream.

    The state is one number per window; a lateness bound lets old windows expire.
    """
    if lateness:
        stream = stream.withWatermark(ts, lateness)
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    return (
        stream.groupBy(F.window(ts, range_, step)).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.end").alias("ts"), (F.col("n") / seconds).alias("rate"))
    )


def write_updates(updates: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Keep every update of an aggregate. A micro-batch owns one folder, which a replay after
    a failure overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        updates.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def latest_updates(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """The newest update of each key."""
    updates = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)
    return first_per_key(updates, keys, [F.desc("batch_id")]).drop("batch_id")
