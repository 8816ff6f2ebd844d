"""Event stream to bronze, rejects and silver.

One streaming query. Each micro-batch is decoded, tagged and written to the three layers with
the same operators the batch jobs use. Nothing here keeps state; the checkpoint holds the
offsets, and a replayed micro-batch overwrites its own folders, so results are exactly once. A
micro-batch counts once its record is written, in all layers or in none.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressflow.fixed_values import CORRUPT_JSON, GATES, MIN_CONTENT_CHARS
from pressflow.operators.language import LanguageModel
from pressflow.operators.latest import latest_version
from pressflow.operators.quality import passed, rejected, tag_quality
from pressflow.operators.silver import to_silver, with_partitions
from pressflow.schemas import BRONZE, RAW_COLUMNS, REJECTS
from pressflow.session import working_dir
from pressflow.sinks.commits import begin, commit, quality_history
from pressflow.sinks.lake import compact, gathered, write_batch
from pressflow.sources.events import decode_events
from pressflow.sources.tables import read_layer, scan_silver

SOURCE_FOLDERS = ["source_key", "dt"]
REJECT_FOLDERS = ["dq_reason", "dt"]
REASONS = [CORRUPT_JSON, *(gate for gate, _ in GATES)]
DELIVERY = ["ingest_ts", "src_offset"]
# What bronze is made of: the other columns are read from the body.
DELIVERED = ["value", *DELIVERY, *SOURCE_FOLDERS]
# Micro-batches whose counts are kept apart.
COUNTED_BATCHES = 1000

# One trigger that takes all there is and stops; restarting continues where it ended.
DRAIN = {"availableNow": True}


def tagged_events(events: DataFrame, min_content_chars: int = MIN_CONTENT_CHARS) -> DataFrame:
    """Events as landed: the body verbatim, its fields, its folders and its reject reason."""
    return tag_quality(with_partitions(decode_events(events)), min_content_chars)


def bronze_rows(tagged: DataFrame) -> DataFrame:
    return tagged.select("value", *RAW_COLUMNS, "_corrupt", *DELIVERY, *SOURCE_FOLDERS)


def reject_rows(tagged: DataFrame) -> DataFrame:
    return rejected(tagged).select(
        *RAW_COLUMNS, "value", *DELIVERY, "dq_checked_at", *REJECT_FOLDERS)


def silver_rows(tagged: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    return to_silver(passed(tagged), model).select(
        *RAW_COLUMNS, "language", "word_count", "char_count", "silver_processed_at",
        *DELIVERY, *SOURCE_FOLDERS)


def without_redeliveries(events: DataFrame, within: str = "1 hour") -> DataFrame:
    """Drop exact copies of an event that follow it within a bound (O27, streaming).

    The state holds a digest per event for that long. Later copies and corrected events pass;
    the last-write view settles those.
    """
    return (
        events.withColumn("_digest", F.sha1("value")).withWatermark("ingest_ts", within)
        .dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")
    )


@dataclass
class Ingest:
    """The ingest job: where it writes and how it reads an event."""

    root: str
    model: LanguageModel | None = None
    min_content_chars: int = MIN_CONTENT_CHARS
    # outcome counts of the last micro-batches this process has written, and of all
    counts: dict[int, dict[str, int]] = field(default_factory=dict)
    totals: Counter[str] = field(default_factory=Counter)

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Write one micro-batch: three layers, and last the record that makes it count in each of
        them. It is kept while its outputs are written; a lost part is read from the source again.

        Bodies are shuffled once, into the folders of bronze and silver, and kept as they came; each
        layer reads its fields from them. Rejects are dealt out again, by their own folders."""
        seen, spark = Observation(), batch.sparkSession
        begin(spark, self.root, batch_id)
        tagged = tagged_events(batch, self.min_content_chars).select(*DELIVERED, "dq_reason")
        placed = gathered(tagged, SOURCE_FOLDERS).persist()
        try:
            counted = placed.observe(
                seen,
                F.count_if(F.col("dq_reason").isNull()).alias("ok"),
                *[F.count_if(F.col("dq_reason") == reason).alias(reason) for reason in REASONS],
            )
            write_batch(
                bronze_rows(decode_events(counted)), self.layer("bronze"), SOURCE_FOLDERS, batch_id, True)
            kept_aside = gathered(rejected(placed).drop("dq_checked_at"), REJECT_FOLDERS)
            write_batch(
                reject_rows(decode_events(kept_aside)), self.layer("rejects"), REJECT_FOLDERS, batch_id, True)
            write_batch(
                silver_rows(decode_events(passed(placed)), self.model), self.layer("silver"),
                SOURCE_FOLDERS, batch_id, True)
            outcomes = seen.get
            commit(spark, self.root, batch_id, outcomes)
            counts = {"ok": outcomes["ok"], "rejected": sum(outcomes[reason] for reason in REASONS)}
            self.counts[batch_id] = counts
            self.totals.update(counts)
            self.counts.pop(batch_id - COUNTED_BATCHES, None)
        finally:
            placed.unpersist()

    def start(self, events: DataFrame, trigger: dict) -> StreamingQuery:
        return (
            events.writeStream.queryName("ingest").foreachBatch(self.write)
            .option("checkpointLocation", self.layer("checkpoint"))
            .trigger(**trigger).start()
        )

    def run_continuously(self, events: DataFrame, interval: str = "1 minute") -> StreamingQuery:
        """Keep ingesting."""
        return self.start(events, {"processingTime": interval})

    def drain(self, events: DataFrame) -> dict[str, int]:
        """Ingest what is waiting, then stop (O83). A second call with nothing new writes
        nothing. Returns the outcome counts of this call."""
        before = self.totals.copy()
        self.start(events, DRAIN).awaitTermination()
        return {name: self.totals[name] - before[name] for name in ("ok", "rejected")}

    def bronze(self, spark: SparkSession, *columns: str | Column) -> DataFrame:
        """The last delivery of every event (O27), or the given columns of it."""
        return latest_version(read_layer(spark, self.layer("bronze"), BRONZE), *columns)

    def compact_bronze(self, spark: SparkSession, up_to: int) -> None:
        """Merge the batches of bronze up to ``up_to``; only bodies are shuffled."""
        compact(spark, self.layer("bronze"), BRONZE, SOURCE_FOLDERS, up_to, DELIVERED, decode_events)

    def rejects(self, spark: SparkSession) -> DataFrame:
        """Every reject; nothing is replaced."""
        return read_layer(spark, self.layer("rejects"), REJECTS)

    def quality_history(self, spark: SparkSession) -> DataFrame:
        """The quality results of every micro-batch."""
        return quality_history(spark, self.root)

    def silver(self, spark: SparkSession) -> DataFrame:
        """The last passing delivery of every event (O27). Keys are ranked now, and no text is shuffled."""
        return scan_silver(spark, self.layer("silver"), lists=working_dir(spark, "silver"))
