"""Quality gates, their summaries, and key assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.fixed_values import CORRUPT_JSON, GATES, MIN_CONTENT_CHARS
from pressflow.functions.dates import iso_timestamp
from pressflow.functions.text import ustrip


def _failures(min_content_chars: int) -> dict[str, Column]:
    """When an event fails each gate, in the order of the gates, which is the contract."""
    published = F.col("date_publication")
    title = F.coalesce(ustrip(F.col("titre_article")), F.lit(""))
    content = F.coalesce(ustrip(F.col("contenu")), F.lit(""))
    return {
        "missing_title": title == "",
        "missing_date": F.coalesce(published, F.lit("")) == "",
        "invalid_date": iso_timestamp(published).isNull(),
        "content_too_short": F.length(content) < min_content_chars,
    }


def dq_reason(min_content_chars: int = MIN_CONTENT_CHARS) -> Column:
    """First gate an event fails, null when it passes all."""
    reason = F
    for gate, fails in _failures(min_content_chars).items():
        reason = reason.when(fails, gate)
    return reason


def tag_quality(events: DataFrame, min_content_chars: int = MIN_CONTENT_CHARS) -> DataFrame:
    """Add ``dq_reason`` (O20-O23). A body that is not a JSON object is tagged as corrupt,
    except the literal ``null``, which counts as an empty event."""
    reason = dq_reason(min_content_chars)
    if "_corrupt" in events.columns:
        corrupt = F.col("_corrupt").isNotNull() & (F.trim("value") != "null")
        reason = F.when(corrupt, CORRUPT_JSON).otherwise(reason)
    return events.withColumn("dq_reason", reason)


def passed(tagged: DataFrame, min_content_chars: int | None = None) -> DataFrame:
    """Events that go on to silver.

    With the limit they were tagged with, the gates are applied one by one. They are then
    filters on single columns, which the optimizer can move below a join that makes the events,
    so that a text only read by a gate is not shuffled.
    """
    if min_content_chars is None or "_corrupt" in tagged.columns:
        return tagged.where(F.col("dq_reason").isNull())
    for fails in _failures(min_content_chars).values():
        tagged = tagged.where(~fails)
    return tagged.withColumn("dq_reason", F.lit(None).cast("string"))


def rejected(tagged: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """Events kept aside with their reason and the time of the check."""
    when = F.current_timestamp() if checked_at is None else checked_at
    return tagged.where(F.col("dq_reason").isNotNull()).withColumn("dq_checked_at", when)


def quality_summary(tagged: DataFrame) -> DataFrame:
    """Events per outcome, ``ok`` or the reject reason."""
    return (
        tagged.groupBy(F.coalesce("dq_reason", F.lit("ok")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def quality_results(tagged: DataFrame, run_at: Column) -> DataFrame:
    """One row per gate (O29): how many events reached it and how many failed it.

    One pass over the events ends in a single row of counters, which is then unfolded.
    """
    counts = tagged.agg(
        F.count_if(F.coalesce("dq_reason", F.lit("")) != CORRUPT_JSON).alias("n_total"),
        *[F.count_if(F.col("dq_reason") == gate).alias(gate) for gate, _ in GATES],
    )
    rows, reached = [], F.col("n_total")
    for gate, dimension in GATES:
        failed = F.col(gate)
        rows.append(F.struct(
            run_at.alias("run_at"),
            F.lit(gate).alias("check_name"),
            F.lit(dimension).alias("dimension"),
            (failed == 0).alias("passed"),
            F.to_json(F.struct(reached.alias("n_checked"), failed.alias("n_failed"))).alias("details"),
        ))
        reached = reached - failed
    return counts.select(F.inline(F.array(*rows)))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur twice or hold a null (O63); empty for a sound table."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | any_null)


def assert_keys(df: DataFrame, keys: list[str], table: str) -> None:
    """Raise when a table breaks its primary key."""
    if not key_violations(df, keys).isEmpty():
        raise ValueError(f"{table}: primary key {keys} is violated")
