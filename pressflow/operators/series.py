"""Queries over metric samples: latest totals and counter rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Length of the time slices in which samples of one series are ordered.
SLICE = "1 hour"


def select_series(
    metrics: DataFrame, name: str, labels: dict[str, str] | None = None,
    matches: dict[str, str] | None = None,
) -> DataFrame:
    """Samples of one metric, by label value or by a pattern that must match the whole value."""
    chosen = metrics.where(F.col("name") == name)
    for label, value in (labels or {}).items():
        chosen = chosen.where(F.try_element_at("labels", F.lit(label)) == value)
    for label, pattern in (matches or {}).items():
        chosen = chosen.where(F.try_element_at("labels", F.lit(label)).rlike(f"^(?:{pattern})$"))
    # a map cannot be a grouping key, its sorted entries can
    return chosen.withColumn("series", F.array_sort(F.map_entries("labels")))


def _label(label: str):
    return F.try_element_at(F.map_from_entries("series"), F.lit(label))


def latest_samples(samples: DataFrame) -> DataFrame:
    """The newest value of each series; one row per series and task is shuffled."""
    return samples.groupBy("series").agg(F.max_by("value", "ts").alias("value"))


def gauge_total(samples: DataFrame) -> DataFrame:
    """Sum over series of the newest value."""
    return latest_samples(samples).agg(F.sum("value").alias("value"))


def gauge_by_label(samples: DataFrame, label: str, scale: float = 1.0) -> DataFrame:
    """Newest values summed per label value and scaled."""
    return (
        latest_samples(samples).groupBy(_label(label).alias(label))
        .agg((F.sum("value") / F.lit(scale)).alias("value"))
    )


def increases(samples: DataFrame, slice_: str = SLICE) -> DataFrame:
    """Growth of a counter since the sample before; after a reset the whole value counts.

    Samples are ordered within (series, slice), never within a whole series, so a series that
    holds most samples is still spread by time. The first sample of a slice takes its
    predecessor from a small table with the last sample of each slice.
    """
    sliced = samples.withColumn("slice", F.window("ts", slice_)["start"])
    in_slice = Window.partitionBy("series", "slice").orderBy("ts")
    by_slice = Window.partitionBy("series").orderBy("slice")
    last = sliced.groupBy("series", "slice").agg(F.max_by("value", "ts").alias("last"))
    carried = last.select("series", "slice", F.lag("last").over(by_slice).alias("carried"))
    previous = F.coalesce(F.lag("value").over(in_slice), "carried")
    return (
        sliced.join(carried, ["series", "slice"])
        .withColumn("previous", previous)
        .where(F.col("previous").isNotNull())
        .withColumn("increase", F.when(F.col("value") < F.col("previous"), F.col("value"))
                    .otherwise(F.col("value") - F.col("previous")))
        .select("series", "ts", "increase")
    )


def counter_rate(
    samples: DataFrame, range_: str, step: str | None = None, by: str | None = None,
) -> DataFrame:
    """Growth per second over windows, summed over series or per label value.

    ``ts`` is the window's end. Windows follow each other unless ``step`` makes them overlap.
    """
    window = F.window("ts", range_, step) if step else F.window("ts", range_)
    keys = [window.alias("window")] + ([_label(by).alias(by)] if by else [])
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    summed = increases(samples).groupBy(*keys).agg(F.sum("increase").alias("increase"))
    return summed.select(
        F.col("window.end").alias("ts"), *([by] if by else []),
        (F.col("increase") / seconds).alias("rate"))
