"""Counter rates kept up to date by a stream.

The state is the samples of one series within one time slice, so a series with most samples is
spread over its slices and a slice's state is bounded by its length. Late samples take their place
among those of their slice. What grows from one slice to the next is added when the rates are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pressflow.streaming.daily import latest_updates

_KEYS = "series STRING, label STRING, slice TIMESTAMP"
_SLICE = f"{_KEYS}, first_us BIGINT, first DOUBLE, last DOUBLE, ends ARRAY<BIGINT>, grown ARRAY<DOUBLE>"
_SAMPLES = "us ARRAY<BIGINT>, value ARRAY<DOUBLE>"


def _increase(value: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Growth of a counter; after a reset the whole value counts."""
    return np.where(value < before, value, value - before)


def slice_updates(
    samples: DataFrame, by: str | None = None, seconds: int = 60, lateness: str = "1 hour",
    slice_seconds: int = 3600,
) -> DataFrame:
    """What each (series, slice) comes to whenever samples of it arrive: its first and last value and
    its growth in each window of ``seconds``, by the window's end.

    ``samples`` has ``ts``, ``labels`` and ``value``; rows without a time or value are left out. A
    sample that is delivered again counts once; of two values at one time the larger comes last. A
    slice is forgotten once the watermark has passed its end, and samples behind the watermark are
    left to the batch query. ``slice_seconds`` must be a multiple of ``seconds``.
    """
    if slice_seconds % seconds:
        raise ValueError("a slice must hold whole windows")
    width, window = slice_seconds * 1_000_000, seconds * 1_000_000
    label = F.try_element_at("labels", F.lit(by)) if by else F.lit(None).cast("string")
    sliced = (
        samples.where("ts IS NOT NULL AND value IS NOT NULL").withWatermark("ts", lateness)
        .select(F.to_json(F.array_sort(F.map_entries("labels"))).alias("series"), label.alias("label"),
                F.window("ts", f"{slice_seconds} seconds")["start"].alias("slice"),
                "ts", F.unix_micros("ts").alias("us"), F.col("value").cast("double").alias("value"))
    )

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else ([], [])
        pairs = set(zip(held[0], held[1], strict=True))
        for frame in frames:
            pairs.update(zip(frame["us"].tolist(), frame["value"].tolist(), strict=True))
        ordered = sorted(pairs)
        state.update(([us for us, _ in ordered], [value for _, value in ordered]))
        us, value = (np.array(part) for part in zip(*ordered, strict=True))
        state.setTimeoutTimestamp(int(us[0] - us[0] % width + width) // 1000)
        ends, place = np.unique(us[1:] - us[1:] % window + window, return_inverse=True)
        grown = np.bincount(place, _increase(value[1:], value[:-1]), minlength=len(ends))
        yield pd.DataFrame({
            "series": [key[0]], "label": [key[1]], "slice": [key[2]], "first_us": [us[0]],
            "first": [value[0]], "last": [value[-1]], "ends": [ends.tolist()], "grown": [grown.tolist()]})

    return sliced.groupBy("series", "label", "slice").applyInPandasWithState(
        update, _SLICE, _SAMPLES, "update", GroupStateTimeout.EventTimeTimeout)


def counter_rates(spark: SparkSession, path: str, seconds: int = 60) -> DataFrame:
    """Growth per second in each window (``ts`` is its end) and label, from the stored updates.

    The newest update of each slice counts. A slice's first sample follows the last one of the slice
    before, of which a table with one row for each slice is ordered by series.
    """
    slices = latest_updates(spark, path, _SLICE, ["series", "slice"])
    before = F.lag("last").over(Window.partitionBy("series").orderBy("slice"))
    inside = slices.select("label", F.explode(F.arrays_zip("ends", "grown")).alias("w")) \
        .select("label", F.col("w.ends").alias("us"), F.col("w.grown").alias("grown"))
    window = F.lit(seconds * 1_000_000)
    between = (
        slices.select("series", "label", "slice", "first_us", "first", "last").withColumn("before", before)
        .where("before IS NOT NULL")
        .select("label", (F.col("first_us") - F.pmod("first_us", window) + window).alias("us"),
                F.when(F.col("first") < F.col("before"), F.col("first"))
                .otherwise(F.col("first") - F.col("before")).alias("grown"))
    )
    return (
        inside.unionByName(between).groupBy("us", "label").agg(F.sum("grown").alias("grown"))
        .select(F.timestamp_micros("us").alias("ts"), "label", (F.col("grown") / seconds).alias("rate"))
    )
