"""Keyed merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], load_ts: Column | None = None
) -> DataFrame:
    """``target`` after the merge: rows with a key among the updates are replaced as a whole,
    new keys are added, others stay. ``updates`` must be unique on ``keys``; merged rows get
    the load time as ``ingested_at``."""
    ingested_at = F.current_timestamp() if load_ts is None else load_ts
    merged = updates.withColumn("ingested_at", ingested_at)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(merged.select(*target.columns))
