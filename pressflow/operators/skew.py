"""Joins that survive a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 100_000


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: list[str],
    spread_by: list[str], hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join in which a key with many left rows is spread over several tasks.

    ``right`` must be unique on ``keys``. Left rows are counted per key, summed inside each task
    first. A key with more than ``hot_rows`` is given a salt for each ``hot_rows`` rows: its left
    rows get one by ``spread_by`` and its single right row is repeated once per salt. Salting
    never changes the result.
    """
    hot = (
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts"))
    )
    any_salt = F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")
    salted = (
        left.join(hot, keys, "left")
        .withColumn("_salt", F.coalesce(any_salt, F.lit(0))).drop("_salts")
    )
    all_salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = right.join(hot, keys, "left").withColumn("_salt", F.explode(all_salts)).drop("_salts")
    return salted.join(repeated, [*keys, "_salt"], "left").drop("_salt")
