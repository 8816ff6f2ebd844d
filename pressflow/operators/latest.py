"""Keep one row per key."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressflow.schemas import RAW_COLUMNS

LAYER_KEYS = ["source_key", "dt", "_event"]
#: Keys of a list that is broadcast whatever Spark estimates; about 300 bytes each.
SHORT_LIST = 100_000


def last_write() -> list[Column]:
    """The order in which a layer's deliveries replace each other, newest first."""
    return [F.desc("ingest_ts"), F.desc("src_offset")]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark prunes to one row per key inside every input partition (WindowGroupLimit) before
    it shuffles, so a key that holds most rows sends one row per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def with_event_key(layer: DataFrame) -> DataFrame:
    """Add ``_event``, what a delivery is one of: the event's id, or a digest of what was
    delivered where that names no event (a body that does not parse, an event without id)."""
    body = F.col("value") if "value" in layer.columns else F.to_json(
        F.struct(*[c for c in RAW_COLUMNS if c in layer.columns]))
    return layer.withColumn("_event", F.when(F.col("id") != "", F.concat(F.lit("id:"), "id"))
                            .otherwise(F.concat(F.lit("body:"), F.sha1(body))))


def latest_version(layer: DataFrame, *columns: str | Column) -> DataFrame:
    """Last write wins per source, date and event (O27). Only the columns in use are shuffled.

    Deliveries without an id replace only equal ones, so none of them is lost. Of ``columns``, if
    any are given, the results are shuffled and not what they are made of.
    """
    keyed = with_event_key(layer)
    if not columns:
        return first_per_key(keyed, LAYER_KEYS, last_write()).drop("_event")
    row = F.struct(*columns).alias("_row")
    return first_per_key(
        keyed.select(row, *LAYER_KEYS, "ingest_ts", "src_offset"), LAYER_KEYS, last_write()).select("_row.*")


def latest_stored_version(layer: DataFrame, folder: str) -> DataFrame:
    """``latest_version`` of a wide layer that is read from files, which shuffles the columns of
    the key only.

    A first job writes the keys that were delivered several times, with the place of their last
    write, to ``folder``, which must live as long as the result. Of those keys only the row at that
    place stays. The list is broadcast while it is short.
    """
    spark, place = layer.sparkSession, ["_file", "_line"]
    keyed = with_event_key(layer.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line")))
    # the greatest is the newest, as in last_write: nulls come last there and are the least here
    newest = F.max(F.struct("ingest_ts", "src_offset", *place))
    several = (
        keyed.groupBy(*LAYER_KEYS).agg(F.count(F.lit(1)).alias("_rows"), newest.alias("_newest"))
        .where("_rows > 1").select(*[F.col(key).alias(f"_of_{key}") for key in LAYER_KEYS],
                                   *[F.col(f"_newest.{c}").alias(f"_last{c}") for c in place])
    )
    listed = f"{folder}/replaced-{uuid.uuid4().hex}"
    several.write.parquet(listed)
    replaced = spark.read.schema(several.schema).parquet(listed)
    if replaced.count() <= SHORT_LIST:
        replaced = F.broadcast(replaced)
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in LAYER_KEYS])
    last = reduce(Column.__and__, [F.col(c) == F.col(f"_last{c}") for c in place])
    return keyed.join(replaced, same, "left").where(F.col("_last_file").isNull() | last).select(*layer.columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row. Reads and shuffles the key columns only."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1").select(*keys)
    )


def first_per_stored_key(
    df: DataFrame, keys: list[str], order: list[Column], folder: str,
) -> DataFrame:
    """``first_per_key`` for a wide stored table: only rows of repeated keys are ranked.

    A first job over the key columns writes the list of repeated keys to ``folder``, which must
    live as long as the result. The rows are joined with it: Spark broadcasts a list that is
    small enough, and the wide rows of other keys are then not shuffled at all.
    """
    spark = df.sparkSession
    listed = f"{folder}/repeated-{uuid.uuid4().hex}"
    repeated_keys(df, keys).write.parquet(listed)
    repeated = spark.read.schema(df.select(*keys).schema).parquet(listed)
    same = reduce(Column.__and__, [df[key].eqNullSafe(repeated[key]) for key in keys])
    once = df.join(repeated, same, "left_anti")
    several = df.join(repeated, same, "left_semi")
    return once.unionByName(first_per_key(several, keys, order))
