"""Scans of the lake layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.operators.latest import latest_stored_version, latest_version
from pressflow.schemas import SILVER, SILVER_JSON
from pressflow.sinks.commits import layer_batches


def scan_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table with a known schema; a missing path is an empty table.

    Other errors, such as files that cannot be read, are raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_layer(
    spark: SparkSession, path: str, schema: str, skip_unreadable: bool = False
) -> DataFrame:
    """All rows of a layer that is written in batches, without those of batches that do not count,
    see ``sinks.commits``. ``skip_unreadable`` leaves damaged files out, with a warning in the
    executor log, instead of failing."""
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", "true")
    rows, hidden = reader.parquet(path), list(layer_batches(spark, path)[1])
    if hidden:  # few: what a stopped attempt or merge has left
        rows = rows.where(~F.col("batch_id").isin(hidden))
    return rows.drop("batch_id")


def scan_silver(
    spark: SparkSession, path: str, skip_unreadable: bool = False, lists: str | None = None
) -> DataFrame:
    """The current silver articles (O03): all files below ``path``, last write per key.

    Filters on ``source_key`` and ``dt`` skip whole folders. Where whole articles are read, a folder
    for ``lists`` spares their shuffle, see ``latest_stored_version``.
    """
    rows = read_layer(spark, path, SILVER, skip_unreadable)
    return latest_version(rows) if lists is None else latest_stored_version(rows, lists)


def _json_objects(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(f"{SILVER_JSON}, _corrupt STRING")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        .option("columnNameOfCorruptRecord", "_corrupt").json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
        .where(~F.contains(F.col("_file"), F.lit("_rejected")))
    )


def silver_json_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What ``scan_silver_json`` leaves out because it does not parse: ``file``, ``id`` if that can
    be read, and ``value``."""
    return _json_objects(spark, path).where(F.col("_corrupt").isNotNull()).select(
        F.col("_file").alias("file"), "id", F.col("_corrupt").alias("value"))


def scan_silver_json(spark: SparkSession, path: str) -> DataFrame:
    """Silver kept as JSON, one object per article or per line, below folders for source and
    date (O03).

    Anything under a rejects folder is left out, and so are objects that do not parse, which are
    ``silver_json_rejects``. Folder names give ``source_key`` and ``dt``; ``source`` stays the name
    inside the object.
    """
    file = F.col("_file")
    return (
        _json_objects(spark, path).where(F.col("_corrupt").isNull()).drop("_corrupt")
        .withColumns({
            "source_key": F.regexp_extract(file, "/source(?:_key)?=([^/]*)/", 1),
            "dt": F.regexp_extract(file, "/dt=([^/]*)/", 1).try_cast("date"),
        })
        .drop("_file")
    )
