"""Helpers the operators share: tables, intermediate results and columns that never clash."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.session import configure, remove_dir, working_dir

#: Java pattern of what separates words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Removes a job's shuffle files once it has ended, instead of when the driver collects garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again, which cuts its lineage.
    ``tidy`` removes the shuffle files of the job that wrote it."""
    spark = df.sparkSession
    path = working_dir(spark, name)
    before = spark.conf.get(_TIDY, "false")
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a ``stored`` table that nothing reads any more."""
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    for folder in folders:
        remove_dir(df.sparkSession, folder)


def text_of(column: str | Column) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast an object of this package; the result gives it to a task.

    It travels with its code, as functions do, and is unpacked once in each Python worker, so what
    it caches there serves the worker's later tasks too.
    """
    holder = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)})

    def get() -> Any:
        held = holder.value
        if "packed" in held:
            held["value"] = cloudpickle.loads(held.pop("packed"))
        return held["value"]

    return get
