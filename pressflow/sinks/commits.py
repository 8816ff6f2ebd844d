"""Commit records of a lake: which batches of its layers count.

A micro-batch writes three layers, one after the other. Its record is written last, below
``commits/batch_id=<n>``, and is what makes the batch count: micro-batches come in order, so batches
after the newest record are those of an attempt that did not end, and readers of every layer leave
them out. A merge of a layer's batches leaves a record too, below ``commits/<layer>``, which puts
the merged batch in the place of those it holds.

Records also hold the batch's quality results, so each batch is in the history once (O29).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.fixed_values import CORRUPT_JSON, GATES
from pressflow.schemas import DQ_RESULTS
from pressflow.session import list_dirs

_MERGE = "batch_id BIGINT, up_to BIGINT"


def _ids(paths: list[str]) -> list[int]:
    return [int(path.rsplit("batch_id=", 1)[1].split("/")[0]) for path in paths]


def newest_commit(spark: SparkSession, root: str) -> int | None:
    """The newest batch with a whole record; None where no records are kept."""
    for batch_id in sorted(_ids(list_dirs(spark, f"{root}/commits/batch_id=*")), reverse=True):
        if list_dirs(spark, f"{root}/commits/batch_id={batch_id}/_SUCCESS"):
            return batch_id
    return None


def begin(spark: SparkSession, root: str, batch_id: int) -> None:
    """Keep records from this batch on: batches before it, if there are any, count as they are."""
    if newest_commit(spark, root) is None:
        _record(spark, [], root, batch_id - 1)


def commit(spark: SparkSession, root: str, batch_id: int, counts: dict[str, int]) -> None:
    """Make a batch count. ``counts`` has its events by outcome, see ``quality.quality_summary``."""
    run_at, rows = datetime.now(timezone.utc).replace(tzinfo=None), []
    reached = sum(n for outcome, n in counts.items() if outcome != CORRUPT_JSON)
    for gate, dimension in GATES:
        failed = counts.get(gate, 0)
        rows.append((run_at, gate, dimension, failed == 0, f'{{"n_checked":{reached},"n_failed":{failed}}}'))
        reached -= failed
    _record(spark, rows, root, batch_id)


def _record(spark: SparkSession, rows: list[tuple], root: str, batch_id: int) -> None:
    schema = DQ_RESULTS.replace("run_at TIMESTAMP,", "run_at TIMESTAMP_NTZ,")
    results = spark.createDataFrame(rows, schema).withColumn("run_at", F.col("run_at").cast("timestamp"))
    results.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/batch_id={batch_id}")


def quality_history(spark: SparkSession, root: str) -> DataFrame:
    """``batch_id`` and the quality results of every batch that counts."""
    schema = f"{DQ_RESULTS}, batch_id BIGINT"
    if newest_commit(spark, root) is None:
        return spark.createDataFrame([], schema).select("batch_id", "*")
    return spark.read.schema(schema).option("basePath", f"{root}/commits").parquet(
        f"{root}/commits/batch_id=*").select("batch_id", *[part.split()[0] for part in DQ_RESULTS.split(",")])


def _newest_merge(spark: SparkSession, root: str, layer: str) -> tuple[int, int] | None:
    """The batch that holds a layer's merged rows, and the newest batch in it."""
    if not list_dirs(spark, f"{root}/commits/{layer}/*/_SUCCESS"):
        return None
    return spark.read.schema(_MERGE).parquet(f"{root}/commits/{layer}/*").agg(F.min("batch_id"), F.max("up_to")).first()


def begin_merge(spark: SparkSession, layer_path: str) -> None:
    """From here on a layer's merged batch counts by its record; one that is there already does."""
    root, layer = layer_path.rstrip("/").rsplit("/", 1)
    if _newest_merge(spark, root, layer) is None:
        commit_merge(spark, layer_path, min(0, *layer_batches(spark, layer_path)[0]), up_to=-1)


def commit_merge(spark: SparkSession, layer_path: str, batch_id: int, up_to: int) -> None:
    """Let a merged batch stand for all others up to ``up_to``."""
    root, layer = layer_path.rstrip("/").rsplit("/", 1)
    spark.createDataFrame([(batch_id, up_to)], _MERGE).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/commits/{layer}/{batch_id}")


def ended(spark: SparkSession, layer_path: str, batch_id: int) -> bool:
    """Whether a batch is not one that is still being written by a stream."""
    newest = newest_commit(spark, layer_path.rstrip("/").rsplit("/", 1)[0])
    return newest is None or batch_id <= newest


def layer_batches(spark: SparkSession, layer_path: str) -> tuple[dict[int, str], dict[int, str]]:
    """A layer's batch folders: those that count, and those that do not.

    Where no records are kept, all count.
    """
    root, layer = layer_path.rstrip("/").rsplit("/", 1)
    folders = list_dirs(spark, f"{layer_path}/batch_id=*")
    found = dict(zip(_ids(folders), folders, strict=True))
    newest, merge = newest_commit(spark, root), _newest_merge(spark, root, layer)

    def counts(batch_id: int) -> bool:
        if batch_id < 0:
            return merge is None or batch_id == merge[0]
        return (newest is None or batch_id <= newest) and (merge is None or batch_id > merge[1])

    counted = {b: path for b, path in found.items() if counts(b)}
    return counted, {b: path for b, path in found.items() if b not in counted}
