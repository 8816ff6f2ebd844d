"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; all can be set on a session that is already running.
SESSION_SETTINGS = {
    # gold days and partition dates are UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesces small shuffles, splits skewed joins and skewed writes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the same for rows that are kept while several tables are written from them
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # texts vary from bytes to megabytes, so bound Arrow batches by size, not only by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pressflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="pressflow-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def working_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, below the shared ``spark.checkpoint.dir``.

    Executors on every machine must see it, so a temporary folder is used only when the
    setting is missing on a local-mode session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pressflow-")
    return f"{root.rstrip('/')}/pressflow/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def list_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a path pattern."""
    files, folder = _folder(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(folder) or []]


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def publish_dir(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder that is written whole to where a stream looks for it, with its files dated now;
    if there is none, an empty one appears."""
    files, folder = _folder(spark, path)
    _, there = _folder(spark, target)
    if not files.exists(folder):
        files.mkdirs(there)
        return
    now = int(time.time() * 1000)
    for status in files.listStatus(folder):
        files.setTimes(status.getPath(), now, -1)
    files.mkdirs(there.getParent())
    if not files.rename(folder, there):
        raise RuntimeError(f"{path} could not be moved to {target}")


def file_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number of files, bytes and last change of a table, which differ once it is written again."""
    files, folder = _folder(spark, path)
    size = files.getContentSummary(folder)
    return size.getFileCount(), size.getLength(), files.getFileStatus(folder).getModificationTime()
