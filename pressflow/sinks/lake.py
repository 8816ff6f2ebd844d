"""Writers of the lake layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressflow.functions.text import packed, unpacked
from pressflow.operators.latest import latest_stored_version
from pressflow.session import remove_dir, working_dir
from pressflow.sinks.commits import begin_merge, commit_merge, ended, layer_batches


# Copies of one text compress to almost nothing, so a bound on bytes does not bound the work in
# a file; this does. Ordinary articles fill it to a usual file size.
MAX_ROWS_PER_FILE = 20_000
# Texts take a third less room than by Spark's default.
STORED_AS = "zstd"


def gathered(df: DataFrame, folders: list[str]) -> DataFrame:
    """Rows dealt out by the folder they go to. The rebalance hint gathers each folder's rows into
    few tasks and lets Spark cut a folder that holds most of the rows into several. Bodies, if there
    are any, travel compressed."""
    if "value" not in df.columns:
        return df.hint("rebalance", *folders)
    dealt = df.withColumn("value", packed(F.col("value"))).hint("rebalance", *folders)
    return dealt.withColumn("value", unpacked(F.col("value")))


def write_batch(df: DataFrame, layer: str, folders: list[str], batch_id: int, is_gathered: bool = False) -> None:
    """Add one batch to a partitioned layer, idempotently.

    A batch owns the folder ``batch_id=<n>``, so a replay after a failure replaces what the
    failed attempt left. Rows that are not ``gathered`` yet are. Files have a row limit, so that
    later scans can be cut too.
    """
    (
        (df if is_gathered else gathered(df, folders))
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE).option("compression", STORED_AS)
        .partitionBy(*folders).parquet(f"{layer}/batch_id={batch_id}")
    )


def write_observed(df: DataFrame, path: str, **counts: Column) -> dict[str, int]:
    """Replace a table and count its rows in the same pass.

    An empty table is written too, so no stale rows stay.
    """
    seen = Observation()
    columns = {"n_rows": F.count(F.lit(1)), **counts}
    observed = df.observe(seen, *[c.alias(name) for name, c in columns.items()])
    observed.write.mode("overwrite").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(path)
    return seen.get


def export_json(silver: DataFrame, path: str) -> None:
    """Silver as JSON lines in its folders, null fields included."""
    (
        silver.drop("ingest_ts", "src_offset")
        .hint("rebalance", "source_key", "dt")
        .write.mode("overwrite").option("ignoreNullFields", "false")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy("source_key", "dt").json(path)
    )


def compact(spark: SparkSession, layer: str, schema: str, folders: list[str], up_to: int,
            kept: list[str] | None = None, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge the batches up to ``up_to`` into one, keeping the last write per key.

    The merged rows go to a new folder with a negative batch id. Its record, written next, lets it
    stand for the old folders, which are removed last. So a run that stops in between changes
    nothing that readers see, and the next run merges what is left. Batches that have no record
    yet are not touched. Streams that read the layer must have passed ``up_to``.

    The rows are shuffled once, into their folders. Where columns follow from others, only those
    named by ``kept`` are shuffled, and ``derive`` makes the others anew of them.
    """
    counted, others = layer_batches(spark, layer)
    old = {batch_id: path for batch_id, path in counted.items() if batch_id <= up_to}
    left = [path for batch_id, path in others.items() if ended(spark, layer, batch_id)]
    if len(old) >= 2:
        batches = spark.read.schema(f"{schema}, batch_id BIGINT").option("basePath", layer).parquet(*old.values())
        batch_id, lists = min(0, *counted, *others) - 1, working_dir(spark, "merge")
        begin_merge(spark, layer)
        try:
            rows = latest_stored_version(batches, lists).drop("batch_id")
            merged = gathered(rows.select(*(kept or rows.columns)), folders)
            if derive is not None:
                merged = derive(merged).select(*rows.columns)
            write_batch(merged, layer, folders, batch_id, True)
        finally:
            remove_dir(spark, lists)
        commit_merge(spark, layer, batch_id, max(old))
        left += old.values()
    for path in left:
        remove_dir(spark, path)
