"""A keyed table in bucket folders, whose merge rewrites the buckets it changes.

Rows lie in buckets by a digest of their key. A merge writes the buckets that hold a key of the
updates to a folder of its own, ``files/version=<n>/bucket=<b>``, and leaves all other folders as
they are. The manifest of a version, written last, names the version each bucket is read from, so
a merge shows in whole or not at all: what a failed one has left is in no manifest, and the next
one replaces it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.operators.latest import first_per_key
from pressflow.session import list_dirs, remove_dir

MANIFEST = "bucket INT, version INT, n_rows BIGINT, buckets INT"
#: Versions whose files stay for queries that still read them.
KEPT_VERSIONS = 2


def bucket_of(keys: list[str], buckets: Column | int) -> Column:
    """Bucket of a key: the first 32 bits of its MD5 as a number, modulo the number of buckets."""
    text = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), buckets).cast("int")


@dataclass(frozen=True)
class Merged:
    """What a merge did: its version, and the buckets it rewrote and left as they were."""

    version: int
    rewritten: list[int]
    kept: list[int]


@dataclass(frozen=True)
class BucketedTable:
    """A table below ``root`` with unique ``keys``. ``schema`` is the DDL of its columns."""

    root: str
    schema: str
    keys: list[str]

    def _committed(self, spark: SparkSession) -> list[int]:
        """Versions with a whole manifest, oldest first."""
        found = list_dirs(spark, f"{self.root}/manifest/version=*/_SUCCESS")
        return sorted(int(path.rsplit("version=", 1)[1].split("/")[0]) for path in found)

    def manifest(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """``bucket``, the ``version`` it is read from, its ``n_rows``, and the number of ``buckets``.

        A row for each bucket that has rows; null before the first merge.
        """
        versions = self._committed(spark)
        if not versions:
            return None
        chosen = versions[-1] if version is None else version
        return spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/version={chosen}")

    def _files(self, spark: SparkSession, rows: list) -> DataFrame:
        paths = [f"{self.root}/files/version={r['version']}/bucket={r['bucket']}" for r in rows]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of one that is kept; empty before the first merge."""
        manifest = self.manifest(spark, version)
        return self._files(spark, [] if manifest is None else manifest.collect())

    def select_statement(self, spark: SparkSession) -> str:
        """SQL that reads the newest version by its folders, as a view needs it."""
        of_version: dict[int, list[int]] = {}
        for r in self.manifest(spark).orderBy("version", "bucket").collect():
            of_version.setdefault(r["version"], []).append(r["bucket"])
        chosen = " OR ".join(
            f"(version = {v} AND bucket IN ({', '.join(map(str, b))}))" for v, b in of_version.items())
        columns = ", ".join(f"`{f.name}`" for f in spark.createDataFrame([], self.schema).schema)
        return f"SELECT {columns} FROM parquet.`{self.root}/files` WHERE {chosen or 'false'}"

    def merge(self, updates: DataFrame, buckets: int) -> Merged:
        """Replace rows whose key is among the updates and add new keys; see ``upsert``.

        ``updates`` has the table's columns and unique keys. ``buckets`` is the number of buckets of
        a new table, later ones keep theirs; a bucket should fit a task. Only touched buckets are
        read, and their rows go through one shuffle, which puts each bucket into one task. Keys are
        unique and spread by their digest, so buckets are alike in size. The driver holds one row
        for each bucket. Updates without rows make no version.
        """
        spark = updates.sparkSession
        versions = self._committed(spark)
        current = self.manifest(spark).collect() if versions else []
        buckets = current[0]["buckets"] if current else buckets
        columns = [f.name for f in spark.createDataFrame([], self.schema).schema]
        placed = updates.select(*columns, bucket_of(self.keys, buckets).alias("bucket"))
        touched = {r["bucket"] for r in placed.select("bucket").distinct().collect()}
        kept = [r for r in current if r["bucket"] not in touched]
        version = versions[-1] if versions else 0
        if touched:
            version += 1
            stored = self._files(spark, [r for r in current if r["bucket"] in touched])
            stored = stored.select("*", bucket_of(self.keys, buckets).alias("bucket"), F.lit(False).alias("_new"))
            both = placed.withColumn("_new", F.lit(True)).unionByName(stored)
            rows = first_per_key(both.repartition(min(buckets, len(touched)), "bucket"),
                                 ["bucket", *self.keys], [F.desc("_new")]).drop("_new")
            folder = f"{self.root}/files/version={version}"
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)
            self._commit(spark, version, folder, kept, buckets)
            self._forget(spark)
        return Merged(version, sorted(touched), sorted(r["bucket"] for r in kept))

    def _commit(self, spark: SparkSession, version: int, folder: str, kept: list, buckets: int) -> None:
        # row counts come from the footers of the files just written
        written = spark.read.schema(f"{self.schema}, bucket INT").parquet(folder).groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n_rows"))
        rows = written.select("bucket", F.lit(version).alias("version"), "n_rows").unionByName(
            spark.createDataFrame([(r["bucket"], r["version"], r["n_rows"]) for r in kept],
                                  "bucket INT, version INT, n_rows BIGINT"))
        rows.withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/manifest/version={version}")

    def _forget(self, spark: SparkSession) -> None:
        """Remove manifests and bucket folders that no kept version reads."""
        versions = self._committed(spark)
        kept = versions[-KEPT_VERSIONS:]
        read = {(r["version"], r["bucket"]) for v in kept for r in self.manifest(spark, v).collect()}
        for path in list_dirs(spark, f"{self.root}/files/version=*/bucket=*"):
            version, bucket = (int(part.split("=")[1]) for part in path.rsplit("/", 2)[1:])
            if (version, bucket) not in read:
                remove_dir(spark, path)
        for version in versions[:-KEPT_VERSIONS]:
            remove_dir(spark, f"{self.root}/manifest/version={version}")
