"""The warehouse: tables in the session catalog, or a database over JDBC."""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.operators.quality import assert_keys
from pressflow.schemas import DQ_RESULTS, GOLD, GOLD_KEYS
from pressflow.sinks.buckets import BucketedTable, Merged

REPLACED = [name for name in GOLD if name != "articles"]


def create_tables(spark: SparkSession, database: str = "gold") -> None:
    """Create the warehouse tables that do not exist yet.

    A table that is replaced as a whole is a view of the rows written last.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in REPLACED:
        if not spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name}_rows_0 ({GOLD[name]}) USING parquet")
            _show(spark, database, name, 0)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.dq_results ({DQ_RESULTS}) USING parquet")


def _show(spark: SparkSession, database: str, name: str, version: int) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{name}_rows_{version}")


def _versions(spark: SparkSession, database: str, name: str) -> list[int]:
    """Versions of a table's rows, oldest first."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return sorted(int(n.rsplit("_", 1)[1]) for n in names if n.startswith(f"{name}_rows_"))


def write_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str = "gold") -> int:
    """Write the next rows of tables (O60), after their keys are checked (O63); returns the version
    that ``show_tables`` switches to. If one cannot be written, none is left.

    The rows are checked and written, so they should read stored gold, not rebuild it.
    """
    version = time.time_ns()
    try:
        for name, rows in tables.items():
            assert_keys(rows, GOLD_KEYS[name], name)
            columns = spark.table(f"{database}.{name}").columns
            rows.select(*columns).write.format("parquet").saveAsTable(f"{database}.{name}_rows_{version}")
    except Exception:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}_rows_{version}")
        raise
    return version


def show_tables(spark: SparkSession, names: list[str], version: int, database: str = "gold") -> None:
    """Switch the views of tables to rows that are all written. The rows before stay until the next
    switch, for queries that still read them."""
    for name in names:
        _show(spark, database, name, version)
    for name in names:
        for old in _versions(spark, database, name)[:-2]:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}_rows_{old}")


def append_quality_results(spark: SparkSession, results: DataFrame, database: str = "gold") -> None:
    """Add one run's rows to the quality history."""
    columns = spark.table(f"{database}.dq_results").columns
    results.select(*columns).write.insertInto(f"{database}.dq_results")


def articles_table(spark: SparkSession, database: str = "gold") -> BucketedTable:
    """The stored articles, below the database's folder."""
    root = spark.catalog.getDatabase(database).locationUri
    return BucketedTable(f"{root}/articles_buckets", f"{GOLD['articles']}, ingested_at TIMESTAMP", GOLD_KEYS["articles"])


def merge_articles(
    spark: SparkSession, updates: DataFrame, database: str = "gold",
    load_ts: Column | None = None, buckets: int | None = None,
) -> Merged:
    """Merge articles by id (O61); merged rows get the load time.

    Only the buckets that hold an updated id are rewritten, see ``BucketedTable``. Readers of the view
    ``articles`` see the state before until ``show_articles``.

    ``buckets`` should let a bucket fit a task; it follows the session's shuffle partitions.
    """
    assert_keys(updates, GOLD_KEYS["articles"], "articles")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ingested_at = F.current_timestamp() if load_ts is None else load_ts
    return articles_table(spark, database).merge(updates.withColumn("ingested_at", ingested_at), buckets)


def show_articles(spark: SparkSession, database: str = "gold") -> None:
    """Switch the view ``articles`` to the newest version. The one before stays until the next merge,
    for queries that still read it."""
    table = articles_table(spark, database)
    if table.manifest(spark) is not None:
        rows = table.select_statement(spark)
    else:  # a warehouse that has been given no article yet
        columns = (part.split() for part in table.schema.replace("\n", " ").split(","))
        rows = f"SELECT {', '.join(f'CAST(NULL AS {kind}) AS {name}' for name, kind in columns)} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {database}.articles AS {rows}")


def upsert_articles(
    spark: SparkSession, updates: DataFrame, database: str = "gold",
    load_ts: Column | None = None, buckets: int | None = None,
) -> Merged:
    """``merge_articles`` and ``show_articles``."""
    merged = merge_articles(spark, updates, database, load_ts, buckets)
    show_articles(spark, database)
    return merged


def merge_into(
    updates: DataFrame, table: str, keys: list[str], load_ts: Column | None = None
) -> None:
    """Merge into a table whose catalog supports MERGE (O61), which rewrites only the files
    that hold updated rows."""
    ingested_at = F.current_timestamp() if load_ts is None else load_ts
    same = reduce(Column.__and__, [F.col(f"u.{k}") == F.col(f"{table}.{k}") for k in keys])
    (
        updates.withColumn("ingested_at", ingested_at).alias("u")
        .mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    )


# ---------------------------------------------------------------------------- database targets

_SQL_TYPES = {"STRING": "TEXT", "BIGINT": "BIGINT", "INT": "INTEGER", "DATE": "DATE",
              "TIMESTAMP": "TIMESTAMPTZ", "BOOLEAN": "BOOLEAN"}


def database_ddl(database: str = "gold") -> list[str]:
    """Statements that create the warehouse in a database (O59), with the keys merges rely on."""
    made = [f"CREATE SCHEMA IF NOT EXISTS {database}"]
    for name, schema in GOLD.items():
        columns = [part.split() for part in schema.replace("\n", " ").split(",")]
        listed = [f"{column} {_SQL_TYPES[kind]}" for column, kind in columns]
        if name == "articles":
            listed.append("ingested_at TIMESTAMPTZ DEFAULT now()")
        listed.append(f"PRIMARY KEY ({', '.join(GOLD_KEYS[name])})")
        made.append(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(listed)})")
    results = [part.split() for part in DQ_RESULTS.split(",")]
    listed = ", ".join(f"{column} {_SQL_TYPES[kind]}" for column, kind in results)
    return [*made, f"CREATE TABLE IF NOT EXISTS {database}.dq_results ({listed})"]


def _in_one_transaction(spark: SparkSession, url: str, properties: dict[str, str], statements: list[str]) -> None:
    """Run statements on the driver; none takes effect if one fails."""
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for key, value in properties.items():
        login.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()


def _through_stage(
    rows: DataFrame, url: str, table: str, properties: dict[str, str], statements_for
) -> None:
    """Write a stage table from the executors and run statements over it in one transaction. The
    stage is dropped, also when they fail."""
    stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    try:
        (
            rows.write.format("jdbc").option("url", url).option("dbtable", stage)
            .option("batchsize", "5000").options(**properties).mode("overwrite").save()
        )
        _in_one_transaction(rows.sparkSession, url, properties, statements_for(stage))
    finally:
        _in_one_transaction(rows.sparkSession, url, properties, [f"DROP TABLE IF EXISTS {stage}"])


def jdbc_replace(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replace the rows of a database table (O60): readers see the old rows or the new ones."""
    listed = ", ".join(rows.columns)
    _through_stage(rows, url, table, properties, lambda stage: [
        f"DELETE FROM {table}", f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage}"])


def upsert_statement(table: str, stage: str, columns: list[str], keys: list[str]) -> str:
    """Merge of a stage table into its target, in the ON CONFLICT form."""
    listed = ", ".join(columns)
    replaced = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {replaced}, ingested_at = now()"
    )


def jdbc_create(spark: SparkSession, url: str, properties: dict[str, str], database: str = "gold") -> None:
    """Create the warehouse in a database, where it does not exist yet."""
    _in_one_transaction(spark, url, properties, database_ddl(database))


def jdbc_upsert(
    rows: DataFrame, url: str, table: str, keys: list[str], properties: dict[str, str]
) -> None:
    """Merge rows into a database table by key (O61); see ``database_ddl`` for the key it needs."""
    _through_stage(rows, url, table, properties, lambda stage: [
        upsert_statement(table, stage, rows.columns, keys)])
