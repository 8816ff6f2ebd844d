"""Gold build and warehouse load."""

from datetime import datetime
from unittest.mock import MagicMock

import duckdb
import pytest
from pyspark.sql import functions as F

from pressflow.operators.upsert import upsert
from pressflow.plans.pipeline import build_gold, gold_tables, load_warehouse, read_gold
from pressflow.schemas import GOLD
from pressflow.operators.quality import quality_results
from pressflow.sinks.buckets import BucketedTable
from pressflow.sinks.warehouse import (
    append_quality_results,
    create_tables,
    database_ddl,
    jdbc_replace,
    jdbc_upsert,
    upsert_articles,
    upsert_statement,
)
from pressflow.sources import sample
from pressflow.sources.events import landed_events
from pressflow.sinks.events import as_messages, land_text
from pressflow.streaming.ingest import Ingest
from tests_paths import SMALL

ONE, TWO = datetime(2026, 1, 1), datetime(2026, 1, 2)


def at(ts):
    return F.lit(ts).cast("timestamp")


@pytest.fixture
def tables(spark):
    target = spark.createDataFrame(
        [("a", "old a", ONE), ("b", "old b", ONE)], "id STRING, title STRING, ingested_at TIMESTAMP")
    updates = spark.createDataFrame([("b", "new b"), ("c", None)], "id STRING, title STRING")
    return target, updates


def test_upsert_replaces_adds_and_keeps(tables):
    got = {tuple(r) for r in upsert(*tables, ["id"], at(TWO)).collect()}
    assert got == {("a", "old a", ONE), ("b", "new b", TWO), ("c", None, TWO)}


def test_upsert_twice_is_upsert_once(tables):
    target, updates = tables
    once = upsert(target, updates, ["id"], at(TWO))
    twice = upsert(once, updates, ["id"], at(TWO))
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_merge_statement_runs():
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id TEXT PRIMARY KEY, title TEXT, ingested_at TIMESTAMPTZ DEFAULT now())")
    con.execute("CREATE TABLE s (id TEXT, title TEXT)")
    con.execute("INSERT INTO t VALUES ('a', 'old a', '2026-01-01'), ('b', 'old b', '2026-01-01')")
    con.execute("INSERT INTO s VALUES ('b', 'new b'), ('c', 'new c')")
    con.execute(upsert_statement("t", "s", ["id", "title"], ["id"]))
    rows = con.execute("SELECT id, title, ingested_at > '2026-06-01' FROM t ORDER BY id").fetchall()
    assert rows == [("a", "old a", False), ("b", "new b", True), ("c", "new c", True)]


def jdbc_calls(fail=False):
    """A stand-in for a DataFrame with a database behind it, and what was called on that."""
    rows = MagicMock(columns=["id", "title"])
    connection = rows.sparkSession.sparkContext._jvm.java.sql.DriverManager.getConnection.return_value
    if fail:
        connection.createStatement.return_value.executeUpdate.side_effect = RuntimeError("no")
    return rows, connection


def run_statements(connection):
    return [c.args[0] for c in connection.createStatement.return_value.executeUpdate.call_args_list]


def test_database_merge_is_one_transaction():
    rows, connection = jdbc_calls()
    jdbc_upsert(rows, "jdbc:x", "gold.articles", ["id"], {"user": "u"})
    calls = [c[0] for c in connection.mock_calls]
    assert calls[:5] == ["setAutoCommit", "createStatement", "createStatement().executeUpdate", "commit", "close"]
    merge, drop = run_statements(connection)
    assert merge.startswith("INSERT INTO gold.articles")
    assert drop.startswith("DROP TABLE IF EXISTS gold.articles_stage_")
    rows, connection = jdbc_calls(fail=True)
    with pytest.raises(RuntimeError):
        jdbc_upsert(rows, "jdbc:x", "gold.articles", ["id"], {})
    connection.commit.assert_not_called()
    connection.rollback.assert_called()
    assert run_statements(connection)[-1].startswith("DROP TABLE IF EXISTS gold.articles_stage_")


def test_database_replace_is_one_transaction():
    rows, connection = jdbc_calls()
    jdbc_replace(rows, "jdbc:x", "gold.articles_per_day", {"user": "u"})
    delete, insert, drop = run_statements(connection)
    assert delete == "DELETE FROM gold.articles_per_day"
    assert insert.startswith("INSERT INTO gold.articles_per_day (id, title) SELECT id, title FROM")
    calls = [c[0] for c in connection.mock_calls]
    assert calls.index("commit") == calls.index("close") - 1 == 4


def test_database_tables_have_the_keys_merges_need():
    con = duckdb.connect()
    for _ in range(2):
        for sql in database_ddl("gold"):
            con.execute(sql)
    con.execute("CREATE TABLE s AS SELECT 'a' AS id, 'new' AS title")
    con.execute("INSERT INTO gold.articles (id, title) VALUES ('a', 'old')")
    con.execute(upsert_statement("gold.articles", "s", ["id", "title"], ["id"]))
    assert con.execute("SELECT id, title FROM gold.articles").fetchall() == [("a", "new")]


def article(spark, *rows):
    blank = [F.lit(None).cast(part.split()[1]).alias(part.split()[0])
             for part in GOLD["articles"].replace("\n", " ").split(",")[2:]]
    return spark.createDataFrame(list(rows), "id STRING, title STRING").select("id", "title", *blank)


def test_article_versions_switch(spark):
    create_tables(spark, "wh1")
    upsert_articles(spark, article(spark), "wh1", at(ONE), buckets=2)
    assert spark.table("wh1.articles").count() == 0
    upsert_articles(spark, article(spark, ("a", "1"), ("b", "1")), "wh1", at(ONE), buckets=2)
    upsert_articles(spark, article(spark, ("b", "2"), ("c", "2")), "wh1", at(TWO), buckets=2)
    upsert_articles(spark, article(spark), "wh1", at(TWO), buckets=2)
    got = {(r["id"], r["title"], r["ingested_at"]) for r in spark.table("wh1.articles").collect()}
    assert got == {("a", "1", ONE), ("b", "2", TWO), ("c", "2", TWO)}
    with pytest.raises(ValueError):
        upsert_articles(spark, article(spark, ("d", "1"), ("d", "2")), "wh1", at(TWO))


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "id STRING, n INT")


def files_of(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def contents(table, spark):
    return sorted((r["id"], r["n"]) for r in table.read(spark).collect())


def test_merge_leaves_other_buckets_in_place(spark, tmp_path):
    table = BucketedTable(str(tmp_path), "id STRING, n INT", ["id"])
    assert contents(table, spark) == []
    first = table.merge(keyed(spark, *((f"k{i}", 0) for i in range(400))), 100)
    assert first.kept == [] and len(first.rewritten) > 90
    before = files_of(tmp_path / "files")
    second = table.merge(keyed(spark, ("k7", 1), ("new", 2), ("k300", 1)), 7)
    assert 1 <= len(second.rewritten) <= 3 and len(second.rewritten) + len(second.kept) >= len(first.rewritten)
    after = files_of(tmp_path / "files")
    assert {f: t for f, t in after.items() if f in before} == before
    added = {f.rsplit("/", 1)[0] for f in after.keys() - before.keys()}
    assert added == {f"version=2/bucket={b}" for b in second.rewritten}
    expected = {f"k{i}": 0 for i in range(400)} | {"k7": 1, "new": 2, "k300": 1}
    assert contents(table, spark) == sorted(expected.items())
    manifest = table.manifest(spark)
    assert manifest.agg(F.sum("n_rows")).first()[0] == 401
    assert {r["buckets"] for r in manifest.collect()} == {100}


def test_merge_reads_and_shuffles_touched_buckets_only(spark, tmp_path, monkeypatch):
    table = BucketedTable(str(tmp_path), "id STRING, n INT", ["id"])
    table.merge(keyed(spark, *((f"k{i}", 0) for i in range(300))), 50)
    read = []
    monkeypatch.setattr(BucketedTable, "_files", lambda self, s, rows, plain=BucketedTable._files: read.append(
        [r["bucket"] for r in rows]) or plain(self, s, rows))
    merged = table.merge(keyed(spark, ("k1", 1)), 50)
    assert read == [merged.rewritten] and len(merged.rewritten) == 1


def test_failed_merge_shows_nothing(spark, tmp_path, monkeypatch):
    table = BucketedTable(str(tmp_path), "id STRING, n INT", ["id"])
    table.merge(keyed(spark, ("a", 0), ("b", 0)), 4)
    with monkeypatch.context() as patch:
        patch.setattr(BucketedTable, "_commit", MagicMock(side_effect=RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(keyed(spark, ("a", 9), ("c", 9)), 4)
    assert (tmp_path / "files" / "version=2").exists()
    assert contents(table, spark) == [("a", 0), ("b", 0)]
    table.merge(keyed(spark, ("b", 1)), 4)
    assert contents(table, spark) == [("a", 0), ("b", 1)]


def test_failed_load_switches_no_table(spark, tmp_path):
    def gold(name, n, broken=False):
        path = str(tmp_path / name)
        for table, schema in GOLD.items():
            rows = spark.createDataFrame([], schema)
            if table == "articles_per_source":
                rows = spark.createDataFrame([("S", n, None)] * (2 if broken else 1), schema)
            if table == "articles_per_day":
                rows = spark.createDataFrame([(ONE.date(), "S", n)], schema)
            rows.write.parquet(f"{path}/{table}")
        return path

    load_warehouse(spark, gold("one", 1), "wh6", at(ONE))
    with pytest.raises(ValueError):
        load_warehouse(spark, gold("two", 2, broken=True), "wh6", at(TWO))
    shown = [spark.table(f"wh6.{t}").first()["n_articles"] for t in ("articles_per_day", "articles_per_source")]
    assert shown == [1, 1]
    for n in (3, 4):
        load_warehouse(spark, gold(f"more{n}", n), "wh6", at(TWO))
    assert spark.table("wh6.articles_per_day").first()["n_articles"] == 4
    assert sum(t.name.startswith("articles_per_day_rows") for t in spark.catalog.listTables("wh6")) == 2


def test_older_versions_go(spark, tmp_path):
    table = BucketedTable(str(tmp_path), "id STRING, n INT", ["id"])
    for n in range(5):
        table.merge(keyed(spark, ("a", n), (f"b{n}", n)), 1)
    assert contents(table, spark) == [("a", 4)] + [(f"b{n}", n) for n in range(5)]
    assert sorted(p.name for p in (tmp_path / "manifest").iterdir()) == ["version=4", "version=5"]
    assert [r["n"] for r in table.read(spark, 4).where("id = 'a'").collect()] == [3]
    assert len(files_of(tmp_path / "files")) == 2
    assert table.merge(keyed(spark), 1).rewritten == [] and table._committed(spark) == [4, 5]


def test_silver_to_warehouse(spark, tmp_path):
    land_text(sample.articles_raw(spark, SMALL), str(tmp_path / "landing"))
    job = Ingest(str(tmp_path / "lake"))
    counts = job.drain(landed_events(spark, str(tmp_path / "landing")))
    gold = str(tmp_path / "gold")
    summary = build_gold(spark, job.layer("silver"), gold).first()
    distinct = job.silver(spark).select("id").distinct().count()
    assert summary["rows_silver"] == counts["ok"] and summary["articles"] == distinct < counts["ok"]
    stored = read_gold(spark, gold)
    assert stored["articles_per_day"].agg(F.sum("n_articles")).first()[0] == counts["ok"]
    plan = stored["top_keywords"].where("day >= date'2024-01-23'")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day" in plan
    loads = [load_warehouse(spark, gold, "wh3", at(ts)).first() for ts in (ONE, TWO)]
    for load in loads:
        assert load["articles"] == distinct and load["top_keywords"] == summary["top_keywords"]
    assert spark.table("wh3.articles").select("ingested_at").distinct().collect()[0][0] == TWO


def test_quality_history_grows(spark):
    create_tables(spark, "wh5")
    tagged = spark.createDataFrame([("missing_title",), (None,)], "dq_reason STRING")
    for ts in (ONE, TWO):
        append_quality_results(spark, quality_results(tagged, at(ts)), "wh5")
    got = spark.table("wh5.dq_results").where("check_name = 'missing_title'").collect()
    assert sorted((r["run_at"], r["passed"]) for r in got) == [(ONE, False), (TWO, False)]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_gold_is_the_same_however_repeats_are_joined(spark, tmp_path, threshold):
    raw = sample.articles_raw(spark, SMALL)
    job = Ingest(str(tmp_path / "lake"))
    events = as_messages(raw).select("value").withColumns(
        {"ingest_ts": at(ONE), "src_offset": F.xxhash64("value")})
    job.write(events, 0)
    # every third article again, with another title
    again = raw.where("conv(substring(id, 1, 2), 16, 10) % 3 = 0").withColumn(
        "titre_article", F.lit("second delivery"))
    job.write(as_messages(again).select("value").withColumns(
        {"ingest_ts": at(TWO), "src_offset": F.xxhash64("value")}), 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        build_gold(spark, job.layer("silver"), str(tmp_path / "gold"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stored = read_gold(spark, str(tmp_path / "gold"))
    expected = gold_tables(job.silver(spark))
    for name, table in stored.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, expected[name].collect())), name
    titles = stored["articles"].where("title = 'second delivery'").count()
    assert 0 < titles < stored["articles"].count()


def test_missing_gold_stops_the_load(spark, tmp_path):
    with pytest.raises(Exception):
        load_warehouse(spark, str(tmp_path / "none"), "wh4")
