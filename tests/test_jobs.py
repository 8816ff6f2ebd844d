"""The scheduled tasks, one after the other, as their commands."""

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from pressflow.plans.jobs import main
from pressflow.sinks.warehouse import create_tables, merge_into
from pressflow.sources import sample
from tests_paths import SMALL


def test_chain_of_tasks(spark, tmp_path, capsys):
    sample.page_feeds(spark, SMALL).write.parquet(str(tmp_path / "feeds"))
    sample.page_sources(spark, SMALL).write.parquet(str(tmp_path / "pages"))
    at = {name: str(tmp_path / name) for name in ("events", "lake", "gold", "model")}
    main(["publish", "--feeds", str(tmp_path / "feeds"), "--pages", str(tmp_path / "pages"),
          "--events", at["events"], "--max-items", "10"])
    main(["train", "--labelled", f"{SMALL}/documents.parquet", "--model", at["model"]])
    main(["drain", "--events", at["events"], "--lake", at["lake"], "--model", at["model"]])
    main(["gold", "--lake", at["lake"], "--gold", at["gold"], "--top-keywords", "5"])
    main(["load", "--gold", at["gold"], "--database", "chain"])
    published = spark.read.text(at["events"]).count()
    articles = spark.table("chain.articles")
    assert 0 < articles.count() <= published
    assert articles.where("language IS NOT NULL AND language <> 'unknown'").count() > 0
    per_day = spark.table("chain.top_keywords").groupBy("day").count()
    assert per_day.agg(F.max("count")).first()[0] == 5
    assert "'ok':" in capsys.readouterr().out


def test_events_come_from_one_place():
    with pytest.raises(SystemExit):
        main(["drain", "--lake", "x"])
    with pytest.raises(SystemExit):
        main(["drain", "--lake", "x", "--events", "a", "--kafka", "b"])


def test_merge_needs_a_catalog_that_supports_it(spark):
    create_tables(spark, "merging")
    spark.sql("CREATE TABLE merging.keywords (keyword STRING, day DATE, n_occurrences BIGINT, ingested_at TIMESTAMP) "
              "USING parquet")
    updates = spark.createDataFrame([("k", None, 1)], "keyword STRING, day DATE, n_occurrences LONG")
    with pytest.raises(UnsupportedOperationException, match="MERGE"):
        merge_into(updates, "merging.keywords", ["keyword", "day"])


def test_load_into_a_database(spark, tmp_path, monkeypatch):
    from pressflow.plans import pipeline
    from pressflow.schemas import GOLD

    for name, schema in GOLD.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    calls = []
    for name in ("jdbc_create", "jdbc_replace", "jdbc_upsert"):
        monkeypatch.setattr(pipeline, name, lambda *args, name=name: calls.append((name, args[1:])))
    main(["load", "--gold", str(tmp_path), "--database", "wh", "--jdbc", "jdbc:x", "--property", "user=u",
          "--property", "password=a=b"])
    properties = {"user": "u", "password": "a=b"}
    assert calls[0] == ("jdbc_create", ("jdbc:x", properties, "wh"))
    assert sorted(c[1][1] for c in calls[1:-1]) == sorted(f"wh.{n}" for n in GOLD if n != "articles")
    assert calls[-1] == ("jdbc_upsert", ("jdbc:x", "wh.articles", ["id"], properties))
