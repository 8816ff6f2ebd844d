"""Gold that follows the dates a batch touches."""

import json
from datetime import date

from pyspark.sql import functions as F

from pressflow.plans.incremental import IncrementalGold, _partials
from pressflow.plans.pipeline import gold_tables
from pressflow.schemas import SILVER
from pressflow.sinks.lake import compact
from pressflow.streaming.ingest import SOURCE_FOLDERS, Ingest


def event(id_, day, title="some news", source="BBC News", **more):
    return json.dumps({"titre_article": title, "date_publication": day, "contenu": "words " * 30, "source": source,
                       "url": f"u{id_}", "id": id_, "scraped_at": "2026-01-09T00:00:00+00:00", **more})


def deliver(spark, job, batch_id, *bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "value STRING").withColumns(
        {"ingest_ts": F.timestamp_seconds(F.lit(batch_id)), "src_offset": F.lit(0).cast("bigint")})
    job.write(df, batch_id)


def same_as_rebuilt(spark, job, gold):
    expected = gold_tables(job.silver(spark))
    for name, table in expected.items():
        got = gold.table(spark, name).select(*table.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, table.collect())), name


def files_of(root):
    return {str(p): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_late_and_corrected_batches(spark, tmp_path, monkeypatch):
    job = Ingest(str(tmp_path / "lake"))
    gold = IncrementalGold(job.root, str(tmp_path / "gold"))
    assert gold.update(spark) == []
    deliver(spark, job, 0, event("a", "2026-01-01"), event("b", "2026-01-01T23:30:00-05:00", "other words"),
            event("c", "2026-01-03"))
    assert gold.update(spark) == [date(2026, 1, 1), date(2026, 1, 3)]
    same_as_rebuilt(spark, job, gold)
    before = files_of(tmp_path / "gold" / "keywords")
    # a correction that changes words and day within its date, and a late article
    deliver(spark, job, 1, event("b", "2026-01-01T23:30:00+05:00", "new words", source="BBC News"),
            event("d", "2026-01-02", "late news", "CNN"))
    assert gold.update(spark) == [date(2026, 1, 1), date(2026, 1, 2)]
    same_as_rebuilt(spark, job, gold)
    after = files_of(tmp_path / "gold" / "keywords")
    kept = {p for p in before if "dt=2026-01-03" in p}
    assert kept and all(after[p] == before[p] for p in kept)
    assert gold.update(spark) == []
    # the same article under a later date, after the batches before were merged
    deliver(spark, job, 2, event("a", "2026-01-05"), event("short", "2026-01-07", contenu="x"))
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=1)
    assert gold.update(spark) == [date(2026, 1, 5)]
    same_as_rebuilt(spark, job, gold)
    # merged before gold has seen them: all dates of the merged batch
    deliver(spark, job, 3, event("e", "2026-01-03"))
    deliver(spark, job, 4, event("f", "2026-01-03", "more news"))
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=4)
    assert date(2026, 1, 3) in gold.update(spark)
    same_as_rebuilt(spark, job, gold)


def test_counts_read_no_silver_again(spark, tmp_path):
    job = Ingest(str(tmp_path / "lake"))
    deliver(spark, job, 0, event("a", "2026-01-01"), event("b", "2026-01-02", source="CNN"))
    partials = _partials(job.silver(spark), None, str(tmp_path / "update"))
    for name in ("per_day", "per_theme", "per_country"):
        files = partials[name].inputFiles()
        assert files and all("/update/facts/" in f for f in files)
        assert sum(r["n_articles"] for r in partials[name].collect()) == 2


def test_update_leaves_no_lists(spark, tmp_path, monkeypatch):
    from pressflow.plans import incremental

    monkeypatch.setattr(incremental, "working_dir", lambda spark, name: str(tmp_path / name))
    job = Ingest(str(tmp_path / "lake"))
    gold = IncrementalGold(job.root, str(tmp_path / "gold"))
    for batch_id in range(2):  # the second replaces the first
        deliver(spark, job, batch_id, event("a", "2026-01-01", f"title {batch_id}"), event("", "2026-01-01"))
        gold.update(spark)
        same_as_rebuilt(spark, job, gold)
    assert not (tmp_path / "update").exists()


def test_only_touched_dates_are_read(spark, tmp_path):
    job = Ingest(str(tmp_path / "lake"))
    gold = IncrementalGold(job.root, str(tmp_path / "gold"))
    deliver(spark, job, 0, *(event(f"a{d}", f"2026-01-0{d}") for d in range(1, 9)))
    gold.update(spark)
    plan = gold.table(spark, "articles_per_day", since=date(2026, 1, 6))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    days = {r["day"] for r in gold.table(spark, "top_keywords", since=date(2026, 1, 6)).collect()}
    assert days == {date(2026, 1, d) for d in (6, 7, 8)}


def test_update_that_stops_is_made_up_for(spark, tmp_path, monkeypatch):
    from pressflow.plans import incremental

    job = Ingest(str(tmp_path / "lake"))
    gold = IncrementalGold(job.root, str(tmp_path / "gold"))
    deliver(spark, job, 0, event("a", "2026-01-01"))
    plain = incremental._partials
    monkeypatch.setattr(incremental, "_partials", lambda *a: {
        k: v if k != "per_theme" else (_ for _ in ()).throw(RuntimeError("lost")) for k, v in plain(*a).items()})
    try:
        gold.update(spark)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert gold.update(spark) == [date(2026, 1, 1)]
    same_as_rebuilt(spark, job, gold)
