"""O01, O02, O16, O17, O25-O27, O82-O84, O89."""

import hashlib
import json
import shutil

import pytest
from pyspark.sql import functions as F

from pressflow.functions.text import packed, unpacked
from pressflow.operators import quality
from pressflow.operators.gold import articles_per_day, silver_view
from pressflow.operators.silver import to_silver
from pressflow.schemas import BRONZE, RAW_COLUMNS, REJECTS, SILVER
from pressflow.sinks.events import as_messages, land_text
from pressflow.sources import sample
from pressflow.sources.events import decode_events, landed_events
from pressflow.sources.tables import (
    read_layer,
    scan_parquet,
    scan_silver,
    scan_silver_json,
    silver_json_rejects,
)
from pressflow.streaming import daily
from pressflow.sinks.lake import compact, export_json
from pressflow.streaming.ingest import (
    SOURCE_FOLDERS,
    Ingest,
    tagged_events,
    without_redeliveries,
)
from tests_paths import SMALL


def event(**fields):
    full = {"titre_article": "t", "date_publication": "2026-01-01T00:00:00+00:00",
            "contenu": "c" * 120, "source": "BBC News", "url": "u", "id": "a",
            "scraped_at": "2026-01-01T00:00:00+00:00"}
    return json.dumps({**full, **fields})


def values(spark, rows):
    df = spark.createDataFrame([(v,) for v in rows], "value STRING")
    return df.withColumns({"ingest_ts": F.current_timestamp(), "src_offset": F.lit(0).cast("bigint")})


def write_lines(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")


@pytest.mark.parametrize("body, reason", [
    (event(), None), ("{bad", "corrupt_json"), ("[1]", "corrupt_json"), ("null", "missing_title"),
    (None, "missing_title"), ("{}", "missing_title"), (event(id=7, extra={"k": 1}), None),
    (event(titre_article=12), None), (event(date_publication=None), "missing_date"),
])
def test_bodies(spark, body, reason):
    row = tagged_events(values(spark, [body])).first()
    assert row["dq_reason"] == reason and row["value"] == body


def test_numbers_are_read_as_text(spark):
    assert decode_events(values(spark, [event(id=7)])).first()["id"] == "7"


def test_messages_round_trip_with_nulls(spark):
    raw = spark.createDataFrame(
        [("t", None, None, None, "c\n\"é\"", "s", "u", "i", "now")], ", ".join(f"{c} STRING" for c in RAW_COLUMNS))
    message = as_messages(raw).first()
    assert message["key"] == "i" and json.loads(message["value"])["auteur"] is None
    back = decode_events(values(spark, [message["value"]])).select(*RAW_COLUMNS).first()
    assert back == raw.first()


def test_drain_files_every_event_and_picks_up_where_it_stopped(spark, tmp_path):
    landing = tmp_path / "landing"
    write_lines(landing, "one", [
        event(id="a"), event(id="b", contenu="short"), "{bad", "null",
        event(id="c", source="***", date_publication="20260102")])
    job = Ingest(str(tmp_path / "lake"))
    events = landed_events(spark, str(landing), max_files_per_trigger=1)
    assert job.drain(events) == {"ok": 2, "rejected": 3}
    bronze = {(r["id"], r["source_key"], str(r["dt"])) for r in job.bronze(spark).where("id is not null").collect()}
    assert bronze == {("a", "BBC_News", "2026-01-01"), ("b", "BBC_News", "2026-01-01"), ("c", "unknown", "2026-01-02")}
    reasons = sorted(r["dq_reason"] for r in job.rejects(spark).collect())
    assert reasons == ["content_too_short", "corrupt_json", "missing_title"]
    assert {r["value"] for r in job.rejects(spark).collect()} >= {"{bad", "null"}
    # nothing new: nothing written
    assert job.drain(events) == {"ok": 0, "rejected": 0}
    # a redelivered and a corrected event; another job object continues from the checkpoint
    write_lines(landing, "two", [event(id="a"), event(id="c", source="***", date_publication="20260102", titre_article="new")])
    again = Ingest(str(tmp_path / "lake"))
    assert again.drain(events) == {"ok": 2, "rejected": 0}
    assert {(r["id"], r["titre_article"]) for r in again.silver(spark).collect()} == {("a", "t"), ("c", "new")}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    job = Ingest(str(tmp_path))
    batch = values(spark, [event(id="a"), event(id="b", contenu="")])
    job.write(batch, 0)
    job.write(batch, 0)
    assert spark.read.schema(SILVER).parquet(job.layer("silver")).count() == 1
    assert job.rejects(spark).count() == 1 and job.bronze(spark).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    raw = sample.articles_raw(spark, SMALL)
    land_text(raw.repartition(5), str(tmp_path / "landing"))
    job = Ingest(str(tmp_path / "lake"))
    job.drain(landed_events(spark, str(tmp_path / "landing"), max_files_per_trigger=2))
    assert len(job.counts) > 1
    columns = [*RAW_COLUMNS, "word_count", "char_count"]
    batch = to_silver(quality.passed(quality.tag_quality(raw))).select(*columns)
    streamed = job.silver(spark).select(*columns)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).isEmpty()
    # every event landed once, as silver or as a reject
    bronze = job.bronze(spark).count()
    assert bronze == streamed.count() + job.rejects(spark).count() == raw.count()


def test_daily_counts_follow_the_stream(spark, tmp_path):
    raw = sample.articles_raw(spark, SMALL)
    land_text(raw.repartition(4), str(tmp_path / "landing"))
    job = Ingest(str(tmp_path / "lake"))
    job.drain(landed_events(spark, str(tmp_path / "landing"), max_files_per_trigger=2))
    stream = daily.silver_stream(spark, job.layer("silver"))
    daily.write_updates(daily.daily_counts(stream, "60 days"), str(tmp_path / "counts"),
                        str(tmp_path / "checkpoint"), {"availableNow": True}).awaitTermination()
    got = daily.latest_updates(spark, str(tmp_path / "counts"),
                               "day DATE, source STRING, n_articles BIGINT", ["day", "source"])
    expected = articles_per_day(silver_view(job.silver(spark)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_message_rate_over_a_sliding_window(spark, tmp_path):
    stamps = [(f"2026-01-01 00:0{i}:00",) for i in range(3)]
    (spark.createDataFrame(stamps, "s STRING").selectExpr("cast(s AS timestamp) ingest_ts")
     .coalesce(1).write.parquet(str(tmp_path / "in")))
    stream = spark.readStream.schema("ingest_ts TIMESTAMP").parquet(str(tmp_path / "in"))
    query = (daily.message_rate(stream).writeStream.outputMode("complete").format("memory")
             .queryName("rates").trigger(availableNow=True).start())
    query.awaitTermination()
    got = {str(r["ts"]): r["rate"] for r in spark.table("rates").collect()}
    assert got["2026-01-01 00:03:00"] == pytest.approx(3 / 300)
    assert got["2026-01-01 00:01:00"] == pytest.approx(1 / 300)


def test_net_counts_follow_corrections(spark, tmp_path):
    from datetime import date

    def deliver(batch_id, *rows):
        df = spark.createDataFrame(list(rows), "id STRING, date_publication STRING, source STRING, at INT")
        silver = df.selectExpr("*", *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in (
            part.split() for part in SILVER.replace("\n", " ").split(","))
            if name not in ("id", "date_publication", "source", "ingest_ts", "src_offset")])
        silver = silver.withColumns({"ingest_ts": F.timestamp_seconds("at"), "src_offset": F.lit(0).cast("bigint"),
                                     "source_key": F.lit("k"), "dt": F.lit("2026-01-01").cast("date")}).drop("at")
        silver.write.parquet(f"{tmp_path}/silver/batch_id={batch_id}")
        daily.write_changes(daily.daily_changes(daily.silver_stream(spark, f"{tmp_path}/silver")),
                            f"{tmp_path}/changes", f"{tmp_path}/checkpoint", {"availableNow": True}).awaitTermination()
        return {(r["day"], r["source"]): r["n_articles"] for r in daily.net_counts(spark, f"{tmp_path}/changes").collect()}

    one, two = date(2026, 1, 1), date(2026, 1, 2)
    assert deliver(0, ("a", "2026-01-01", "S", 1), ("b", "2026-01-01T10:00:00Z", None, 1), ("a", "2026-01-01", "S", 2)
                   ) == {(one, "S"): 1, (one, "unknown"): 1}
    # a moves on, an older delivery of b changes nothing, c is new
    assert deliver(1, ("a", "2026-01-02", "S", 3), ("b", "2026-01-02", None, 0), ("c", "2026-01-02", "S", 1)
                   ) == {(two, "S"): 2, (one, "unknown"): 1}
    # a again as it is, b under another source, c without a date
    assert deliver(2, ("a", "2026-01-02", "S", 9), ("b", "2026-01-01", "T", 4), ("c", "soon", "S", 2)
                   ) == {(two, "S"): 1, (one, "T"): 1}


def test_scans(spark, tmp_path):
    assert scan_parquet(spark, str(tmp_path / "none"), REJECTS).isEmpty()
    job = Ingest(str(tmp_path))
    job.write(values(spark, [event(id="a"), event(id="b", source="CNN")]), 0)
    silver = scan_silver(spark, job.layer("silver"))
    assert silver.where("source_key = 'CNN'").count() == 1
    plan = silver.where("source_key = 'CNN'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_key" in plan
    # a damaged file stops the scan unless it may be skipped
    folder = next((tmp_path / "silver").rglob("source_key=BBC_News/dt=*"))
    (folder / "part-bad.parquet").write_bytes(b"damaged")
    with pytest.raises(Exception):
        scan_silver(spark, job.layer("silver")).collect()
    assert scan_silver(spark, job.layer("silver"), skip_unreadable=True).count() == 2


def test_compaction_changes_no_result(spark, tmp_path):
    job = Ingest(str(tmp_path))
    job.write(values(spark, [event(id="a", titre_article="1"), event(id="b")]), 0)
    job.write(values(spark, [event(id="a", titre_article="2"), event(id="c", source="CNN")]), 1)
    job.write(values(spark, [event(id="d"), event(id="a", titre_article="3")]), 2)
    before = sorted(map(tuple, job.silver(spark).collect()))
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=1)
    assert sorted(p.name for p in (tmp_path / "silver").glob("batch_id=*")) == ["batch_id=-1", "batch_id=2"]
    assert sorted(map(tuple, job.silver(spark).collect())) == before
    stored = spark.read.schema(SILVER).parquet(job.layer("silver"))
    assert stored.count() == 5
    # again, now over an already merged batch
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=2)
    assert [p.name for p in (tmp_path / "silver").glob("batch_id=*")] == ["batch_id=-2"]
    assert sorted(map(tuple, job.silver(spark).collect())) == before
    # nothing left to merge
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=2)
    assert sorted(map(tuple, job.silver(spark).collect())) == before


def events_of(df):
    return sorted(r["id"] for r in df.collect())


def test_batch_that_stops_between_layers_shows_in_none(spark, tmp_path, monkeypatch):
    from pressflow.streaming import ingest

    job = Ingest(str(tmp_path))
    short = event(id="short", contenu="x")
    plain = ingest.write_batch

    def stop_before(layer):
        def write(df, path, *rest):
            if path.endswith(layer):
                raise RuntimeError("lost")
            plain(df, path, *rest)
        monkeypatch.setattr(ingest, "write_batch", write)

    # the very first batch, then a later one
    for n, layer in enumerate(("rejects", "silver")):
        stop_before(layer)
        with pytest.raises(RuntimeError):
            job.write(values(spark, [event(id=f"a{n}"), short]), n)
        monkeypatch.undo()
        assert (tmp_path / "bronze" / f"batch_id={n}").exists()
        seen = sorted(["short"] * n + [f"a{k}" for k in range(n)])
        assert events_of(job.bronze(spark)) == sorted(set(seen))
        compact(spark, job.layer("bronze"), BRONZE, SOURCE_FOLDERS, up_to=n)
        assert (tmp_path / "bronze" / f"batch_id={n}").exists()
        if n:
            assert events_of(job.rejects(spark)) == ["short"] and events_of(job.silver(spark)) == ["a0"]
        # the stream replays it
        job.write(values(spark, [event(id=f"a{n}"), short]), n)
    assert events_of(job.bronze(spark)) == ["a0", "a1", "short"]
    assert events_of(job.rejects(spark)) == ["short", "short"]
    assert events_of(job.silver(spark)) == ["a0", "a1"]


def test_layers_without_records_count_as_they_are(spark, tmp_path):
    job = Ingest(str(tmp_path))
    for n in range(3):
        job.write(values(spark, [event(id=f"a{n}")]), n)
    shutil.rmtree(tmp_path / "commits")
    assert events_of(job.silver(spark)) == ["a0", "a1", "a2"]
    job.write(values(spark, [event(id="a3")]), 3)
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=2)
    assert events_of(job.silver(spark)) == ["a0", "a1", "a2", "a3"]


def test_merge_that_stops_before_its_record_shows_nothing_twice(spark, tmp_path, monkeypatch):
    from pressflow.sinks import lake

    job = Ingest(str(tmp_path))
    for n in range(4):
        job.write(values(spark, [event(id="short", contenu="x")]), n)
    compact(spark, job.layer("bronze"), BRONZE, SOURCE_FOLDERS, up_to=1)
    stored = spark.read.parquet(job.layer("bronze")).count()
    shown = read_layer(spark, job.layer("bronze"), BRONZE).count()
    with monkeypatch.context() as patch:
        patch.setattr(lake, "commit_merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact(spark, job.layer("bronze"), BRONZE, SOURCE_FOLDERS, up_to=3)
    assert spark.read.parquet(job.layer("bronze")).count() > stored
    assert read_layer(spark, job.layer("bronze"), BRONZE).count() == shown == 3
    compact(spark, job.layer("bronze"), BRONZE, SOURCE_FOLDERS, up_to=3)
    assert [p.name for p in (tmp_path / "bronze").glob("batch_id=*")] == ["batch_id=-3"]
    assert events_of(job.bronze(spark)) == ["short"]


def test_quality_history_has_each_batch_once(spark, tmp_path):
    job = Ingest(str(tmp_path))
    assert job.quality_history(spark).count() == 0
    bodies = [event(), event(titre_article=""), event(contenu="x"), "{bad"]
    for n in (0, 1, 1):  # the second one is replayed
        job.write(values(spark, bodies), n)
    got = {(r["batch_id"], r["check_name"]): (r["passed"], json.loads(r["details"]))
           for r in job.quality_history(spark).collect()}
    assert len(got) == job.quality_history(spark).count() == 8
    for n in (0, 1):
        assert got[n, "missing_title"] == (False, {"n_checked": 3, "n_failed": 1})
        assert got[n, "invalid_date"] == (True, {"n_checked": 2, "n_failed": 0})
        assert got[n, "content_too_short"] == (False, {"n_checked": 2, "n_failed": 1})


def test_bodies_without_an_id_are_all_kept(spark, tmp_path):
    job = Ingest(str(tmp_path))
    bad = ["{bad", "{worse", "[1]", "text"]
    nameless = [event(id=None, titre_article="x"), event(id="", titre_article="y")]
    job.write(values(spark, bad[:2] + nameless[:1]), 0)
    job.write(values(spark, bad[1:] + nameless + [event(id="a")]), 1)
    expected = sorted(bad + nameless + [event(id="a")])
    assert sorted(r["value"] for r in job.bronze(spark).collect()) == expected
    silver = sorted(r["titre_article"] for r in job.silver(spark).collect())
    for layer, schema in (("bronze", BRONZE), ("silver", SILVER)):
        compact(spark, job.layer(layer), schema, SOURCE_FOLDERS, up_to=1)
    assert sorted(r["value"] for r in job.bronze(spark).collect()) == expected
    assert sorted(r["titre_article"] for r in job.silver(spark).collect()) == silver
    assert {"x", "y"} <= set(silver)


def test_compaction_that_stopped_half_way_loses_nothing(spark, tmp_path, monkeypatch):
    from pressflow.sinks import lake

    job = Ingest(str(tmp_path))
    for n in range(3):
        job.write(values(spark, [event(id=f"a{n}"), event(id="same", titre_article=str(n))]), n)
    before = sorted(map(tuple, job.silver(spark).collect()))
    removed = []

    def stop_after_one(spark, path):
        if removed:
            raise RuntimeError("stopped")
        removed.append(path)
        shutil.rmtree(path.removeprefix("file:"))

    monkeypatch.setattr(lake, "remove_dir", stop_after_one)
    with pytest.raises(RuntimeError):
        compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=2)
    assert sorted(map(tuple, job.silver(spark).collect())) == before
    monkeypatch.undo()
    compact(spark, job.layer("silver"), SILVER, SOURCE_FOLDERS, up_to=2)
    assert len(list((tmp_path / "silver").glob("batch_id=*"))) == 1
    assert sorted(map(tuple, job.silver(spark).collect())) == before


def test_running_continuously(spark, tmp_path):
    landing = tmp_path / "landing"
    write_lines(landing, "one", [event(id="a")])
    job = Ingest(str(tmp_path / "lake"))
    query = job.run_continuously(landed_events(spark, str(landing)), "1 second")
    try:
        query.processAllAvailable()
        write_lines(landing, "two", [event(id="b"), event(id="c", contenu="short")])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r["id"] for r in job.silver(spark).collect()) == ["a", "b"]
    assert sum(c["rejected"] for c in job.counts.values()) == 1


def test_silver_as_json_objects(spark, tmp_path):
    folder = tmp_path / "silver" / "source=BBC_News" / "dt=2026-01-01"
    folder.mkdir(parents=True)
    full = json.loads(event(id="a"))
    full |= {"language": None, "word_count": 1, "char_count": 120, "silver_processed_at": "2026-01-01T00:00:00+00:00"}
    (folder / "a.json").write_text(json.dumps(full, ensure_ascii=False))
    (folder / "b.json").write_text("{broken")
    (folder / "c.txt").write_text(json.dumps({**full, "id": "c"}))
    rejected = tmp_path / "silver" / "x_rejected" / "dt=2026-01-01"
    rejected.mkdir(parents=True)
    (rejected / "d.json").write_text(json.dumps({**full, "id": "d"}))
    (row,) = scan_silver_json(spark, str(tmp_path / "silver")).collect()
    assert (row["id"], row["source"], row["source_key"], str(row["dt"])) == (
        "a", "BBC News", "BBC_News", "2026-01-01")
    (bad,) = silver_json_rejects(spark, str(tmp_path / "silver")).collect()
    assert bad["value"] == "{broken" and bad["file"].endswith("/b.json")
    assert articles_per_day(silver_view(scan_silver_json(spark, str(tmp_path / "silver")))).count() == 1


def test_silver_export_round_trip(spark, tmp_path):
    job = Ingest(str(tmp_path / "lake"))
    job.write(values(spark, [event(id="a"), event(id="b", source="CNN", auteur=None)]), 0)
    silver = job.silver(spark)
    export_json(silver, str(tmp_path / "json"))
    columns = [*RAW_COLUMNS, "language", "word_count", "char_count", "source_key", "dt"]
    back = scan_silver_json(spark, str(tmp_path / "json"))
    assert sorted(map(str, back.select(*columns).collect())) == sorted(
        map(str, silver.select(*columns).collect()))
    (line, *_) = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "json")).collect()
    assert json.loads(line["value"])["auteur"] is None


def test_exact_copies_are_dropped_on_the_way_in(spark, tmp_path):
    landing = tmp_path / "landing"
    write_lines(landing, "one", [event(id="a"), event(id="b"), event(id="b")])
    write_lines(landing, "two", [event(id="a"), event(id="a", titre_article="corrected"), "{bad", "{bad"])
    job = Ingest(str(tmp_path / "lake"))
    events = landed_events(spark, str(landing), max_files_per_trigger=1)
    assert job.drain(without_redeliveries(events)) == {"ok": 3, "rejected": 1}
    assert spark.read.parquet(job.layer("bronze")).count() == 4


def test_bodies_are_shuffled_once_for_bronze_and_silver(spark, tmp_path, monkeypatch):
    from pressflow.streaming import ingest

    job, shuffles = Ingest(str(tmp_path)), {}
    plain = ingest.write_batch

    def seen(df, path, *rest):
        kept = df._jdf.queryExecution().optimizedPlan().toString()
        shuffles[path.rsplit("/", 1)[1]] = kept.split("InMemoryRelation")[0].count("RebalancePartitions")
        plain(df, path, *rest)

    monkeypatch.setattr(ingest, "write_batch", seen)
    hot = [event(id=f"h{i}", contenu=f"{i} " + hashlib.sha512(str(i).encode()).hexdigest() * 4) for i in range(2000)]
    others = [event(id=f"o{i}", source=f"s{i % 5}") for i in range(50)]
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        job.write(values(spark, [*hot, *others, event(id="r", contenu="x"), "{bad", None]), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert shuffles == {"bronze": 0, "silver": 0, "rejects": 1}
    # a folder with most of the rows is still cut into several files, and the others are not
    for layer in ("bronze", "silver"):
        files = {p.name: len(list(p.rglob("*.parquet"))) for p in (tmp_path / layer / "batch_id=0").glob("source_key=*")}
        assert files.pop("source_key=BBC_News") > 3 and min(files.values()) == 1
    assert job.bronze(spark).count() == 2053 and job.silver(spark).count() == 2050
    rejects = {(r["value"], r["id"], r["dq_reason"]) for r in job.rejects(spark).collect()}
    assert rejects == {(event(id="r", contenu="x"), "r", "content_too_short"), ("{bad", None, "corrupt_json"),
                       (None, None, "missing_title")}


def test_silver_is_read_without_shuffling_its_texts(spark, tmp_path):
    job = Ingest(str(tmp_path))
    rows = [event(id="a"), event(id="a", titre_article="same batch"), event(id="b"), event(id=None), event(id=None)]
    job.write(values(spark, rows), 0)
    late = values(spark, [event(id="b", titre_article="2"), event(id="c")]).withColumn("src_offset", F.lit(1).cast("bigint"))
    job.write(late, 1)
    silver = job.silver(spark)
    assert silver.columns == scan_silver(spark, job.layer("silver")).columns
    plan = silver._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "strategy=broadcast" in plan
    assert sorted((r["id"] or "", r["titre_article"]) for r in silver.where("id is null or id != 'a'").collect()) == [
        ("", "t"), ("b", "2"), ("c", "t")]
    assert silver.where("id = 'a'").count() == 1


def test_bodies_are_shuffled_compressed(spark, tmp_path):
    from pressflow.sinks.lake import gathered

    rows = spark.createDataFrame([(None, 1), (b"", 1), (b"\xff{\x00", 2), ("é " .encode() * 5000, 2)], "value binary, k int")
    texts = rows.withColumn("value", F.col("value").cast("string"))
    dealt = gathered(texts, ["k"])
    again = dealt.select(F.col("value").cast("binary").alias("value"), "k").collect()
    assert sorted(map(str, again)) == sorted(map(str, rows.collect())) and dealt.schema["value"] == texts.schema["value"]
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("unpack(") < plan.index("RebalancePartitions") < plan.index("pack(", plan.index("RebalancePartitions"))
    assert rows.select(F.max(F.length(packed(F.col("value"))))).first()[0] < 100
    assert rows.where(unpacked(packed(F.col("value"))).cast("binary").eqNullSafe(F.col("value"))).count() == 4


def test_whole_articles_are_the_same_rows(spark):
    plain, whole = sample.articles_raw(spark, SMALL), sample.articles_raw(spark, SMALL, whole=True)
    assert plain.schema == whole.schema and plain.exceptAll(whole).isEmpty() and whole.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("short_list", [100_000, 0])
def test_merging_lists_the_replaced_deliveries_only(spark, tmp_path, monkeypatch, short_list):
    from pressflow.operators import latest

    monkeypatch.setattr(latest, "SHORT_LIST", short_list)
    job = Ingest(str(tmp_path))
    nobody = event(id=None, titre_article="x")
    rows = [event(id="a"), event(id="a"), event(id="b"), nobody, "{bad", "{bad", event(id="c", source=None, date_publication=None)]
    job.write(values(spark, rows), 0)
    job.write(values(spark, [event(id="a", titre_article="2"), nobody, event(id="d")]), 1)
    late = values(spark, [event(id="b", titre_article="old")]).withColumns(
        {"ingest_ts": F.lit(None).cast("timestamp"), "src_offset": F.lit(None).cast("bigint")})
    job.write(late, 2)
    stored = read_layer(spark, job.layer("bronze"), BRONZE)
    kept = latest.latest_stored_version(stored, str(tmp_path / "lists"))
    assert kept.columns == stored.columns
    expected = sorted(map(str, job.bronze(spark).collect()))
    assert sorted(map(str, kept.collect())) == expected and len(expected) == 6
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and ("strategy=broadcast" in plan) == bool(short_list)
    titles = sorted(map(str, job.bronze(spark, "id", F.upper("titre_article").alias("t")).collect()))
    assert titles == sorted(map(str, job.bronze(spark).select("id", F.upper("titre_article").alias("t")).collect()))
    job.compact_bronze(spark, up_to=2)
    assert spark.read.parquet(job.layer("bronze")).count() == 6
    assert sorted(map(str, job.bronze(spark).collect())) == expected
