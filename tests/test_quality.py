"""O13, O18, O20-O24, O28, O29, O63."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pressflow.functions import keys
from pressflow.operators import quality
from pressflow.operators.latest import first_per_key, first_per_stored_key, latest_version

LONG = "x" * 100
DATE = "2026-01-01T00:00:00+00:00"
SCHEMA = "titre_article STRING, date_publication STRING, contenu STRING"

CASES = [
    (("t", DATE, LONG), None),
    ((None, DATE, LONG), "missing_title"),
    (("", DATE, LONG), "missing_title"),
    ((" \t", DATE, LONG), "missing_title"),
    ((" ", DATE, LONG), "missing_title"),
    (("　", DATE, LONG), "missing_title"),
    (("t", None, LONG), "missing_date"),
    (("t", "", LONG), "missing_date"),
    (("t", "hello", LONG), "invalid_date"),
    (("t", " ", LONG), "invalid_date"),
    (("t", "2026-02-30", LONG), "invalid_date"),
    (("t", DATE, "x" * 99), "content_too_short"),
    (("t", DATE, f"  {'x' * 99} "), "content_too_short"),
    (("t", DATE, None), "content_too_short"),
    # markup counts, since the gate looks at the text before cleaning
    (("t", DATE, "<b></b>" * 20), None),
    # the first gate that fails names the reject
    ((None, None, None), "missing_title"),
    (("t", None, None), "missing_date"),
]


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [(i, *row) for i, (row, _) in enumerate(CASES)]
    return quality.tag_quality(spark.createDataFrame(rows, f"i INT, {SCHEMA}"))


def test_every_gate(tagged):
    got = [r["dq_reason"] for r in tagged.orderBy("i").collect()]
    assert got == [reason for _, reason in CASES]


def test_routes_are_disjoint_and_complete(tagged):
    n_passed, n_rejected = quality.passed(tagged).count(), quality.rejected(tagged).count()
    assert n_passed + n_rejected == len(CASES) and n_passed == 2


def test_threshold_is_a_parameter(spark):
    df = spark.createDataFrame([("t", DATE, "short")], SCHEMA)
    assert quality.passed(quality.tag_quality(df, 5)).count() == 1
    assert quality.passed(quality.tag_quality(df, 6)).count() == 0


def test_summary(tagged):
    got = {r["outcome"]: r["n_events"] for r in quality.quality_summary(tagged).collect()}
    expected = {}
    for _, reason in CASES:
        expected[reason or "ok"] = expected.get(reason or "ok", 0) + 1
    assert got == expected


def test_results_count_what_reached_each_gate(tagged):
    rows = quality.quality_results(tagged, F.lit(datetime(2026, 1, 1))).collect()
    assert [r["check_name"] for r in rows] == [
        "missing_title", "missing_date", "invalid_date", "content_too_short"]
    assert [r["dimension"] for r in rows] == ["completeness", "completeness", "validity", "validity"]
    reached = len(CASES)
    for row in rows:
        details = json.loads(row["details"])
        assert details["n_checked"] == reached
        assert row["passed"] == (details["n_failed"] == 0)
        reached -= details["n_failed"]
    assert reached == 2


def test_partition_key(one):
    values = ["BBC News", "", "***", None, "a--b_c", "Le Monde (fr)", "العربية", "_x_"]
    assert one(values, keys.partition_key) == [
        "BBC_News", "unknown", "unknown", "unknown", "a--b_c", "Le_Monde_fr", "unknown", "x"]


def test_article_id(one):
    urls = ["http://a.example/1", "http://a.example/é"]
    assert one(urls, keys.article_id) == [hashlib.sha1(u.encode()).hexdigest() for u in urls]


def test_last_write_wins(spark):
    rows = [
        ("s", "2026-01-01", "a", 1, 5, "old"), ("s", "2026-01-01", "a", 2, 1, "new"),
        ("s", "2026-01-02", "a", 1, 1, "other day"), ("s", "2026-01-01", "b", 1, 1, "low"),
        ("s", "2026-01-01", "b", 1, 2, "high"), ("s", "2026-01-01", None, 1, 1, "no id"),
    ]
    layer = spark.createDataFrame(
        rows, "source_key STRING, dt STRING, id STRING, ts INT, src_offset LONG, body STRING"
    ).withColumn("ingest_ts", F.timestamp_seconds("ts"))
    assert sorted(r["body"] for r in latest_version(layer).collect()) == [
        "high", "new", "no id", "other day"]


@pytest.mark.parametrize("repeated, threshold", [(0, "-1"), (3, "-1"), (0, "10485760"), (3, "10485760")])
def test_stored_rows_are_picked_alike_on_every_path(spark, tmp_path, repeated, threshold):
    rows = [(f"k{i}", 1, "only") for i in range(20)] + [(None, 1, "no key")]
    for i in range(repeated):
        key = None if i == 0 else f"k{i}"
        # newer, older and an exact copy of the newest
        rows += [(key, 3, "new"), (key, 2, "old"), (key, 3, "new")]
    df = spark.createDataFrame(rows, "k STRING, ts INT, v STRING")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        picked = first_per_stored_key(df, ["k"], [F.desc("ts")], str(tmp_path))
        expected = first_per_key(df, ["k"], [F.desc("ts")])
        assert sorted(map(str, picked.collect())) == sorted(map(str, expected.collect()))
        plan = picked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # while the list can be broadcast, rows whose key does not repeat are in no shuffle
    assert ("BroadcastHashJoin" in plan) == (threshold != "-1")


def test_one_hot_key_is_pruned_before_the_shuffle(spark):
    key = F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string"))
    kept = first_per_key(spark.range(1000).select(key.alias("k"), "id"), ["k"], [F.asc("id")])
    assert sorted(r["id"] for r in kept.collect()) == [0, *range(900, 1000)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange", 1)
    assert "Final" in before and "row_number(), 1, Partial" in after


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "k STRING, v INT")
    bad = {(r["k"], r["n_rows"]) for r in quality.key_violations(df, ["k"]).collect()}
    assert bad == {("a", 2), (None, 1)}
    quality.assert_keys(df.where("k = 'b'"), ["k"], "t")
    with pytest.raises(ValueError):
        quality.assert_keys(df, ["k"], "t")
