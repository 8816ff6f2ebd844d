"""Quality rules and the quality classifier."""

import math
import re

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_brute import edge_table, edge_texts, prose, quality_counts
from pressflow.llm import quality_outliers, rule_ensemble
from pyspark.sql import functions as F
from tests_paths import SMALL

MEDIUM = "/root/testdata/sf0.01"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_of_documents(spark):
    got = contract.queries()["op4_quality_rules"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in got} == {
        i: quality_counts(t) for i, t in texts.items()}
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_outliers_are_junk(spark):
    got = contract.queries()["op4_quality_rules"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = got.join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.2


def test_quality_rules_use_no_python(spark):
    df = quality_outliers.kept_documents(spark.read.parquet(f"{SMALL}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_rules_on_edge_cases(spark):
    rows = edge_texts() + [(20, prose(20, 40) + " " + " ".join(prose(21, 9) for _ in range(9)))]
    df = edge_table(spark, rows)
    got = quality_outliers.quality_verdicts(df)
    assert sorted(tuple(r[c] for c in COUNTS) for r in got.collect()) == sorted(quality_counts(t) for _, t in rows)
    kept = quality_outliers.kept_documents(df)
    assert kept.columns == df.columns
    assert kept.count() == got.where("kept").count() > 0
    assert quality_outliers.quality_verdicts(df.limit(0)).count() == 0
    assert quality_outliers.kept_documents(df.limit(0)).count() == 0


def test_estimate_withstands_a_fifth_of_outliers(spark):
    clean = [(k, " ".join(f"{w}." if i % 9 == 8 else w for i, w in enumerate(prose(k, 120).split())))
             for k in range(200)]
    junk = [(1000 + k, prose(k, 120).replace(" ", "*** ")) for k in range(50)]
    got = quality_outliers.quality_verdicts(edge_table(spark, clean + junk)).collect()
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in got)


def test_repeated_lines_and_words_can_reject_alone(spark):
    def lines(k, menu):
        words = prose(k, 120).split()
        return "\n".join(" ".join([*words[i:i + 6]]) + ("\nHome About Contact" if menu else "") for i in range(0, 120, 6))

    def windows(k):  # a quarter of the words is in windows that occur twice
        return prose(k, 600) + " " + " ".join(prose(k, 600).split()[:100])

    rows = [(k, lines(k, False)) for k in range(200)] + [(1000 + k, lines(k, True)) for k in range(5)]
    rows += [(2000 + k, windows(k).replace(" ", "\n", 1)) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'aa' AS lang", "'s' AS source")
    got = {r["doc_id"]: r for r in quality_outliers.quality_verdicts(df).collect()}
    assert all(got[k]["kept"] for k in range(200)) and not any(r["base_failed"] for r in got.values())
    assert not any(got[1000 + k]["kept"] or got[2000 + k]["kept"] for k in range(5))


def moments(x):
    """Centre and plain covariance, and the covariance with its factor of consistency and floors."""
    centre = x.mean(axis=0)
    plain = (x - centre).T @ (x - centre) / len(x)
    floors = np.diag([floor ** 2 for _, _, floor in quality_outliers.PARTS])
    return centre, plain, plain * quality_outliers.CONSISTENCY + floors


def rank(values, share):
    return np.sort(values, axis=0)[max(math.ceil(share * len(values)) - 1, 0)]


def plain_estimate(x):
    """Minimum covariance determinant of the rows, in NumPy."""
    floors = np.array([floor for _, _, floor in quality_outliers.PARTS])
    spread = np.maximum((rank(x, 0.75) - rank(x, 0.25)) / 1.349, floors)
    centre, _, full = moments(x)
    starts = [(((x - rank(x, 0.5)) / spread) ** 2).sum(axis=1),
              np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(full), x - centre)]
    ends = []
    for d2 in starts:
        for _ in range(quality_outliers.STEPS):
            centre, plain, full = moments(x[d2 <= rank(d2, quality_outliers.COVERAGE)])
            d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(full), x - centre)
        ends.append((np.linalg.slogdet(full)[1], centre, plain))
    return min(ends, key=lambda e: e[0])[1:]


def test_verdicts_equal_a_plain_estimate(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    parts = docs.select("doc_id", "lang", "source", quality_outliers.statistics("text").alias("s")) \
        .select("doc_id", "lang", "source", "s.failed", *quality_outliers.vector("s")).toPandas()
    names = [name for name, _, _ in quality_outliers.PARTS]
    passed = parts[~parts.failed]

    def drawn(n, own, parent):
        w = n / (n + quality_outliers.PRIOR_ROWS)
        return [w * a + (1 - w) * b for a, b in zip(own, parent)]

    whole, expected = plain_estimate(passed[names].to_numpy()), {}
    for _, of_language in passed.groupby("lang"):
        language = drawn(len(of_language), plain_estimate(of_language[names].to_numpy()), whole)
        for _, group in of_language.groupby("source"):
            x = group[names].to_numpy()
            centre, plain = drawn(len(x), plain_estimate(x), language)
            full = plain * quality_outliers.CONSISTENCY + np.diag([f ** 2 for _, _, f in quality_outliers.PARTS])
            d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(full), x - centre)
            expected |= dict(zip(group.doc_id, d2))
    got = {r["doc_id"]: r for r in quality_outliers.quality_verdicts(docs).collect()}
    assert {i for i, r in got.items() if not r["base_failed"]} == set(expected)
    for i, d2 in expected.items():
        assert got[i]["distance2"] == pytest.approx(d2, rel=1e-6)
        assert got[i]["kept"] == (d2 <= quality_outliers.CUT)


def test_rows_of_a_group_are_spread(spark):
    rows = spark.range(0, 6400, 1, 4).select(F.lit(quality_outliers._ALL).cast("long").alias("group_id"))
    sizes = [r["count"] for r in quality_outliers._salted(rows).groupBy("salt").count().collect()]
    assert len(sizes) == 256 and max(sizes) <= 28
    groups = spark.createDataFrame([(0,), (6,), (5,)], "group_id long")
    copies = {r["group_id"]: r["count"] for r in quality_outliers._copied(groups).groupBy("group_id").count().collect()}
    assert copies == {0: 256, 6: 64, 5: 32}


def test_only_few_groups_are_broadcast_and_never_rows(spark, tmp_path, monkeypatch):
    # files so small that Spark alone would broadcast the rows, or the copies by the size of one each
    spark.range(3000).select((F.col("id") % 2 + 4).alias("group_id"), F.lit(1).alias("salt")).write.parquet(f"{tmp_path}/rows")
    spark.range(4, 6).select(F.col("id").alias("group_id"), F.lit("x" * 500).alias("e")).write.parquet(f"{tmp_path}/groups")
    rows, groups = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("rows", "groups"))
    for few in (True, False):
        met = quality_outliers._met(rows, groups, few)
        assert met.count() == 3000
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" not in plan and ("BroadcastHashJoin" in plan) == few
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    told = {r["doc_id"]: r for r in quality_outliers.quality_verdicts(df).collect()}
    monkeypatch.setattr(quality_outliers, "SENT_GROUPS", 0)
    for r in quality_outliers.quality_verdicts(df).collect():
        assert r["kept"] == told[r["doc_id"]]["kept"]
        assert (r["distance2"] or 0.0) == pytest.approx(told[r["doc_id"]]["distance2"] or 0.0, rel=1e-6)


def test_small_groups_follow_their_own_language(spark):
    def rows(first, n, cut, lang):
        return [(first + k, " ".join(cut(w) for w in prose(k, 120).split()), lang, f"s{k % 8}") for k in range(n)]

    texts = rows(0, 1000, lambda w: w[:2], "aa") + rows(1000, 1000, lambda w: w * 3, "bb")
    odd = rows(2000, 3, lambda w: w * 3, "aa")  # usual in the other language
    df = spark.createDataFrame(texts + odd, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality_outliers.quality_verdicts(df).collect()}
    assert sum(got[k] for k in range(2000)) > 1950  # words of two letters make some repeated windows
    assert not any(got[2000 + k] for k in range(3))


def test_classifier_on_held_out_documents(spark):
    got = contract.queries()["op7_quality_classifier"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    held_out = [r for r in rows if r["held_out"]]
    assert len(held_out) > 90
    assert sum(r["predicted"] == r["quality"] for r in held_out) / len(held_out) > 0.95
    assert got.count() == 1000 and all(0 <= r["score"] <= 1 for r in got.collect())
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def fit(spark, rows):
    df = spark.createDataFrame(rows, "key long, text string, label int")
    return rule_ensemble.RuleModel.fit(df.withColumn("stats", rule_ensemble.statistics("text")))


def test_classifier_without_labels_or_with_one_kind(spark):
    for rows, score in (([], 0.5), ([(1, "a", None)], 0.5), ([(1, "a b", 1), (2, "c", 1)], 1.0), ([(1, "a", 0)], 0.0)):
        model = fit(spark, rows)
        got = edge_table(spark).select(model.score(rule_ensemble.statistics("text")).alias("p")).collect()
        assert all(abs(r["p"] - score) < 1e-6 for r in got)


def test_classifier_scores_edge_cases(spark):
    rows = [(k, prose(k, 30 + k), 1) for k in range(60)] + [(100 + k, prose(k, 30).upper() + "!!", 0) for k in range(60)]
    model = fit(spark, rows)
    assert model.rules and len(model.rules) < 120
    df = edge_table(spark)
    scored = df.withColumn("p", model.score(rule_ensemble.statistics("text")))
    assert scored.where("p IS NULL OR p < 0 OR p > 1").count() == 0
    plan = df.where(model.score(rule_ensemble.statistics("text")) >= 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 1  # the statistics are made once for a row


def test_paths_become_rules():
    printed = "\n".join([
        " If (feature 3 <= 0.5)", "  If (feature 0 <= 2.0)", "   Predict: 1.0", "  Else (feature 0 > 2.0)",
        "   Predict: 0.0", " Else (feature 3 > 0.5)", "  Predict: 0.0"])
    assert rule_ensemble._paths(printed) == [
        ((3, True, 0.5),), ((3, True, 0.5), (0, True, 2.0)), ((3, True, 0.5), (0, False, 2.0)), ((3, False, 0.5),)]
    assert rule_ensemble._simplified(((1, True, 3.0), (1, True, 2.0), (0, False, 1.0))) == ((0, False, 1.0), (1, True, 2.0))


def test_labels_are_learned_outside_the_fold_only(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "b")], "doc_id long, text string")
    stats = rows.withColumn("stats", rule_ensemble.statistics("text"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (2, None)], "doc_id long, quality int")
    got = rule_ensemble.labelled_statistics(stats, labels, F.col("doc_id") != 1).collect()
    assert [(r["key"], r["label"]) for r in got] == [(2, 0), (2, 0)]


@pytest.mark.parametrize("text, n", [("a b c d e f g h " * 2, 16), ("a b c d e f g h", 0), ("x " * 9, 9), ("", 0)])
def test_repeated_words(spark, text, n):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(quality_outliers.statistics("text")["n_repeat_words"]).first()[0] == n
