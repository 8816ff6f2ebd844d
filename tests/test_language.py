"""Training, scoring and the short-text rule."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressflow.operators.language import (
    BUCKETS,
    FACTORS,
    LanguageModel,
    _buckets,
    language_profile,
    letter_table,
    letters_only,
    prepared,
    trigram_counts,
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_counts_match_a_python_count(spark):
    rows = [("en", "The cat!"), ("en", "a cat"), ("ar", "قط في"), ("en", "ab"), ("en", ""),
            (None, "x y z"), ("fr", None), ("em", "a😀b cat")]
    got = {(r["lang"], r["bucket"]): r["n"] for r in trigram_counts(
        spark.createDataFrame(rows, "lang STRING, text STRING"), "text", "lang").collect()}
    letters = [("en", " the cat "), ("en", " a cat "), ("ar", " قط في "), ("em", " a b cat "),
               ("en", " ab "), ("en", " ")]
    expected = Counter(
        (lang, (ord(t[i]) * FACTORS[0] + ord(t[i + 1]) * FACTORS[1] + ord(t[i + 2])) % BUCKETS)
        for lang, t in letters for i in range(len(t) - 2))
    assert got == expected


def test_profile_is_smoothed_log_probability(spark):
    counts = spark.createDataFrame([("en", 1, 3), ("en", 2, 1), ("fr", 1, 4)], "lang STRING, bucket INT, n LONG")
    got = {(r["lang"], r["bucket"]): r["logp"] for r in language_profile(counts).collect()}
    assert got["en", 1] == pytest.approx(math.log(4 / (4 + BUCKETS)))
    assert got["fr", 1] == pytest.approx(math.log(5 / (4 + BUCKETS)))


def test_held_out_documents_are_recognised(documents):
    part = F.conv(F.substring(F.sha1(F.col("doc_id").cast("string")), 1, 2), 16, 10).cast("int")
    model = LanguageModel.train(documents.where(part < 204))
    held_out = model.add_language(documents.where((part >= 204) & (F.length("text") >= 100)), "text", column="guess")
    right, total = held_out.agg(F.count_if(F.col("guess") == F.col("lang")), F.count("*")).first()
    assert total > 100 and right / total > 0.97


def test_calibrated_model_leaves_random_text_undecided(spark, documents):
    part = F.conv(F.substring(F.sha1(F.col("doc_id").cast("string")), 1, 2), 16, 10).cast("int")
    plain = LanguageModel.train(documents.where(part < 128))
    model = plain.calibrated(documents.where((part >= 128) & (part < 192)))
    unseen = documents.where((part >= 192) & (F.length("text") >= 100))
    rows = model.add_language(unseen, "text", column="guess").select("guess", "lang").collect()
    decided = [r for r in rows if r["guess"] is not None]
    assert len(rows) > 100 and len(decided) / len(rows) > 0.9
    assert sum(r["guess"] == r["lang"] for r in decided) / len(decided) > 0.98
    draw = random.Random(1)
    noise = spark.createDataFrame(
        [("".join(draw.choices("bcdfghjklmnpqrstvwxz ", k=n)),) for n in (60, 200, 1000, 5000) for _ in range(25)],
        "text STRING")
    got = [r["guess"] for r in model.add_language(noise, "text", column="guess").collect()]
    assert sum(g is None for g in got) > 95
    assert all(r["guess"] for r in plain.add_language(noise, "text", column="guess").collect())


def test_calibration_needs_a_text_placed_right(spark, documents):
    with pytest.raises(ValueError):
        LanguageModel.train(documents).calibrated(documents.limit(0))


def test_first_text_long_enough_decides(spark, documents):
    model = LanguageModel.train(documents)
    english = documents.where("lang = 'en'").orderBy("doc_id").first()["text"][:300]
    german = documents.where("lang = 'de'").orderBy("doc_id").first()["text"][:300]
    rows = [(english, german), ("short", german), ("1234567890 1234567890", german),
            ("", "too short"), ("12345678901234567890", "12345678901234567890"), ("", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, a STRING, b STRING")
    got = [r["language"] for r in model.add_language(df, "a", "b").orderBy("i").collect()]
    assert got == ["en", "de", "de", None, None, None]


def test_too_many_labels_are_refused(spark):
    counts = spark.range(300).select(F.col("id").cast("string").alias("lang"), F.lit(1).alias("bucket"), F.lit(1).alias("n"))
    with pytest.raises(ValueError):
        LanguageModel.from_counts(counts)


def test_nothing_to_learn_from_is_refused(spark):
    with pytest.raises(ValueError):
        LanguageModel.train(spark.createDataFrame([], "text STRING, lang STRING"))


def test_letters_found_in_the_task_are_those_of_spark(spark):
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(map(chr, points[at:at + 500])) for at in range(0, len(points), 500)]
    texts += ["", " ", "a", "ΟΔΟΣ ΣΑΣ, Σ", "İstanbul I ı", "é E\u0301!x", "  two  (words) ", "1ª №7 ǅ Ⅷ", None]
    draw = random.Random(2)
    texts += ["".join(draw.choices("aÄß .,Σİ\u0301قX", k=n)) for n in range(60)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    broken = spark.sql("SELECT -1 AS i, cast(unhex('61FF2062C3') AS STRING) AS t")
    found = rows.union(broken).select("t", letters_only(F.col("t")).alias("letters"), prepared(F.col("t")).alias("p"))
    table = letter_table(spark).value
    for r in found.select("letters", "p").collect():
        if r["letters"] is None:
            assert r["p"] is None
            continue
        c = np.array([ord(x) for x in r["letters"]], np.uint32)
        expected = (c[:-2] * FACTORS[0] + c[1:-1] * FACTORS[1] + c[2:]) & (BUCKETS - 1)
        assert _buckets(r["p"], table).tolist() == expected.tolist(), r["p"][:50]


def test_texts_are_not_searched_for_letters_by_a_pattern(documents):
    """Only texts with characters of unusual case are."""
    model = LanguageModel.train(documents)
    plan = model.add_language(documents, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan.replace("THEN regexp_replace", "")
