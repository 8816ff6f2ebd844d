"""The stages of the pipeline, each on what the one before it kept."""

import corpus_pipeline as pipeline
import pytest
from llm_brute import covered, edge_table, packed_problem, tokenizer
from pressflow.llm.support import stored
from tests_paths import SMALL

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    """The input of each stage and the last one's output."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = [docs]
    for name, stage in pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], MEDIUM), name.replace(" ", "-")))
    return found


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_all_but_the_last_return_documents(tables):
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_filters_keep_good_documents(spark, tables):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    for before, after in zip(tables[:2], tables[1:3], strict=True):
        good, bad = (before.join(labels.where(f"quality = {q}"), "doc_id").count() for q in (1, 0))
        good_left, bad_left = (after.join(labels.where(f"quality = {q}"), "doc_id").count() for q in (1, 0))
        assert good_left > 0.95 * good and (bad_left < 0.1 * bad or bad == 0)


def test_one_of_each_group_stays(spark, tables):
    from pressflow.llm import simhash

    groups = simhash.near_duplicates(tables[2]).collect()
    assert ids(tables[3]) == {r["component_id"] for r in groups}


def test_repeats_are_cut(spark, tables):
    rows = [(r["doc_id"], r["text"]) for r in tables[3].collect()]
    data, marks = covered([t for _, t in rows])
    expected = {i: bytes(x for x, m in zip(d, ms, strict=True) if not m).decode("utf-8", "ignore")
                for (i, _), d, ms in zip(rows, data, marks, strict=True)}
    got = tables[4].collect()
    assert {r["doc_id"]: r["text"] for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_all_is_packed(tables):
    plain = tokenizer("word_bpe_49k.json")
    expected = {r["doc_id"]: plain.encode(r["text"], add_special_tokens=False).ids + [1] for r in tables[4].collect()}
    got = tables[5].toPandas()
    assert set(got["doc_id"]) == set(expected)
    assert packed_problem(got, expected) is None


def test_stages_take_edge_cases(spark):
    docs = edge_table(spark)
    for _, stage in pipeline.STAGES[:-1]:
        got = stored(stage(spark, docs, SMALL), "stage")
        assert got.columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert pipeline.pack(spark, docs, SMALL).count() >= docs.count()


def test_run_is_the_stages(spark, tables):
    got = pipeline.run(spark, MEDIUM).select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, tables[-1].select(got.columns).collect()))
