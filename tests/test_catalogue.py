"""Every query against its DuckDB statement, on the smallest sample."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from pressflow.plans.oracle import ORACLE
from pressflow.plans.queries import catalogue
from tests_paths import SMALL

QUERIES = catalogue()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_flagship(spark):
    assert contract.entry(spark).columns == ["keyword", "day", "n_occurrences"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert differences(got, con.execute(ORACLE[name]).fetchdf()) is None


def test_language_guesses_are_right(spark):
    from pressflow.functions.keys import article_id
    from pyspark.sql import functions as F

    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    url = F.concat(F.lit("http://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"))
    guesses = QUERIES["lang_detect"](spark, SMALL)
    joined = documents.select(article_id(url).alias("id"), "lang").join(guesses, "id")
    right, total = joined.agg(F.count_if(F.col("lang") == F.col("language")), F.count("*")).first()
    assert total > 90 and right / total > 0.97
