"""From raw documents to packed training sequences: five stages, each one operator.

All stages but the last return the columns of documents. Every stage takes null ids and texts,
repeated rows, further columns of any name and empty tables; what they come to is said in the
operators. A text that repeats take away whole stays as an empty document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.llm import packing, quality_outliers, repeats, rule_ensemble, simhash
from pressflow.llm.catalogue import quality_model, tokenizer_json
from pressflow.llm.support import stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more; it learns from the labels."""
    statistics = rule_ensemble.statistics("text")
    learned = stored(docs.select("doc_id", statistics.alias("stats")), "statistics")
    return docs.where(quality_model(learned, spark, sf_dir).score(statistics) >= 0.5)


def keep_usual(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_outliers.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings of 200 that start at more than one place."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    cut = repeats.without_repeats(rows, as_text=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces packed into sequences."""
    return packing.pack_documents(docs, tokenizer_json("word_bpe_49k.json"))


STAGES = [("quality classifier", classify), ("quality rules", keep_usual),
          ("simhash near-dedup", drop_near_copies), ("suffix-array dedup", cut_repeats),
          ("packing", pack)]

#: Classifier, outlier estimates, links and tokens are beyond SQL; tests compare the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
