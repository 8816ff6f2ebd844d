"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressflow.llm import (
    bpe_automaton,
    chat,
    impact_search,
    packing,
    pitman_yor,
    quality_outliers,
    repeats,
    rule_ensemble,
    search,
    simhash,
    token_alignment,
    token_counts,
    url_models,
)
from pressflow.llm.support import remainder, stored, table, text_of

TOKEN_LIMIT = 512


def tokenizer_json(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


#: Conversations with this remainder of the id's crc32 are held out of learning.
CHAT_FOLDS, CHAT_HELD_OUT = 3, 1


def op1_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = chat.transcripts(table(spark, sf_dir, "conversations"))
    model = chat.train(raw.where(remainder("conv_id", CHAT_FOLDS) != CHAT_HELD_OUT))
    return chat.format_transcripts(raw.drop("role"), model)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", text_of("text").alias("text"))
    sized = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = token_counts.token_counts(sized, tokenizer_json("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens",
                          (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


#: Rows with this remainder of the id's crc32 are held out of the language model.
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 5, 1


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    return pitman_yor.score_texts(docs, held_out)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_outliers.quality_verdicts(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = repeats.without_repeats(docs)
    kept = F.octet_length("kept").cast("long")
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - kept).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


#: Rows with this remainder of the id's crc32 are held out of learning.
QUALITY_FOLDS, QUALITY_HELD_OUT = 3, 1


def quality_model(stats: DataFrame, spark: SparkSession, sf_dir: str) -> rule_ensemble.RuleModel:
    """The classifier learned from the labels of ``stats`` (``doc_id``, ``stats``) outside the held-out fold."""
    learnable = remainder("doc_id", QUALITY_FOLDS) != QUALITY_HELD_OUT
    labels = table(spark, sf_dir, "labels")
    return rule_ensemble.RuleModel.fit(
        rule_ensemble.labelled_statistics(stats, labels, learnable))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = stored(docs.select("doc_id", rule_ensemble.statistics("text").alias("stats")), "statistics")
    score = quality_model(stats, spark, sf_dir).score(F.col("stats"))
    held_out = remainder("doc_id", QUALITY_FOLDS) == QUALITY_HELD_OUT
    return stats.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.where(F.col("doc_id") % 100 == 0).select(
        F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"))
    return search.search(docs, queries)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe_automaton.encode_texts(docs, tokenizer_json("word_bpe_49k.json"), digests=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, tokenizer_json("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        pieces = file.read()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align_texts(docs, tokenizer_json("byte_bpe_50k.json"), pieces)


URL_RULES = [
    url_models.Rule("allow", "com", "/"),
    url_models.Rule("block", "example.com", "/en/"),
    url_models.Rule("allow", "www.example.com", "/en/"),
    url_models.Rule("block", "net", "/es/"),
    url_models.Rule("block", "net", "/fr/"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_models.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return impact_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_chat_turns, op2_token_counts, op3_lm_scores, op4_quality_rules, op5_simhash, op6_suffix_dedup,
        op7_quality_classifier, op8_search, op9_bpe_round_trip, op10_packing, op11_token_alignment,
        op12_url_filter, op13_ranked_search)}

#: What terms are made of, for regular expressions; A-Z are lower-cased beforehand.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS_OF = ("unnest(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             f"'abcdefghijklmnopqrstuvwxyz'), '{_TERM}'))")

#: Statements for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op13_ranked_search": f"""
        WITH tokens AS (SELECT doc_id, {_TERMS_OF.format("text")} AS term FROM documents),
        postings AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
        lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
        asked AS (SELECT DISTINCT item_id, term FROM
                  (SELECT item_id, {_TERMS_OF.format("text")} AS term FROM benchmark)),
        weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
                    FROM postings, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term),
        scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf)
                       // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
                   FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), corpus
                   GROUP BY item_id, doc_id)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scores WHERE score > 0) WHERE rank <= 10""",
}
