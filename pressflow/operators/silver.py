"""Bronze layout columns and the silver projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.functions.dates import partition_date
from pressflow.functions.keys import partition_key
from pressflow.functions.text import char_count, clean_columns, word_count
from pressflow.operators.language import LanguageModel


def with_partitions(events: DataFrame, today: Column | None = None) -> DataFrame:
    """Add ``source_key`` and ``dt``, the folders an event is filed under."""
    return events.withColumns({
        "source_key": partition_key(F.col("source")),
        "dt": partition_date(F.col("date_publication"), F.col("scraped_at"), today),
    })


def to_silver(
    events: DataFrame, model: LanguageModel | None = None, processed_at: Column | None = None
) -> DataFrame:
    """Clean title and content, add language and counts (O40). Every input column is kept.

    Row-local: nothing is shuffled. Without a model the language is null.
    """
    clean = clean_columns(events, "titre_article", "contenu")
    if model is None:
        tagged = clean.withColumn("language", F.lit(None).cast("string"))
    else:
        tagged = model.add_language(clean, "contenu", "titre_article")
    return tagged.withColumns({
        "word_count": word_count(F.col("contenu")),
        "char_count": char_count(F.col("contenu")),
        "silver_processed_at": F.current_timestamp() if processed_at is None else processed_at,
    })
