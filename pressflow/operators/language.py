"""Language identification, trained and applied on Spark.

A naive Bayes model over character trigrams. Trigrams are counted in a fixed number of hash
buckets, so the model has BUCKETS entries per language however much text it was trained on:
that bound is what allows it to be collected, broadcast and used row by row without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressflow.fixed_values import MIN_LANGUAGE_CHARS

BUCKETS = 2**14
MAX_LANGUAGES = 256
#: Length classes of texts, by the bits of their number of trigrams.
CLASSES = 32
#: Share of rightly placed texts that calibration lets become undecided, by each of its two measures.
LOSE = 0.005
#: Texts whose trigrams are counted together.
TEXTS_AT_ONCE = 200
# bucket = (first * FACTORS[0] + second * FACTORS[1] + third) mod BUCKETS, on code points
FACTORS = (10007, 101)


def letters_only(c: Column) -> Column:
    """Lower-cased letters; everything between them becomes one space, as do both ends."""
    padded = F.concat(F.lit(" "), F.lower(c), F.lit(" "))
    return F.regexp_replace(padded, r"[^\p{L}\p{M}]+", " ")


#: Characters whose lower case is longer, or depends on the characters around them.
UNUSUAL_CASE = "\u0130\u03a3"

_letters: dict[str, Broadcast] = {}


def letter_table(spark: SparkSession) -> Broadcast:
    """What ``letters_only`` makes of each code point alone: a lower-case letter, or a space.

    Read from Spark, so it is the same whatever characters this Spark knows; made once a session.
    Unicode has its letters and marks in the first four planes and at the start of the 15th.
    """
    app = spark.sparkContext.applicationId
    if app not in _letters:
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        alone = (
            spark.range(1, 0x41000)
            .select(F.when(F.col("id") < 0x40000, F.col("id")).otherwise(F.col("id") + 0xA0000).alias("id"))
            .where(f"id NOT BETWEEN {0xD800} AND {0xDFFF}")
            .select("id", letters_only(char).alias("padded")).where(F.length("padded") == 3)
            .select("id", F.ascii(F.substring("padded", 2, 1)).alias("letter")).toPandas()
        )
        table = np.full(0x110000, ord(" "), dtype=np.uint32)
        table[alone["id"].to_numpy()] = alone["letter"].to_numpy()
        _letters.clear()
        _letters[app] = spark.sparkContext.broadcast(table)
    return _letters[app]


def prepared(c: Column) -> Column:
    """A text as ``_buckets`` takes it: with the table that finds its letters in the task. Texts with
    characters of unusual case go through ``letters_only`` here, which changes nothing later."""
    valid = F.make_valid_utf8(c)
    unusual = F.contains(valid, F.lit(UNUSUAL_CASE[0])) | F.contains(valid, F.lit(UNUSUAL_CASE[1]))
    return F.when(unusual, letters_only(valid)).otherwise(valid)


def _buckets(text: str, table: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams of what ``letters_only`` makes of a text."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    padded = np.full(len(c) + 2, ord(" "), dtype=np.uint32)
    padded[1:-1] = table.take(c)
    letter = padded != ord(" ")
    letter[1:] |= letter[:-1].copy()  # of a run of spaces the first one stays
    letter[0] = True
    c = padded[letter]
    # BUCKETS is a power of two, so overflow at 32 bits does not change the remainder
    return (c[:-2] * FACTORS[0] + c[1:-1] * FACTORS[1] + c[2:]) & (BUCKETS - 1)


def _measure(text: str, weights: np.ndarray, table: np.ndarray) -> tuple[int, int, float, float]:
    """Most likely row of ``weights``, length class, and its lead and log-probability a trigram."""
    found = _buckets(text, table)
    if len(found) < BUCKETS:  # look up what occurs, else count it first
        sums = weights.take(found, axis=1).sum(axis=1)
    else:
        sums = weights @ np.bincount(found, minlength=BUCKETS)
    best, n = int(sums.argmax()), max(len(found), 1)
    others = np.delete(sums, best)
    lead = float(sums[best] - others.max()) if len(others) else float("inf")
    return best, min(len(found).bit_length(), CLASSES - 1), lead / n, float(sums[best]) / n


def trigram_counts(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """Trigrams per language and bucket.

    Each task adds its texts up in one array of BUCKETS numbers per language, and only those
    arrays are shuffled. Exploding the text instead would make a row per character.
    """
    shared = letter_table(labelled.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for lang, table in tables.items():
                seen = np.flatnonzero(table)
                yield pd.DataFrame({"lang": lang, "bucket": seen.astype("int32"), "n": table[seen]})

        for batch in batches:
            for lang, texts in batch.groupby("lang", sort=False)["text"]:
                if lang not in tables:
                    # stay small even if the labels are many
                    if len(tables) == MAX_LANGUAGES:
                        yield from rows()
                        tables.clear()
                    tables[lang] = np.zeros(BUCKETS, dtype=np.int64)
                for at in range(0, len(texts), TEXTS_AT_ONCE):
                    found = [_buckets(text, shared.value) for text in texts.iloc[at:at + TEXTS_AT_ONCE]]
                    tables[lang] += np.bincount(np.concatenate(found), minlength=BUCKETS)
        yield from rows()

    return (
        labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
        .select(F.col(lang).alias("lang"), prepared(F.col(text)).alias("text"))
        .mapInPandas(count, "lang STRING, bucket INT, n BIGINT")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )


def language_profile(counts: DataFrame) -> DataFrame:
    """Add-one smoothed log-probability of each seen (language, bucket)."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    # one row per language
    return (
        counts.join(totals, "lang")
        .select("lang", "bucket", "n",
                F.log((F.col("n") + 1) / (F.col("n_lang") + BUCKETS)).alias("logp"))
    )


class LanguageModel:
    """Trained counts, ready to score columns of text."""

    def __init__(self, spark: SparkSession, languages: list[str], counts: np.ndarray):
        weights = np.log((counts + 1.0) / (counts.sum(axis=0) + BUCKETS))
        self._share(spark, languages, weights, None)

    def _share(self, spark: SparkSession, languages: list[str], weights: np.ndarray,
               least: np.ndarray | None) -> None:
        # a row for each language, whose numbers lie together
        by_language = np.ascontiguousarray(weights.T)
        self._shared = spark.sparkContext.broadcast((languages, by_language, least))
        self._table = letter_table(spark)

    @classmethod
    def train(cls, labelled: DataFrame, text: str = "text", lang: str = "lang") -> "LanguageModel":
        return cls.from_counts(trigram_counts(labelled, text, lang))

    @classmethod
    def from_counts(cls, counts: DataFrame) -> "LanguageModel":
        """Load a counts table (lang, bucket, n), refusing one beyond the model's bound."""
        limit = BUCKETS * MAX_LANGUAGES
        rows = counts.limit(limit + 1).toPandas()
        languages = sorted(rows["lang"].unique())
        if len(rows) > limit or len(languages) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} language labels")
        if not languages:
            raise ValueError("no labelled text to learn languages from")
        table = np.zeros((BUCKETS, len(languages)))
        columns = rows["lang"].map({name: i for i, name in enumerate(languages)})
        table[rows["bucket"].to_numpy(), columns.to_numpy()] = rows["n"].to_numpy()
        return cls(counts.sparkSession, languages, table)

    def calibrated(self, held_out: DataFrame, text: str = "text", lang: str = "lang",
                   lose: float = LOSE) -> "LanguageModel":
        """This model with a third answer, null, for texts that it cannot place.

        Of labelled texts that the model was not trained on, those it places right are sorted by
        length class (powers of two). A text is undecided if its lead over the second language, or its
        log-probability, each a trigram, is below what all but the share ``lose`` of the right texts
        of its class have. A class without such texts takes the values of the nearest one, the
        shorter of two. Only two numbers a class come to the driver.
        """
        shared, table = self._shared, self._table

        @F.pandas_udf("guess STRING, class INT, lead DOUBLE, level DOUBLE")
        def measured(texts: pd.Series) -> pd.DataFrame:
            languages, weights, _ = shared.value
            rows = [_measure(text, weights, table.value) for text in texts]
            found = pd.DataFrame(rows, columns=["guess", "class", "lead", "level"])
            found["guess"] = [languages[g] for g in found["guess"]]
            return found

        chosen = held_out.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
        rows = (
            chosen.select(F.col(lang).alias("lang"), measured(prepared(F.col(text))).alias("m"))
            .where("m.guess = lang").groupBy("m.class")
            .agg(F.percentile_approx("m.lead", lose, 10_000).alias("lead"),
                 F.percentile_approx("m.level", lose, 10_000).alias("level")).collect()
        )
        if not rows:
            raise ValueError("no held-out text that the model places right")
        known = {r["class"]: (r["lead"], r["level"]) for r in rows}
        least = np.array([known[min(known, key=lambda k: (abs(k - c), k))] for c in range(CLASSES)])
        languages, weights, _ = shared.value
        model = object.__new__(LanguageModel)
        model._share(held_out.sparkSession, languages, weights.T, least)
        return model

    def _score(self, prepared_text: Column) -> Column:
        shared, table = self._shared, self._table

        @F.pandas_udf(StringType())
        def most_likely(texts: pd.Series) -> pd.Series:
            languages, weights, least = shared.value

            def score(text: str) -> str | None:
                best, size, lead, level = _measure(text, weights, table.value)
                if least is not None and (lead < least[size, 0] or level < least[size, 1]):
                    return None
                return languages[best]

            return texts.map(score, na_action="ignore")

        return most_likely(prepared_text)

    def add_language(self, df: DataFrame, *texts: str, column: str = "language") -> DataFrame:
        """Add the language of the first of the cleaned texts that is long enough and has a
        letter, null if none is; the others would give no language. A calibrated model also gives
        null for a text that it cannot place.

        The text is chosen first, so only one per row goes through the UDF.
        """
        chosen = F.coalesce(*[
            F.when((F.length(t) >= MIN_LANGUAGE_CHARS) & F.col(t).rlike(r"\p{L}"), F.col(t))
            for t in texts
        ])
        return df.withColumn(column, self._score(prepared(chosen)))
