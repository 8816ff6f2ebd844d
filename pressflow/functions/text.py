"""Text expressions: strip, clean, count, tokenise.

Several of these read their argument more than once. Give them a plain column and chain them
with one ``withColumns`` per step, as ``clean_columns`` does, so each step runs once per row.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressflow.fixed_values import KEYWORD_PATTERN, URL_PATTERN, WHITESPACE_CHARS

# Markup that is not text, in the order in which it is removed; what is not closed goes on to
# the end. The patterns avoid look-around and possessive quantifiers, so RE2 reads them too.
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
SCRIPT = r"(?is)<script(\s[^>]*)?>.*?(?:</script(\s[^>]*)?>|\z)"
STYLE = r"(?is)<style(\s[^>]*)?>.*?(?:</style(\s[^>]*)?>|\z)"
TEMPLATE = r"(?is)<template(\s[^>]*)?>.*?(?:</template(\s[^>]*)?>|\z)"
TAG = r"(?s)<[!?/a-zA-Z][^>]*>"
HIDDEN_MARKUP = [COMMENT, SCRIPT, STYLE, TEMPLATE]


def packed(c: Column) -> Column:
    """A text compressed by itself, as ``unpacked`` reads it: a wide text then takes two thirds of
    the room in a shuffle that Spark's own compression leaves it."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        codec = pa.Codec("zstd", compression_level=3)
        return pa.array([None if x is None else len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True)
                         for x in texts.to_pylist()], pa.binary())

    return pack(c.cast("binary"))


def unpacked(c: Column) -> Column:
    """The text that was ``packed``, byte by byte."""

    @F.arrow_udf("binary")
    def unpack(blobs: pa.Array) -> pa.Array:
        codec = pa.Codec("zstd")
        return pa.array([None if x is None else codec.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True)
                         for x in blobs.to_pylist()], pa.binary())

    return unpack(c).cast("string")


def ustrip(c: Column) -> Column:
    """Strip Unicode whitespace from both ends (O30); ``trim`` alone removes only spaces."""
    return F.btrim(c, F.lit(WHITESPACE_CHARS))


def drop_hidden_markup(c: Column) -> Column:
    """Remove comments and the script, style and template blocks."""
    for pattern in HIDDEN_MARKUP:
        c = F.regexp_replace(c, pattern, " ")
    return c


def strip_tags(c: Column) -> Column:
    """Markup removed, each tag leaving a space (O31); entities are still encoded.

    Text without ``<`` skips the regex chain.
    """
    stripped = F.regexp_replace(drop_hidden_markup(c), TAG, " ")
    return F.when(F.contains(c, F.lit("<")), stripped).otherwise(c)


def decode_entities(c: Column) -> Column:
    """Entities decoded (O32). Spark has no built-in, so this is an Arrow UDF; rows without
    ``&`` send only a null to Python."""

    @F.pandas_udf(StringType())
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.coalesce(decode(F.when(F.contains(c, F.lit("&")), c)), c)


def normalize_text(c: Column) -> Column:
    """Entities decoded, NFKC, URLs and whitespace removed, in this order.

    Spark has no built-in for the first two, so this is an Arrow UDF. The last two are done in
    the same pass: the text is in Python already, where splitting on whitespace costs a fraction
    of the regex, and Spark would evaluate expressions between two chained UDFs repeatedly.
    """

    @F.pandas_udf(StringType())
    def normalize(texts: pd.Series) -> pd.Series:
        url = re.compile(URL_PATTERN)

        def one(text: str) -> str:
            text = unicodedata.normalize("NFKC", html.unescape(text))
            return " ".join(url.sub(" ", text).split())

        return texts.map(one, na_action="ignore")

    return normalize(c)


def clean_columns(df: DataFrame, *names: str) -> DataFrame:
    """Clean text columns in place (O36): markup removed, then normalised; null becomes ''."""
    for step in (lambda c: F.coalesce(c, F.lit("")), strip_tags, normalize_text):
        df = df.withColumns({name: step(F.col(name)) for name in names})
    return df


def word_count(clean: Column) -> Column:
    """Words of a cleaned text, which are separated by single spaces."""
    spaces = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.when(clean == "", 0).otherwise(spaces + 1).cast("int")


def char_count(clean: Column) -> Column:
    """Code points of a cleaned text."""
    return F.length(clean).cast("int")


def keyword_tokens(c: Column) -> Column:
    """Array of keyword candidates as written (O41); lower-case them after exploding."""
    return F.regexp_extract_all(c, F.lit(KEYWORD_PATTERN), F.lit(0))


def title_and_content(title: Column, content: Column) -> Column:
    """One text per article."""
    return F.concat_ws(" ", title, content)
