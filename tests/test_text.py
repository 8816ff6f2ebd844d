"""Text expressions against Python's own string functions."""

import html
import re
import unicodedata
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressflow.fixed_values import KEYWORD_PATTERN, STOPWORDS, WHITESPACE_CHARS
from pressflow.functions import text

BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def test_whitespace_class_is_pythons():
    assert sorted(WHITESPACE_CHARS) == sorted(BLANKS)


def test_strip_removes_every_kind_of_blank(one):
    values = [f"{b}a{b}b{b}" for b in BLANKS] + ["", "  ", " 　", "x", None, "​x"]
    assert one(values, text.ustrip) == [v if v is None else v.strip() for v in values]


def test_normalize_matches_python(one):
    values = [f"a{b}{b}c {b}" for b in BLANKS] + ["", "\n\t", "a b", None]
    assert one(values, text.normalize_text) == [v and " ".join(v.split()) for v in values]


class _Text(HTMLParser):
    """Text nodes outside script, style and template."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.nodes = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.nodes.append(data)


def cleaned_by_python(raw):
    parser = _Text()
    parser.feed(raw or "")
    parser.close()
    joined = " ".join(n.strip() for n in parser.nodes if n.strip())
    normal = re.sub(r"https?://\S+", " ", unicodedata.normalize("NFKC", joined))
    return re.sub(r"\s+", " ", normal).strip()


CASES = [
    None, "", "   ", "plain words", "<b>a</b>b", "a<br>b<br/>c", "ﬁne ① Ａ b",
    "see https://x.example/a?b=c&d=e now", "HTTP://upper.example stays", "x http://a b",
    "café &amp; th&eacute;&nbsp;vert &lt;b&gt; &#233; &copy 2024", "&amp;lt;",
    "<p>one<p>two<script>var t='</p>';</script> three<!-- no <b> --> four",
    "<style>p{}</style>s<template><p>t</p></template>u", "<div\nclass='a'>in</div>",
    "السلام <i>عليكم</i>", "1 < 2 and 3 > 2",
    "<a href=\"https://x.example\">link</a> text", "😀 emoji &#128512;",
    "<?xml version='1.0'?><p>declared</p>", "a<script src=x>b</script >c<STYLE>d</STYLE>e",
]


def clean(spark, values):
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i INT, v STRING, w STRING")
    return [r["v"] for r in text.clean_columns(df, "v", "w").orderBy("i").collect()]


def test_clean_matches_python(spark):
    assert clean(spark, CASES) == [cleaned_by_python(c) for c in CASES]


def test_whole_sample_pages_match_an_html_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html")
    raw = [r["html"] for r in pages.collect()]
    assert clean(spark, raw) == [cleaned_by_python(r) for r in raw]


# one session serves all examples
@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(
    alphabet=st.sampled_from(list("ab .&; 　 éﬁ①ا\n\t\x1c")),
    max_size=30), min_size=1, max_size=20))
def test_clean_matches_python_on_any_text(spark, values):
    expected = [
        re.sub(r"\s+", " ", unicodedata.normalize("NFKC", html.unescape(v))).strip() for v in values]
    assert clean(spark, values) == expected


def test_counts_of_clean_text(one):
    values = ["", "a", "a b c", "café 😀"]
    assert one(values, text.word_count) == [len(v.split()) for v in values]
    assert one(values, text.char_count) == [len(v) for v in values]


def test_keywords_match_python(one):
    pattern = KEYWORD_PATTERN.replace(r"\x{0600}-\x{06FF}", "؀-ۿ")
    values = ["L'Été à Paris: c'est naïve, 42 ok x2abc ab",
              "العربية ١٢٣، في",
              "a×b÷c", "", "ABCdef GHI"]
    assert one(values, text.keyword_tokens) == [re.findall(pattern, v) for v in values]


def test_stopwords_are_lower_case_and_distinct():
    assert len(STOPWORDS) == len(set(STOPWORDS)) and all(w == w.lower() for w in STOPWORDS)
    assert {"the", "les", "في"} <= set(STOPWORDS)
    # words that stay countable
    assert not {"que", "qui", "est"} & set(STOPWORDS)


@pytest.mark.parametrize("raw, expected", [
    ("<b>bold", "bold"), ("a &lt; b", "a < b"), ("a<!-- open", "a"), ("a<script>open", "a"),
    ("a<style>open<p>b", "a"), ("<![CDATA[x]]>y", "y"),
])
def test_clean_examples(spark, raw, expected):
    assert clean(spark, [raw]) == [expected]


def test_null_cleans_to_empty(spark):
    df = spark.createDataFrame([(None,)], "v STRING")
    assert text.clean_columns(df, "v").where(F.col("v") == "").count() == 1
