"""Article pages and the rules for reading each source."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.functions import html


@dataclass(frozen=True)
class Block:
    """Where paragraphs are looked for: elements of ``tag``, optionally inside others."""

    tag: str
    mark: html.Mark | None = None
    within: str | None = None
    first_only: bool = False

    def find(self, page: html.Page) -> list[html.Element]:
        if self.within is None:
            found = html.matching(page.elements, self.tag, self.mark)
        else:
            found = (e for outer in html.matching(page.elements, self.within, None)
                     for e in html.matching(page.inside(outer), self.tag, self.mark))
        return list(islice(found, 1) if self.first_only else found)


@dataclass(frozen=True)
class Byline:
    """Elements of which the first is the byline, or the first with a link holds it.

    They have ``mark``, and the name ``tag`` if one is given. ``separator`` goes between the text
    nodes."""

    separator: str
    mark: html.Mark | None = None
    tag: str | None = None
    link: bool = False

    def text(self, page: html.Page) -> str | None:
        found = html.matching(page.elements, self.tag, self.mark)
        if self.link:
            found = (a for outer in found for a in html.matching(page.inside(outer), "a", None))
        first = next(found, None)
        return None if first is None else page.text(first, self.separator)


@dataclass(frozen=True)
class SourceRule:
    """How one source's feed and pages are read. A new source is one more rule."""

    source: str
    blocks: list[Block]
    bylines: list[Byline]
    default_category: str | None = None
    feed_has_author: bool = False
    # whether a later block is tried when the first is there but has no paragraph
    paragraphs_required: bool = False

    def paragraphs(self, page: html.Page) -> list[str]:
        for block in self.blocks:
            found = block.find(page)
            texts = html.paragraphs(page, found)
            if texts or (found and not self.paragraphs_required):
                return texts
        return []

    def author(self, page: html.Page) -> str | None:
        return next((text for b in self.bylines if (text := b.text(page)) is not None), None)


# The elements that hold body and byline in each source's pages.
SOURCE_RULES = [
    SourceRule(
        source="Hespress",
        blocks=[
            Block("div", html.has_class("article-content"), first_only=True),
            Block("article", first_only=True),
        ],
        bylines=[
            Byline("", html.has_class("author"), tag="small", link=True),
            Byline("", html.has_class("author"), link=True),
        ],
        feed_has_author=True,
    ),
    SourceRule(
        source="BBC News",
        blocks=[
            Block("div", html.has_value("data-component", "text-block"), within="article"),
            Block("article"),
        ],
        bylines=[
            Byline(" ", html.has_value("data-component", "byline-block")),
            Byline(" ", html.has_class("ssrcss-68pt20-Text-TextContributorName")),
        ],
        default_category="News",
        paragraphs_required=True,
    ),
]


def by_source(source: Column, value_of, rules: list[SourceRule] = SOURCE_RULES) -> Column:
    """Pick a rule's expression by source; null for a source without a rule."""
    chosen = F
    for rule in rules:
        chosen = chosen.when(source == rule.source, value_of(rule))
    return chosen


def extract_pages(pages: DataFrame, rules: list[SourceRule] = SOURCE_RULES) -> DataFrame:
    """Body text and author of each page (O08, O09). Reads ``source``, ``url`` and ``html``.

    A page is parsed once, in Arrow batches; its markup goes no further. A page of a source without
    a rule, and a null page, has no paragraph and no author.
    """
    by_name = {rule.source: rule for rule in rules}

    @F.pandas_udf("paragraphs ARRAY<STRING>, author STRING")
    def read(sources: pd.Series, markup: pd.Series) -> pd.DataFrame:
        rows = []
        for source, text in zip(sources, markup, strict=True):
            rule = by_name.get(source)
            page = html.parse(text) if rule and text else None
            rows.append(([], None) if page is None else (rule.paragraphs(page), rule.author(page)))
        return pd.DataFrame(rows, columns=["paragraphs", "author"])

    return (
        pages.withColumn("_read", read("source", "html")).withColumns({
            "page_paragraphs": F.col("_read.paragraphs"),
            "page_author": F.col("_read.author"),
            "page_body": F.array_join("_read.paragraphs", "\n")})
        .drop("_read", "html")
    )
