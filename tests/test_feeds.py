"""Feeds and pages."""

import pytest
from pyspark.sql import functions as F

from pressflow.functions import feedxml, html
from pressflow.operators.skew import salted_left_join
from pressflow.sources.feeds import article_events, feed_items, feed_rejects, undated_items
from pressflow.sources.pages import SOURCE_RULES, Block, Byline, SourceRule, extract_pages


def feed(*items):
    return ('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>f</title>'
            + "".join(f"<item>{i}</item>" for i in items) + "</channel></rss>")


@pytest.fixture
def items(spark):
    def parse(source, xml, **options):
        df = spark.createDataFrame([("f1", source, xml)], "feed_id STRING, source STRING, xml STRING")
        return feed_items(df, **options).orderBy("position").collect()
    return parse


FULL = ("<title><![CDATA[ A & B ]]></title><link> http://x/1 </link>"
        "<pubDate>Tue, 02 Jan 2024 16:43:38 GMT</pubDate><category>c1</category>"
        "<category>c2</category><description>&lt;p&gt;hi&lt;/p&gt;</description>"
        "<dc:creator>Ana</dc:creator>")


def test_item_fields(items):
    (item,) = items("Hespress", feed(FULL))
    assert (item["title"], item["url"], item["category"]) == ("A & B", "http://x/1", "c1")
    assert (item["summary"], item["author"]) == ("<p>hi</p>", "Ana")


def test_sources_differ_in_author_and_default_category(items):
    bare = "<title>t</title><link>u</link>"
    (a,) = items("Hespress", feed(bare))
    (b,) = items("BBC News", feed(bare))
    assert a["category"] is None and b["category"] == "News"
    (b,) = items("BBC News", feed(FULL))
    assert b["author"] is None and b["category"] == "c1"


def test_limit_counts_items_without_a_link(items):
    xml = feed(*[f"<title>t{i}</title>" + (f"<link>u{i}</link>" if i != 3 else "") for i in range(20)])
    got = items("Hespress", xml, max_items=15)
    assert [r["url"] for r in got] == [f"u{i}" for i in range(15) if i != 3]
    assert len(items("Hespress", xml)) == 19


GOOD = "<title>good</title><link>http://x/1</link>"


def test_bad_markup_costs_no_other_item(items, spark):
    documents = {
        "amp": feed("<title>A & B&nbsp;C &eacute;</title><link>http://x/2?a=1&b=2</link>", GOOD),
        "cdata": feed("<title><![CDATA[A & B &amp; C]]></title><link>http://x/2</link>", GOOD),
        "cut": feed(GOOD).replace("</channel></rss>", "<item><title>half</tit"),
        "nested": feed("<title><b>x</title><link>u</link>", GOOD),
        "br": feed("<title>A <br>B</title><link>u</link>", GOOD), "br2": feed("<title>A<br/>B</title><link>u</link>", GOOD),
        "comment": feed(GOOD).replace("<item>", "<!-- <item><title>no</title><link>u</link></item> --><item>"),
        "pi": feed(GOOD).replace("<item>", "<?x <item><title>no</title><link>u</link></item> ?><item>"),
        "doctype": "<!DOCTYPE rss>" + feed(GOOD), "garbage": feed("nothing", GOOD),
        "named": feed("<title>say <![CDATA[<item> and </item>]]></title><link>u</link>", GOOD),
        "open": feed(GOOD).replace("<item>", "<item><title>no end</title><link>u</link><item>"),
        "attributes": feed('<title a="</title>">x</title><link>u</link>', GOOD),
        "empty": feed(), "none": None, "text": "not xml"}
    titles = {name: [r["title"] for r in items("Hespress", xml)] for name, xml in documents.items()}
    assert titles["amp"] == ["A & B\u00a0C &eacute;", "good"]
    assert items("Hespress", documents["amp"])[0]["url"] == "http://x/2?a=1&b=2"
    assert titles["cdata"] == ["A & B &amp; C", "good"]
    assert titles["cut"] == ["good"] and titles["nested"] == ["x", "good"]
    assert titles["br"] == ["A B", "good"] and titles["br2"] == ["AB", "good"]
    assert titles["comment"] == titles["pi"] == titles["doctype"] == ["good"]
    assert titles["named"] == ["say <item> and </item>", "good"]
    assert titles["open"] == ["good"] and titles["attributes"] == ["x", "good"]
    assert titles["empty"] == titles["none"] == titles["text"] == []
    feeds = spark.createDataFrame(
        [(n, "Hespress", x) for n, x in documents.items()], "feed_id STRING, source STRING, xml STRING")
    rejects = {(r["feed_id"], r["position"], r["reason"]) for r in feed_rejects(feeds).collect()}
    assert rejects == {("cut", 1, "cut_off"), ("open", 0, "cut_off"), ("garbage", 0, "unreadable_item"),
                       ("none", None, "no_channel"), ("text", None, "no_channel")}


@pytest.fixture
def page(spark):
    def extract(source, html, rules=SOURCE_RULES):
        df = spark.createDataFrame([(1, source, "u", html)], "page_id INT, source STRING, url STRING, html STRING")
        return extract_pages(df, rules).first()
    return extract


def test_container_before_article(page):
    html = ('<article><p>outer</p></article><div class="x article-content y"><p>one &amp; <b>two</b>'
            '<div><p>nested</p></div><p>three</div><p>after</p>')
    assert page("Hespress", html)["page_paragraphs"] == ["one & two", "nested", "three"]


def test_article_when_no_container(page):
    html = "<p>no</p><article id=a><h1>h</h1><p><b>A<br><p>B &nbsp;</p><p></p></article><p>no</p>"
    got = page("Hespress", html)
    assert got["page_paragraphs"] == ["A", "B", ""] and got["page_body"] == "A\nB\n"


def test_first_article_only_for_one_source_all_for_the_other(page):
    html = "<article><p>one</p></article><article><p>two</p></article>"
    assert page("Hespress", html)["page_body"] == "one"
    assert page("BBC News", html)["page_body"] == "one\ntwo"


def test_nested_elements_belong_to_the_outer_one(page):
    html = ("<article><p>one</p><article class=card><p>card</p></article><p>two</p></article>"
            "<p>no</p><ARTICLE><p>three</article><articles><p>no</p></articles><article>x<p>four")
    assert page("Hespress", html)["page_paragraphs"] == ["one", "card", "two"]
    assert page("BBC News", html)["page_paragraphs"] == ["one", "card", "two", "three", "four"]


def test_many_elements(page):
    html = "<article>" + "<div><p>x</p></div>" * 3000 + "</article>"
    assert len(page("Hespress", f'<div class="article-content">{html}</div>')["page_paragraphs"]) == 3000


def test_text_blocks_inside_articles(page):
    html = ('<div data-component="text-block"><p>outside</p></div><article><p>loose</p>'
            '<div data-component="text-block"><p>one</p></div>'
            "<div data-component='text-block' class=z><p>two</p></div></article>")
    assert page("BBC News", html)["page_body"] == "one\ntwo"
    empty = '<article><div data-component="text-block">no paragraph</div><p>loose</p></article>'
    assert page("BBC News", empty)["page_body"] == "loose"


def test_noise_is_not_text(page):
    html = ("<article><script>var t='<p>js</p>';</script><!-- <p>comment</p> -->"
            "<style>p{}</style><p>text</p></article>")
    assert page("Hespress", html)["page_paragraphs"] == ["text"]


@pytest.mark.parametrize("markup, expected", [
    ('<p title="a>b">one</p>', ["one"]), ("<p title='a>b' x=1>one</p>", ["one"]), ('<p title=a"b>q</p><p>r', ["q", "r"]),
    ('<p>see <img alt="<p>no</p>">it</p>', ["see it"]), ("<p>a<textarea><p>typed</textarea>b", ["a <p>typed b"]),
    ("<p>a<div><p>b</div>c</p><p>d", ["a", "b", "d"]), ("<div><b><p>x</b>y</p></div>z<p>w", ["x", "w"]),
    ("<table><tr><td>a<td><p>b</table><p>c", ["b", "c"]), ("<p>1 < 2 <3 &lt;4</p><p a='x>y", ["1 < 2 <3 <4"]),
    ("<p>x<!-- > -->y<!--></p><p>z<!-- <p>no", ["x y", "z"]), ("<ul><li><p>a<li><p>b</ul><p>c", ["a", "b", "c"]),
    ("<p>a<script>'</p><p>no'</script>b<style>p{}</style><template><p>no</p></template>", ["a b"]),
    ("<P>a<BR/>b</P><p/>c<p hidden>d</x>e", ["a b", "c", "d e"]), ("<p>a</article><p>no", ["a"]),
])
def test_markup_is_read_as_a_parser_reads_it(page, markup, expected):
    assert page("Hespress", f"<article>{markup}")["page_paragraphs"] == expected


def test_broken_markup_takes_linear_time():
    for markup in ("<a " * 50_000, '<p x="' + "y" * 500_000, "<div>" * 20_000 + "</p>" * 2000,
                   "<p><b>" * 20_000 + "</i>" * 2000, "<!--" * 50_000, "<p a=b c" * 50_000):
        html.parse(markup)
    feedxml.scan("<channel>" + "<item><title><b>" * 5000 + "<![CDATA[" * 5000)


def test_no_container(page):
    got = page("Hespress", "<p>text</p>")
    assert got["page_paragraphs"] == [] and got["page_body"] == "" and got["page_author"] is None
    assert page("Elsewhere", "<article><p>x</p></article>")["page_body"] is None \
        or page("Elsewhere", "<article><p>x</p></article>")["page_body"] == ""


def test_bylines(page):
    assert page("Hespress", '<small class="author"><i>by</i> <a href=x>Ana <b>B</b></a></small>'
                )["page_author"] == "AnaB"
    assert page("Hespress", '<div class="author"><a>Ana</a></div>')["page_author"] == "Ana"
    assert page("Hespress", '<div class="author">no link</div><b class=author><a>Ana</a></b>'
                )["page_author"] == "Ana"
    # a long element without a link, to show that no pattern recurses
    assert page("Hespress", f'<div class="author">{"x" * 200_000}</div>')["page_author"] is None
    assert page("Hespress", '<div class="author">Ana</div><a>Other</a>')["page_author"] is None
    assert page("Hespress", '<div class="authors"><a>Ana</a></div>')["page_author"] is None
    assert page("BBC News", '<div data-component="byline-block"><b>By</b> Ana &amp; Bo</div>'
                )["page_author"] == "By Ana & Bo"
    assert page("BBC News", '<span class="ssrcss-68pt20-Text-TextContributorName e">Ana</span>'
                )["page_author"] == "Ana"


def test_bylines_that_hold_elements_of_their_own_name(page):
    nested = '<div class="author"><div>by</div><a>Jane</a></div>'
    assert page("Hespress", nested)["page_author"] == "Jane"
    block = '<div data-component="byline-block"><div>By</div><div>Ann</div></div><div>no</div>'
    assert page("BBC News", block)["page_author"] == "By Ann"
    void = '<img class="author"><a>no</a><span class="author"><br><a>Jane</a></span>'
    assert page("Hespress", void)["page_author"] == "Jane"


def test_block_tags_end_a_paragraph(page):
    html = "<article><p>one<h2>head</h2><p>two <b>three</b><ul><li>four</ul><p>five</article>"
    assert page("Hespress", html)["page_paragraphs"] == ["one", "two three", "five"]


def test_a_new_source_is_one_more_rule(page):
    rule = SourceRule("New", [Block("main")], [Byline(" ", tag="cite")])
    got = page("New", "<main><p>body</p></main><cite>Ana</cite>", [*SOURCE_RULES, rule])
    assert (got["page_body"], got["page_author"]) == ("body", "Ana")
    # rules with more blocks than the new one do not disturb it
    assert page("New", "<p>x</p>", [*SOURCE_RULES, rule])["page_body"] == ""


def test_article_events(spark):
    xml = feed(
        FULL,
        "<title>no page</title><link>http://x/2</link><description> sum </description>",
        "<title> </title><link>http://x/3</link>",
        "<title>empty body</title><link>http://x/4</link><description>sum</description><dc:creator></dc:creator>")
    feeds = spark.createDataFrame([("f", "Hespress", xml)], "feed_id STRING, source STRING, xml STRING")
    pages = spark.createDataFrame([
        (1, "Hespress", "http://x/1", "<article><p>body</p></article><p class=author><a>Page</a></p>"),
        (2, "Hespress", "http://x/1", "<article><p>second fetch</p></article>"),
        (3, "Hespress", "http://x/4", "<article></article><p class=author><a>Page</a></p>"),
    ], "page_id INT, source STRING, url STRING, html STRING")
    got = {r["url"]: r for r in article_events(
        feed_items(feeds), extract_pages(pages), F.lit("now")).collect()}
    assert set(got) == {"http://x/1", "http://x/2", "http://x/4"}
    assert (got["http://x/1"]["contenu"], got["http://x/1"]["auteur"]) == ("body", "Ana")
    assert got["http://x/1"]["date_publication"] == "2024-01-02T16:43:38+00:00"
    assert (got["http://x/2"]["contenu"], got["http://x/2"]["auteur"]) == ("sum", None)
    assert (got["http://x/4"]["contenu"], got["http://x/4"]["auteur"]) == ("sum", "Page")
    # without fetched pages
    alone = {r["url"]: r["contenu"] for r in article_events(feed_items(feeds)).collect()}
    assert alone == {"http://x/1": "<p>hi</p>", "http://x/2": "sum", "http://x/4": "sum"}


def test_dates_that_cannot_be_read_are_counted(spark):
    dated = "<title>t</title><link>u</link><pubDate>{}</pubDate>"
    xml = feed(*[dated.format(d) for d in ("soon", "3 Feb 2026 4:05 PM", "soon", "99 Feb 2026")], "<title>t</title><link>u</link>")
    feeds = spark.createDataFrame([("f", "BBC News", xml)], "feed_id STRING, source STRING, xml STRING")
    got = {(r["pub_date"], r["n_items"]) for r in undated_items(feed_items(feeds)).collect()}
    assert got == {("soon", 2), ("99 Feb 2026", 1)}


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    right = left.select("k").distinct().where("k <> 'k7'").withColumn("v", F.upper("k"))
    plain = left.join(right, "k", "left")
    salted = salted_left_join(left, right, ["k"], ["id"], hot_rows=500)
    assert sorted(map(tuple, salted.select("id", "k", "v").collect())) == sorted(
        map(tuple, plain.select("id", "k", "v").collect()))
