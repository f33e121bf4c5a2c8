import pytest
from pyspark.sql import functions as F

from textmark.functions import elements, html, html_parser
from textmark.operators import links as L
from textmark.plans.harvest import PageLayout, review_records

PAGE = (
    '<html><div class="head"><a href="/x">x</a></div>'
    '<div class="big text"><p>Good &amp; <b>long</b></p><script>var a="<p>";</script>'
    '<!-- note --> end<a class="more film" href="/r/1">1</a><a href="/r/2">2</a>'
    '<script>kept()</script></div>'
    '<span class="c" itemprop="ratingValue"> 8 </span><div class="text">second</div></html>'
)
NESTED = '<div class="text">a<div>b</div>c<br>d</div><div>e</div>'
PAGES = {1: PAGE, 2: "<html><p>nothing</p></html>", 3: NESTED, 4: None}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://h.example/p{i}", page) for i, page in PAGES.items()]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def by_page(pages, column):
    return {r[0]: r[1] for r in pages.select("page_id", column).collect()}


def test_hrefs(pages):
    assert by_page(pages, html.hrefs(F.col("html")))[1] == ["/x", "/r/1", "/r/2"]
    assert by_page(pages, html.hrefs(F.col("html"), "film"))[1] == ["/r/1"]
    inside = html.hrefs(html.container(F.col("html"), "div", "text"))
    assert by_page(pages, inside)[1] == ["/r/1", "/r/2"]


def test_container(pages):
    found = by_page(pages, html.container(F.col("html"), "div", "text"))
    assert found[1].startswith("<p>Good") and found[2] is None and found[4] is None
    # Nested elements of the same name end the regular expression early ...
    assert found[3] == "a<div>b"


def test_parser_handles_nesting(pages):
    text = by_page(pages, html_parser.element_text(F.col("html"), "div", "text"))
    assert text[3] == "abcd" and text[2] is None and text[4] is None
    assert text[1] == "Good & long end12kept()"
    assert by_page(pages, html_parser.element_links(F.col("html"), "div", "text"))[1] == ["/r/1", "/r/2"]


def test_visible_text(pages):
    box = html.container(F.col("html"), "div", "text")
    assert by_page(pages, html.visible_text(box))[1] == "Good & long end12kept()"
    assert by_page(pages, html.visible_text(box, scripts="all"))[1] == "Good & long end12"


def test_any_tag_inside_another_element(spark):
    page = (
        "<b class='text'>menu</b><SECTION class='reviewPage x'><p class='text'>one <i>two</i></p>"
        "<p class='text'>three</p></SECTION><span itemprop=ratingValue>7</span>"
    )
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert tuple(review_records(pages).first()) == (1, 7.0, "one two")
    parsed = review_records(pages, PageLayout(tag="p", parse=True)).first()
    assert tuple(parsed) == (1, 7.0, "one two")


def test_links_of_all_containers(spark):
    page = (
        '<div class="text"><A HREF="/1?a=1&amp;b=2">1</A></div><a href="/no"></a>'
        "<div class='text'><a class=\"x\" href='/2'>2</a></div>"
    )
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    inside = html.hrefs(html.containers(F.col("html"), "div", "text"))
    assert by_page(pages, inside)[1] == ["/1?a=1&b=2", "/2"]
    assert by_page(pages, html_parser.element_links(F.col("html"), "div", "text"))[1] == ["/1?a=1&b=2", "/2"]


def test_every_kind_of_reference(spark):
    text = "&amp;lt; &eacute; &#233; &#xE9; &quot; R&ampD &oacute;&#8222; &nosuch; &#0; &#xD800; & &&amp;"
    row = spark.createDataFrame([(text,), ("plain",), (None,)], "t string").select(html.decoded(F.col("t")))
    assert [r[0] for r in row.collect()] == ['&lt; é é é " R&D ó„ &nosuch; \ufffd \ufffd & &&', "plain", None]


def test_links_in_any_quotes(spark):
    page = """<a href="/o'brien"></a><a href='/"x"'></a><a class=c href=/bare></a><!-- <a href="/no"></a> -->
    <script>'<a href="/no"></a>'</script><a href="/f?a=1&copy=2&lt=3&amp;b=&eacute;"></a><area class="c d" href="/any">"""
    row = spark.createDataFrame([(page,)], "t string")
    assert row.select(html.hrefs(F.col("t"))).first()[0] == [
        "/o'brien", '/"x"', "/bare", "/f?a=1&copy=2&lt=3&b=é",
    ]
    assert row.select(html.hrefs(F.col("t"), "c", None)).first()[0] == ["/any"]


def test_where_links_lead(spark):
    base = "https://h.pl/a/b?q=1#f"
    expected = {
        "p2.html": "https://h.pl/a/p2.html", "/x": "https://h.pl/x", "//cdn.pl/x": "https://cdn.pl/x",
        "mailto:a@b.pl": "mailto:a@b.pl", "HTTP://X.pl/": "HTTP://X.pl/", "?p=2": "https://h.pl/a/b?p=2",
        "#t": "https://h.pl/a/b?q=1#t", "": base,
    }
    rows = spark.createDataFrame([(base, link) for link in expected], "url string, href string")
    found = rows.select("href", html.absolute_url(F.col("url"), F.col("href")).alias("to"))
    assert {r["href"]: r["to"] for r in found.collect()} == expected
    bare = spark.createDataFrame([("https://h.pl", "x")], "url string, href string")
    assert bare.select(html.absolute_url(F.col("url"), F.col("href"))).first()[0] == "https://h.pl/x"


def test_a_less_than_sign_is_no_tag(spark):
    row = spark.createDataFrame([("3 < 5 i 7 > 2 <b>x</b><!DOCTYPE y>",)], "t string")
    assert row.select(html.visible_text(F.col("t"))).first()[0] == "3 < 5 i 7 > 2 x"


def test_a_parsed_layout_needs_a_tag():
    with pytest.raises(ValueError):
        PageLayout(parse=True)


def test_records(pages):
    layout = PageLayout(within=None)
    records = {r["page_id"]: (r["rating"], r["text"]) for r in review_records(pages, layout).collect()}
    assert records[1] == (8.0, "Good & long end12kept()")
    assert records[2] == (None, None)


def test_records_of_another_layout(spark):
    page = '<main>m</main><i id="n">bad</i>'
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    layout = PageLayout("main", None, None, ("i", "id", "n"))
    assert tuple(review_records(pages, layout).first()) == (1, None, "m")


def test_following_links(spark):
    rows = [
        (1, "https://a.example/films", '<a href="/f/1"></a><a href="/f/2"></a>'),
        (2, "https://a.example/f/1", '<a href="/r/9"></a><a href="https://b.example/z"></a>'),
        (3, "https://a.example/r/9", "review"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    links = L.absolute_links(L.link_rows(pages, html.hrefs(F.col("html"))))
    followed = {(r["page_id"], r["target_page"]) for r in L.follow(links, pages).collect()}
    assert followed == {(1, 2), (2, 3)}
    missing = {r["target"] for r in L.missing(links, pages).collect()}
    assert missing == {"https://a.example/f/2", "https://b.example/z"}


def test_listing_stops_at_the_first_empty_page(spark):
    rows = [("a", 1, 5), ("a", 2, 0), ("a", 3, 4), ("b", 1, 2), ("b", 9, 1), ("c", 1, 0)]
    listing = spark.createDataFrame(rows, "site string, page int, n_links int")
    kept = L.until_empty(listing, "site", "page", "n_links", key="page")
    assert {(r["site"], r["page"]) for r in kept.collect()} == {("a", 1), ("b", 1), ("b", 9)}


def test_pages_without_a_group_are_one(spark):
    listing = spark.createDataFrame([(None, 1, 5), (None, 2, 0), (None, 3, 1)], "site string, page int, n_links int")
    kept = L.until_empty(listing, "site", "page", "n_links", key="page")
    assert [tuple(r) for r in kept.collect()] == [(None, 1, 5)]


REVIEWS = """<body><div class="menu text"><a href="/m">m</a></div>
<section class='reviewPage x'><div>before</div>
<DIV id=1 class="a text b">one<div>two<div class=text>three</div><img src=x class=text>four<br></div><!-- </div> -->
<script>var a = "</div>";</script><a href="/in">five</a></DIV> after <div class="text">second<a href="/2"></a></div></section>
<section class="reviewPage"><p class=text>other page</p></section><div class="text">open <b>end"""


def test_nested_void_and_hidden_tags(spark):
    row = spark.createDataFrame([(REVIEWS,), ("no tags",), ("",), (None,)], "t string")

    def of(column):
        return [r[0] for r in row.select(column).collect()]

    page = F.col("t")
    divs = of(html.element(page, "div", "text"))
    assert divs[0] == '<a href="/m">m</a>' and divs[1:] == [None, None, None]
    found = of(elements.insides(page, "div", "text"))
    assert len(found[0]) == 4 and found[1:] == [[], [], None]
    assert found[0][1].startswith("one<div>two") and found[0][1].endswith('<a href="/in">five</a>')
    assert found[0][3] == "open <b>end"
    assert of(elements.insides(page, None, "reviewPage"))[0][1] == "<p class=text>other page</p>"
    text = of(html.visible_text(html.within(page, "reviewPage", None, "text")))
    assert text == ["onetwothreefour\nfive", None, None, None]
    links = of(html.hrefs(html.all_elements(page, None, "reviewPage")))
    assert links[0] == ["/in", "/2"] and links[3] is None
    assert of(elements.insides(page, "img", None))[0] == []


def test_very_deep_and_very_long_pages(spark):
    deep = '<div class="text">' + "<div>x" * 3000 + "</div>" * 3000 + "</div><div>y</div>"
    wide = '<div class="text">' + "word " * 100_000 + "</div>"
    row = spark.createDataFrame([(deep,), (wide,)], "t string")
    found = [r[0] for r in row.select(html.element(F.col("t"), "div", "text")).collect()]
    assert [len(x) for x in found] == [3000 * 12, 500_000]


def test_levels_of_links_end_at_cycles(spark):
    links = [(1, 0, 2), (1, 1, 3), (2, 0, 4), (3, 0, 4), (4, 0, 1), (4, 1, 5), (5, 0, 5), (8, 0, 9), (2, 1, 2), (2, 2, None)]
    edges = spark.createDataFrame(links, "page_id long, pos int, target_page long").where("target_page is not null")
    seeds = spark.createDataFrame([(1,), (1,)], "page_id long")
    found = {tuple(r) for r in L.traverse(edges, seeds).collect()}
    assert found == {(1, 0), (2, 1), (3, 1), (4, 2), (5, 3)}
    assert {tuple(r) for r in L.traverse(edges, seeds, most=1).collect()} == {(1, 0), (2, 1), (3, 1)}
    assert [tuple(r) for r in L.traverse(edges.limit(0), seeds).collect()] == [(1, 0)]
    assert L.traverse(edges, seeds.limit(0)).count() == 0
    assert L.traverse(edges, spark.createDataFrame([(8,)], "page_id long")).where("level = 1").count() == 1
