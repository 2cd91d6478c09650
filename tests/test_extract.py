"""X1-X8 on hand-written pages (FIXTURES.md section 3, HTML)."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.operators.extract import PROFILE_SEG3, PROFILE_SEG6, extract_articles

AS_OF = "2026-01-01 00:00:00"


def _extract(spark, pages, profile):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.asDict() for r in extract_articles(df, profile, source="S", as_of=AS_OF).orderBy("page_id").collect()]


def test_title_and_defaults(spark):
    pages = [("https://x.org/a/b/c", "<html><h1 class='t'> Big <b>News</b> </h1><p>x</p></html>"),
             ("https://x.org/a", "<html><p>no title</p></html>")]
    seg3 = _extract(spark, pages, PROFILE_SEG3)
    seg6 = _extract(spark, pages, PROFILE_SEG6)
    assert seg3[0]["titre"] == "BigNews" and seg3[1]["titre"] == ""
    assert seg6[1]["titre"] == "Sans titre"
    assert seg3[0]["auteur"] == "Anonyme" and seg6[0]["auteur"] == "Anonyme"
    assert seg3[0]["date_publication"] == AS_OF
    assert seg6[0]["date_publication"] == "2026-01-01T00:00:00"


def test_category_segments(spark):
    pages = [("https://host.com/2024/05/19/world/story", "<p>a</p>"),
             ("https://host.com/", "<p>a</p>"),
             ("https://host.com", "<p>a</p>"),
             ("https://host.com/sport/", "<p>a</p>")]
    seg3 = _extract(spark, pages, PROFILE_SEG3)
    seg6 = _extract(spark, pages, PROFILE_SEG6)
    assert [r["categorie"] for r in seg3] == ["2024", "", "news", "sport"]
    assert [r["categorie"] for r in seg6] == ["world", "news", "news", "news"]


def test_author_chain_seg3(spark):
    ld = '<script type="application/ld+json">{}</script>'
    pages = [
        ("u", '<meta name="author" content="Meta Name"><span class="article-author-name">Sel</span>'),
        ("u", '<meta name="author" content=""><span class="article-author-name">Sel <b>Name</b></span>'),
        ("u", '<span class="article-author-name"></span>'),  # existing but empty -> ""
        ("u", '<div data-testid="article-author">T</div>'),
        ("u", ld.replace("{}", '{"author":{"@type":"Person","name":"Obj"}}')),
        ("u", ld.replace("{}", '[{"author":[{"name":"A"},{"x":1},{"name":"B"}]}]')),
        ("u", ld.replace("{}", '{"author":"Just a string"}')),
        ("u", ld.replace("{}", '{"author":{"@type":"Person"}}')),
        ("u", ld.replace("{}", '{"headline":"no author"}')),
        ("u", ld.replace("{}", '{not json') + ld.replace("{}", '{"author":{"name":"Second"}}')),
        ("u", '<p>nothing</p>'),
    ]
    got = [r["auteur"] for r in _extract(spark, pages, PROFILE_SEG3)]
    assert got == ["Meta Name", "SelName", "", "T", "Obj", "A, B", "Anonyme", None, None, "Anonyme", "Anonyme"]


def test_author_chain_seg6(spark):
    pages = [
        ("u", '<div data-component-name="byline"><span class="byline__name">In Box</span></div>'
              '<span class="byline__name">Later</span>'),
        ("u", '<span class="byline__name">Plain</span>'),
        ("u", '<div class="headline__sub-description">Sub</div>'),
        ("u", '<div class="my-byline-x">Contains</div>'),
        ("u", '<span class="Post-AUTHOR">Span</span>'),
        ("u", '<p data-testid="byline">Test id</p>'),
    ]
    got = [r["auteur"] for r in _extract(spark, pages, PROFILE_SEG6)]
    assert got == ["In Box", "Plain", "Sub", "Contains", "Span", "Test id"]


def test_date_chain_seg3(spark):
    ld = '<script type="application/ld+json">{}</script>'
    pages = [
        ("u", '<meta property="article:published_time" content="2026-05-19T15:43:28+00:00">'),
        ("u", '<meta itemprop="datePublished" content="2026-05-18T01:02:03Z">'),
        ("u", '<meta name="pubdate" content="2026-05-17">'),
        ("u", '<meta name="DC.date.issued" content="2026-05-16 10:00:00">'),
        ("u", '<meta property="article:published_time" content=""><time datetime="2026-05-15T09:08:07">x</time>'),
        ("u", ld.replace("{}", '[{"@type":"A"},{"datePublished":"2026-05-14T00:00:01"}]')),
        ("u", ld.replace("{}", '{"@graph":[{"x":1},{"datePublished":"2026-05-13T00:00:02"}]}')),
        ("u", ld.replace("{}", '{bad') + ld.replace("{}", '{"datePublished":"2026-05-12T00:00:03"}')),
        ("u", '<p>none</p>'),
    ]
    got = [r["date_publication"] for r in _extract(spark, pages, PROFILE_SEG3)]
    assert got == ["2026-05-19 15:43:28", "2026-05-18 01:02:03", "2026-05-17", "2026-05-16 10:00:00",
                   "2026-05-15 09:08:07", "2026-05-14 00:00:01", "2026-05-13 00:00:02", "2026-05-12 00:00:03",
                   AS_OF]


def test_date_seg6_keeps_raw(spark):
    pages = [("u", '<meta property="article:published_time" content="2026-05-19T23:43:28-04:00">')]
    assert _extract(spark, pages, PROFILE_SEG6)[0]["date_publication"] == "2026-05-19T23:43:28-04:00"


def test_body_rules(spark):
    pages = [
        ("u", "<p>one</p><p> two <b>bold</b></p>"),
        ("u", "<p><b>first<br><p>second</p></article><footer>foot</footer>"),
        ("u", "<p>out</p><div class='article__content'><div><p>in1</p></div><p>in2</p></div><p>after</p>"),
        ("u", "<div class='article__content'>no paragraphs</div><p>all</p>"),
        ("u", "<p>a &amp; b</p>"),
    ]
    got = [r["contenu"] for r in _extract(spark, pages, PROFILE_SEG3)]
    assert got == ["one twobold", "first second", "in1 in2", "all", "a & b"]


def test_uncaptured_page_is_a_failure(spark):
    df = spark.createDataFrame([(1, "https://a/b", None)], "page_id long, url string, html string")
    r = extract_articles(df, PROFILE_SEG3, as_of=AS_OF).first()
    assert r.error == "page not captured" and r.titre is None and r.url == "https://a/b"


def test_source_defaults_to_host(spark):
    df = spark.createDataFrame([(1, "https://www.site.org:8080/x", "<p>a</p>")], "page_id long, url string, html string")
    assert extract_articles(df, PROFILE_SEG3, as_of=AS_OF).select("source").first()[0] == "www.site.org"


def test_extraction_is_one_narrow_stage(spark):
    df = spark.createDataFrame([(1, "https://a/b", "<p>a</p>")], "page_id long, url string, html string")
    plan = extract_articles(df, PROFILE_SEG3, as_of=AS_OF, with_container=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert F is not None


def test_script_style_and_comments_are_not_markup(spark):
    pages = [
        ("u", '<script>var cms = {"body": "<p>fake</p>", "h": "<h1>Fake</h1>"};</script>'
              '<style>p{x:1}</style><!-- <p>old</p> <span class="article-author-name">Old</span> -->'
              '<h1>Real</h1><p>one</p><script>document.write("<p>two</p>")</script><p>three</p>'),
        ("u", '<p>kept</p><script>never closed <p>lost</p>'),
        ("u", '<script type="application/ld+json">{"author":{"name":"From LD"}}</script><p>x</p>'),
    ]
    got = _extract(spark, pages, PROFILE_SEG3)
    assert (got[0]["titre"], got[0]["contenu"], got[0]["auteur"]) == ("Real", "one three", "Anonyme")
    assert got[1]["contenu"] == "kept"
    assert got[2]["auteur"] == "From LD"          # JSON-LD is read from the raw page


def test_nested_same_name_byline_is_balanced(spark):
    pages = [
        ("u", '<div class="article-author-name"><div>By</div> Jane <b>Doe</b></div><div>after</div><p>x</p>'),
        ("u", '<span class="article-author-name">Plain <b>Name</b></span><p>x</p>'),
    ]
    got = [r["auteur"] for r in _extract(spark, pages, PROFILE_SEG3)]
    assert got == ["ByJaneDoe", "PlainName"]


class _Paragraphs(HTMLParser):
    """Paragraph texts as the standard library's parser sees the page: a paragraph ends at the next one, or at its own or a block's end tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.open, self.hidden = [], False, False

    def handle_starttag(self, tag, attrs):
        self.hidden = tag in ("script", "style")
        if tag == "p":
            self.out.append([])
            self.open = True

    def handle_endtag(self, tag):
        self.hidden = False
        if tag in H.P_CLOSERS:
            self.open = False

    def handle_data(self, data):
        if self.open and not self.hidden:
            self.out[-1].append(data.strip())

    def texts(self):
        return ["".join(x) for x in self.out]


SHAPES = [
    "<h1>T</h1><script-x>kept</script-x><p>one</p><p>two</p>", "<style-guide><p>a</p></style-guide><p>b</p>",
    "<script>var s = '<p>no</p>'</script><p>yes</p>", "<STYLE media=x>p{}</STYLE ><p>a</p>", "<script type='a>b'>no</script><p>q</p>",
    "<p>a<script>x</script>b</p>", "<p>one<p>two</div><p>three", "<scripty><p>in</p></scripty>", "<p>a<!-- <p>no</p> -->b</p>",
    "<styled-p>x</styled-p><p>1 &lt; 2</p>"]


@pytest.mark.parametrize("page", SHAPES)
def test_body_is_what_the_library_parser_reads(spark, page):
    parser = _Paragraphs()
    parser.feed(page)
    parser.close()
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert extract_articles(df).first().contenu == " ".join(parser.texts())


@pytest.mark.parametrize("page, inside", [
    ("<div class=k>a<div>b</div>c</div>d", "a<div>b</div>c"), ("<div class=k>a<div>b</div>", "a<div>b</div>"), ("<p>x</p>", None),
    ("<DIV class=k>a</DIV><div class=k>b<br/>c</div>", "a﷐b<br/>c"), ("<div>x<div class=k>y<div class=k>z</div></div></div>", "y<div class=k>z</div>"),
    ("<div class=k></div>", ""), (None, None), ("", None), ("<div class=k>" + "<div>" * 300 + "</div>" * 300 + "e</div>x", "<div>" * 300 + "</div>" * 300 + "e")])
def test_inside_balances_tags(spark, page, inside):
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(H.container_html("html", "k").alias("x")).first().x == inside


def test_a_page_of_many_tags_takes_linear_time(spark):
    import time
    start = time.time()
    df = spark.createDataFrame([("<div class=article__content>" + "<div>a</div>" * 60_000 + "<p>end</p></div>",)], "html string")
    assert df.select(H.container_html("html", "article__content").alias("x")).first().x.endswith("<p>end</p>")
    assert time.time() - start < 30
