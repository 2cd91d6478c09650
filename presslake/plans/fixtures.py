"""Inputs of the named queries, derived row by row from the given tables.

Every fixture column is written once as SQL text that Spark SQL and DuckDB
both accept, so a query and its oracle start from identical rows. Whole
tables are used; values that vary by row (offsets, injected head
variants) are picked by the row id.
"""

from __future__ import annotations


def iso_of(id_col: str) -> str:
    """An ISO timestamp text with one of four offset forms, from an integer id."""
    i = id_col
    return (f"concat('2024-', lpad(cast(1 + {i} % 12 as string), 2, '0'), '-', "
            f"lpad(cast(1 + {i} % 28 as string), 2, '0'), 'T', lpad(cast({i} % 24 as string), 2, '0'), ':', "
            f"lpad(cast({i} % 60 as string), 2, '0'), ':30', "
            f"CASE {i} % 4 WHEN 0 THEN '+00:00' WHEN 1 THEN '-04:00' WHEN 2 THEN 'Z' ELSE '+05:30' END)")


def date_text_of(id_col: str) -> str:
    """Like :func:`iso_of`, but every ninth id gets a text that is not a date."""
    return f"CASE WHEN {id_col} % 9 = 8 THEN 'n/a' ELSE {iso_of(id_col)} END"


# ---------------------------------------------------------------- pages + head

def page_head(id_col: str = "page_id") -> str:
    """Head fragment injected before a page, one of eighteen shapes: metas,
    selectors, JSON-LD object / list / @graph, malformed script, none, and what a
    parser reads otherwise than a plain search does."""
    i = id_col
    iso = iso_of(i)
    n = f"cast({i} as string)"
    ld = """<script type="application/ld+json">"""
    return (
        f"CASE {i} % 18 "
        f"WHEN 0 THEN concat('<meta name=\"author\" content=\"Auth &amp; Co ', {n}, '\">"
        f"<meta property=\"article:published_time\" content=\"', {iso}, '\">') "
        f"WHEN 1 THEN concat('<meta name=\"author\" content=\"\"><span class=\"byline article-author-name\">  Writer ', "
        f"{n}, ' </span><meta itemprop=\"datePublished\" content=\"\"><time datetime=\"', {iso}, '\">t</time>') "
        f"WHEN 2 THEN concat('{ld}{{\"@type\":\"NewsArticle\",\"author\":{{\"@type\":\"Person\",\"name\":\"Writer ', "
        f"{n}, '\"}},\"datePublished\":\"', {iso}, '\"}}</script>') "
        f"WHEN 3 THEN concat('{ld}[{{\"@type\":\"NewsArticle\",\"author\":[{{\"name\":\"A', {n}, "
        f"'\"}},{{\"name\":\"\"}},{{\"name\":\"B', {n}, '\"}}],\"datePublished\":\"', {iso}, '\"}}]</script>') "
        f"WHEN 4 THEN concat('{ld}{{\"@graph\":[{{\"@type\":\"WebPage\"}},{{\"@type\":\"NewsArticle\",\"datePublished\":\"', "
        f"{iso}, '\"}}],\"author\":\"Plain Name\"}}</script>') "
        f"WHEN 5 THEN concat('{ld}{{broken</script>{ld}{{\"datePublished\":\"', {iso}, "
        f"'\"}}</script><div data-testid=\"article-author\"><b>Jane</b> Doe ', {n}, "
        f"'</div><meta name=\"pubdate\" content=\"2024-02-', lpad(cast(1 + {i} % 28 as string), 2, '0'), '\">') "
        f"WHEN 6 THEN '' "
        f"WHEN 7 THEN concat('<span class=\"x ArticleAuthor y\">Spaced Name</span><meta name=\"DC.date.issued\" content=\"', "
        f"replace({iso}, 'T', ' '), '\">') "
        # a no-break space beside a tag, a comment inside a text, a reference that stands for a tag
        f"WHEN 8 THEN concat('<h1>Head&nbsp;<b>', {n}, '</b> <!-- note -->&lt;i&gt;x</h1><p>one&nbsp;<i> two</i><!-- c --> three</p>"
        f"<span class=\"author-link byline__name\">By <!-- -->Jane&#160;</span>') "
        # unquoted attributes
        f"WHEN 9 THEN concat('<meta name=author content=Unquoted', {n}, '><meta property=article:published_time content=', {iso}, '>"
        f"<script type=application/ld+json>{{\"author\":\"x\"}}</script>') "
        # a > inside a quoted attribute
        f"WHEN 10 THEN concat('<h1 data-x=\"a>b\">Title</h1><meta title=\"2>1\" name=\"author\" content=\"Greater > ', {n}, '\">"
        f"<p title=\"3>2\">para</p><meta itemprop=\"datePublished\" title=''>'' content=\"', {iso}, '\">') "
        # a void element with an author class
        f"WHEN 11 THEN '<img class=\"author-link byline__name\" src=\"x\"><div class=\"author-link byline__name\">WRONG</div>' "
        # a byline outside and one inside its component
        f"WHEN 12 THEN concat('<aside class=\"byline__name\">Outside</aside><section data-component-name=\"byline\"><i class=\"x byline__name\">"
        f"Inside ', {n}, '</i></section><a class=byline__name>After</a>') "
        # authors that are not objects
        f"WHEN 13 THEN '{ld}{{\"author\":[\"Jane\",\"Bob\"]}}</script>' "
        f"WHEN 14 THEN '{ld}{{\"author\":[{{\"name\":\"A\"}},\"Bob\"]}}</script>' "
        # custom elements whose names begin like hidden ones
        f"WHEN 15 THEN concat('<h1>T</h1><script-x>kept</script-x><p>one</p><style-guide><p>two ', {n}, '</p></style-guide>') "
        # a byline that holds elements of its own name
        f"WHEN 16 THEN concat('<div class=\"byline__name author-link\"> By <div>Ann <div>', {n}, '</div></div> and co</div><div>rest</div>') "
        # a content container
        f"ELSE concat('<p>before</p><div class=\"x article__content\"><p>In&nbsp;<i> box</i></p><p class=q>two ', {n}, '</p></div>"
        f"<span class=''story AUTHOR-name''>Case</span>') END"
    )


def pages_with_head_cols() -> dict[str, str]:
    return {"page_id": "page_id", "url": "url", "html": f"concat({page_head()}, html)"}


# ---------------------------------------------------------------- documents as articles

def article_cols() -> dict[str, str]:
    """Documents as article messages: url keyed by the text hash (copies of
    a text are duplicates of one article), first line as title (NULL for
    some rows, to exercise the silver filter), tagged author, dated."""
    return {
        "titre": "CASE WHEN doc_id % 50 = 7 THEN NULL ELSE split_part(text, chr(10), 1) END",
        "auteur": "concat('<b>Par</b> ', source, ' &amp; équipe')",
        "date_publication": date_text_of("doc_id"),
        "categorie": "lang",
        "contenu": "text",
        "source": "source",
        "url": "concat('https://news.example.org/', lang, '/', md5(text))",
        "msg_offset": "doc_id",
    }


def arrival_cols() -> dict[str, str]:
    """Documents as they arrive: keyed by their text, all with the stamp of the run that reads them."""
    return {"url": "md5(text)", "position": "doc_id", "source": "source", "lang": "lang", "arrived": f"TIMESTAMP '{AS_OF}'"}


def raw_message_cols() -> dict[str, str]:
    """Documents as raw messages: JSON objects, and by row id cut ones, lists, prose, blanks and nothing."""
    record = """concat('{"titre":"', md5(text), '","url":"https://news.example.org/', cast(doc_id as string), '"}')"""
    return {"offset": "doc_id",
            "value_text": (f"CASE doc_id % 9 WHEN 1 THEN substring({record}, 1, 30) WHEN 2 THEN concat('[', {record}, ']') "
                           "WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN text WHEN 6 THEN concat(' ', chr(10)) "
                           f"ELSE {record} END")}


# ---------------------------------------------------------------- listings

def page_listing_cols() -> dict[str, str]:
    """Pages as a sitemap listing: some empty dates, some media links."""
    return {
        "position": "page_id",
        "loc": ("CASE WHEN page_id % 9 = 4 THEN concat(url, '/photo.JPG') "
                "WHEN page_id % 13 = 5 THEN concat('https://media.cnn.com/', cast(page_id as string)) "
                "WHEN page_id % 17 = 6 THEN ' ' ELSE url END"),
        "pub_date": f"CASE WHEN page_id % 10 = 3 THEN '' ELSE {iso_of('page_id')} END",
        "source": "concat('site', cast(page_id % 3 as string))",
    }


def sitemap_cols() -> dict[str, str]:
    """A sitemap ``<url>`` element for each page: a padded ``loc``, the news date,
    the last-modified date, both, a blank one or none, and always a nested image."""
    loc = "replace(replace(url, '&', '&amp;'), '<', '&lt;')"
    news = f"concat('<news:news><news:publication_date>', {iso_of('page_id')}, '</news:publication_date></news:news>')"
    dates = (f"CASE page_id % 5 WHEN 0 THEN concat('<lastmod>', {iso_of('page_id')}, '</lastmod>') WHEN 1 THEN {news} "
             f"WHEN 2 THEN concat('<lastmod>2020-01-01</lastmod>', {news}) WHEN 3 THEN '<lastmod> </lastmod>' ELSE '' END")
    image = f"concat('<image:image><image:loc>', {loc}, '/photo.png</image:loc></image:image>')"
    return {"page_id": "page_id",
            "xml": f"concat('<url>', CASE WHEN page_id % 2 = 0 THEN {image} ELSE '' END, '<loc> ', {loc}, ' </loc>', "
                   f"{dates}, CASE WHEN page_id % 2 = 1 THEN {image} ELSE '' END, '</url>')"}


def namespaced_tag() -> str:
    return ("CASE page_id % 3 WHEN 0 THEN '{http://www.sitemaps.org/schemas/sitemap/0.9}loc' WHEN 1 THEN 'url' "
            "ELSE '{urn:a}{urn:b}lastmod' END")


def incremental_listing_cols() -> dict[str, str]:
    """Pages as a listing where every seventh URL was never captured."""
    return {
        "position": "page_id",
        "loc": "CASE WHEN page_id % 7 = 0 THEN concat(url, '?uncaptured') ELSE url END",
        "pub_date": iso_of("page_id"),
        "source": "concat('site', cast(page_id % 3 as string))",
    }


# Fixed parameters: the marks of the incremental queries (source, last date);
# site2 has no mark yet.
MARKS = [("site0", "2024-06-15T12:00:00+00:00"), ("site1", "2024-03-01T00:00:00-05:00")]
AS_OF = "2026-01-01 00:00:00"
# An instant inside the events' month.
EVAL_AT = "2024-01-15 12:00:00"


def marks_values_sql() -> str:
    rows = ", ".join(f"('{s}', '{d}')" for s, d in MARKS)
    return f"(VALUES {rows}) AS m(source, last_date)"


# ---------------------------------------------------------------- events as metric samples

def sample_cols() -> dict[str, str]:
    """Events as counter samples of one metric, 20 series (job x instance)."""
    return {
        "metric": "'events_total'",
        "job": "event_type",
        "instance": "concat('node-', cast(user_id % 4 as string))",
        "ts": "ts",
        "value": "value",
        "sample_id": "event_id",
    }


def event_date_text_cols() -> dict[str, str]:
    """Events as date texts in four shapes for the normaliser."""
    hh = "lpad(cast(hour(ts) as string), 2, '0')"
    mi = "lpad(cast(minute(ts) as string), 2, '0')"
    ss = "lpad(cast(second(ts) as string), 2, '0')"
    d = "cast(cast(ts as date) as string)"
    return {
        "event_id": "event_id",
        "raw": (f"CASE event_id % 4 WHEN 0 THEN concat({d}, 'T', {hh}, ':', {mi}, ':', {ss}, '+02:00') "
                f"WHEN 1 THEN concat({d}, ' ', {hh}, ':', {mi}, ':', {ss}, '.123456Z') "
                f"WHEN 2 THEN {d} ELSE concat('around ', {d}, 'T', {hh}, ':', {mi}, ':', {ss}) END"),
    }


def order_date_cols() -> dict[str, str]:
    """Orders as ISO texts with offsets (and some non-dates)."""
    k = "o_orderkey"
    return {
        "o_orderkey": k,
        "date_text": (f"CASE WHEN {k} % 11 = 3 THEN 'not a date' ELSE concat(cast(cast(o_orderdate as date) as string), 'T', "
                      f"lpad(cast({k} % 24 as string), 2, '0'), ':', lpad(cast({k} % 60 as string), 2, '0'), ':00', "
                      f"CASE {k} % 4 WHEN 0 THEN '+00:00' WHEN 1 THEN '-04:00' WHEN 2 THEN '+05:30' ELSE 'Z' END) END"),
    }


def events_silver_cols() -> dict[str, str]:
    """Events as silver rows for the gold counts: day, source, category."""
    return {"date_parsed": "cast(ts as date)", "source": "event_type", "categorie_clean": "concat('cat', cast(user_id % 7 as string))"}


def select_sql(cols: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in cols.items())
