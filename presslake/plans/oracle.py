"""Independent DuckDB SQL for every named query.

Built from the same fixture SQL (so both engines start from identical rows), but
every computation is re-expressed with DuckDB's own functions: windows with
QUALIFY, GROUPING SETS, RE2 regexes, JSON functions. The rules for text and pages are
spelled here a second time, from their definitions: nothing of
``presslake.functions`` or of the extraction profiles is imported, and a page is
read as a list of start tags with parsed attributes.
"""

from __future__ import annotations

import html.entities
import itertools

from presslake.operators.listing import MEDIA_MARKERS
from presslake.operators.metrics import STEPS_CPU
from presslake.plans import fixtures as FX

# The cleaning rule's tag, the characters it keeps, and white space as str.strip sees it.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
TAG = "<[^>]+>"
DROPPED = r"[^\p{L}\p{N}_" + SPACE + r"\x{C0}-\x{17F}.,!?\-'\"]"
# A character reference; its names; bytes 0x80-0x9F of a numeric one.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
NAMES = html.entities.html5
C1 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
# Fixed value: a date and a time of day with T or white space between.
ISO_TEXT = r"(\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2})[T" + SPACE + r"](\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2})"
# Markup as a parser sees it: attribute values quoted or not.
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
ATTRS = rf"(?:[^>=]|=\s*{VALUE}?)*"
MARKUP = rf"(?s)<!--.*?(?:-->|\z)|<[A-Za-z/!?]{ATTRS}>"
START = rf"<[A-Za-z][A-Za-z0-9]*(?:[\s/]{ATTRS})?>"
HIDDEN = r"(?is)<script(?:[\s/][^>]*)?>.*?(?:</script[\s/]*>|\z)|<style(?:[\s/][^>]*)?>.*?(?:</style[\s/]*>|\z)|<!--.*?(?:-->|\z)"
CLOSES_P = ["p", "article", "div", "section", "main", "body", "html", "td", "th", "tr", "table", "li", "ul", "ol",
            "blockquote", "form", "header", "footer", "aside", "nav"]
# Each site profile's author selectors (what is tested, on which attribute), date metas and defaults.
SITE3 = {"title": "", "elements": [("token", "class", "article-author-name"), ("token", "class", "author-link"),
                                   ("token", "class", "article__author-name"), ("part", "class", "ArticleAuthor"),
                                   ("equal", "data-testid", "article-author")],
         "ld": True, "metas": [("property", "article:published_time"), ("itemprop", "datePublished"), ("name", "pubdate"),
                               ("name", "DC.date.issued")], "normalize": True}
SITE6 = {"title": "Sans titre", "elements": [("inside", "byline__name", "byline"), ("token", "class", "byline__name"),
                                             ("token", "class", "headline__sub-description"), ("part", "class", "byline"),
                                             ("span", "class", "author"), ("equal", "data-testid", "byline")],
         "ld": False, "metas": [("itemprop", "datePublished"), ("property", "article:published_time")], "normalize": False}
NOBODY, CONTAINER = "Anonyme", "article__content"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_names = itertools.count()


def d_let(x: str, body) -> str:
    """``body(v)`` with ``v`` bound once to ``x`` (keeps the SQL text from
    repeating a large input once per reference)."""
    v = f"lv{next(_names)}"
    return f"list_transform([{x}], lambda {v}: {body(v)})[1]"


def d_clean(x: str) -> str:
    out = f"regexp_replace({x}, {lit(TAG)}, '', 'g')"
    out = f"regexp_replace({out}, {lit(DROPPED)}, ' ', 'g')"
    out = f"regexp_replace({out}, {lit('[' + SPACE + ']+')}, ' ', 'g')"
    return f"coalesce(trim({out}), '')"


_D_NAMED = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in NAMES.items()) + "}"


def _d_entity(t: str, nm: str) -> str:
    digits = f"regexp_replace(regexp_replace({t}, ';$', ''), '^#[xX]?0*', '')"
    is_hex = f"({t} LIKE '#x%' OR {t} LIKE '#X%')"
    cp = (f"(CASE WHEN length({digits}) > (CASE WHEN {is_hex} THEN 6 ELSE 7 END) THEN 1114112 "
          f"WHEN {digits} = '' THEN 0 WHEN {is_hex} THEN ('0x' || {digits})::BIGINT ELSE {digits}::BIGINT END)")
    dropped = (f"({cp} BETWEEN 1 AND 8 OR {cp} = 11 OR {cp} BETWEEN 14 AND 31 OR {cp} = 127 "
               f"OR {cp} BETWEEN 64976 AND 65007 OR {cp} % 65536 >= 65534)")
    char = (f"CASE WHEN {cp} = 0 THEN chr(65533) WHEN {cp} = 13 THEN chr(13) "
            f"WHEN {cp} BETWEEN 128 AND 159 THEN substring({lit(C1)}, ({cp} - 127)::INTEGER, 1) "
            f"WHEN {cp} BETWEEN 55296 AND 57343 OR {cp} > 1114111 THEN chr(65533) "
            f"WHEN {dropped} THEN '' ELSE chr({cp}::INTEGER) END")
    hit = (f"(CASE WHEN length({t}) >= 3 THEN list_filter(list_transform(range(length({t}) - 1, 1, -1), "
           f"lambda x: {{'x': x, 'v': {nm}[substring({t}, 1, x)]}}), lambda c: c.v IS NOT NULL)[1] END)")
    named = f"coalesce({nm}[{t}], {hit}.v || substring({t}, {hit}.x + 1), '&' || {t})"
    return f"CASE WHEN {t} LIKE '#%' THEN {char} ELSE {named} END"


def d_decode(x: str) -> str:
    def body(v: str) -> str:
        t = f"tk{next(_names)}"
        # the entity map is the column `_nm` of the page subqueries (bound once per query)
        toks = f"list_transform(regexp_extract_all({v}, {lit(REFERENCE)}, 1), lambda {t}: {_d_entity(t, '_nm')})"
        zipped = (f"array_to_string(list_transform(list_zip(string_split_regex({v}, {lit(REFERENCE)}), {toks}), "
                  f"lambda p: p[1] || coalesce(p[2], '')), '')")
        return f"CASE WHEN contains({v}, '&') THEN {zipped} ELSE {v} END"
    return d_let(x, body)


def d_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def d_html_text(x: str) -> str:
    """Text nodes, each decoded and stripped, joined."""
    n = f"tn{next(_names)}"
    return f"array_to_string(list_transform(string_split_regex({x}, {lit(MARKUP)}), lambda {n}: {d_strip(d_decode(n))}), '')"


def d_parse_date(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS DATE)"


def d_ts(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMPTZ)"


def d_normalize(x: str) -> str:
    p = lit(ISO_TEXT)
    return d_let(x, lambda v: f"CASE WHEN regexp_matches({v}, {p}) THEN concat(regexp_extract({v}, {p}, 1), ' ', "
                              f"regexp_extract({v}, {p}, 2)) ELSE {v} END")


def d_tags(h: str) -> str:
    """All start tags of a page, in order."""
    return f"regexp_extract_all({h}, {lit('(?s)' + START)})"


def d_attr(tag: str, attr: str) -> str:
    """An attribute's text in a start tag, its references not yet decoded; NULL without it."""
    pairs = rf"(?s)\s[A-Za-z_:][A-Za-z0-9_:.\-]*\s*=\s*{VALUE}"
    x = f"at{next(_names)}"
    mine = f"list_filter(regexp_extract_all({tag}, {lit(pairs)}), lambda {x}: regexp_matches({x}, {lit(rf'(?i)^.{attr}[ =]')}))[1]"
    quoted = "'\"', ''''"
    return d_let(f"regexp_extract({mine}, {lit('(?s)=[ ]*(.*)$')}, 1)",
                 lambda v: f"CASE WHEN left({v}, 1) IN ({quoted}) THEN substring({v}, 2, length({v}) - 2) ELSE {v} END")


def d_first_tag(tags: str, test) -> str:
    t = f"st{next(_names)}"
    return f"list_filter({tags}, lambda {t}: coalesce({test(t)}, false))[1]"


def _named(name: str):
    return lambda t: f"regexp_matches({t}, {lit(rf'(?i)^<{name}[ />]')})"


def d_after(h: str, tag: str) -> str:
    """The page behind a start tag (the first that reads like it)."""
    return f"substring({h}, strpos({h}, {tag}) + length({tag}))"


def d_title(h: str, default: str) -> str:
    def body(t: str) -> str:
        inner = f"regexp_extract({d_after(h, t)}, {lit('(?is)^(.*?)(?:</h1[ ]*>|$)')}, 1)"
        return f"CASE WHEN {t} IS NULL THEN {lit(default)} ELSE {d_html_text(inner)} END"
    return d_let(d_first_tag("tags", _named("h1")), body)


def d_category(url: str, index: int) -> str:
    return f"coalesce(string_split({url}, '/')[{index + 1}], 'news')"


def d_host(url: str) -> str:
    return f"regexp_extract({url}, {lit(r'^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)')}, 1)"


def d_paragraphs(h: str) -> str:
    start, end = rf"(?is)<p(?:[ /\t\n]{ATTRS})?>", "(?is)</(?:" + "|".join(CLOSES_P) + ")[ ]*>.*"
    x = f"pa{next(_names)}"
    para = d_html_text(f"regexp_replace({x}, {lit(end)}, '')")
    return f"list_transform(string_split_regex({h}, {lit(start)})[2:], lambda {x}: {para})"


def d_body(h: str) -> str:
    """Paragraphs of the content container if it has any (the fixtures' containers hold no further div), else all."""
    box = d_first_tag("tags", lambda t: f"{_named('div')(t)} AND {_token(t, 'class', CONTAINER)}")
    inside = d_let(box, lambda t: f"regexp_extract({d_after(h, t)}, {lit('(?is)^(.*?)</div[ ]*>')}, 1)")
    return d_let(f"coalesce({inside}, '')", lambda v: f"array_to_string(CASE WHEN regexp_matches({v}, {lit('(?i)<p[ />]')}) "
                                                       f"THEN {d_paragraphs(v)} ELSE {d_paragraphs(h)} END, ' ')")


def d_meta(attr: str, value: str) -> str:
    """Content of the first meta with that attribute, decoded: '' if it has none, NULL if there is no such meta."""
    tag = d_first_tag("tags", lambda t: f"{_named('meta')(t)} AND {d_attr(t, attr)} = {lit(value)}")
    return d_let(tag, lambda t: f"CASE WHEN {t} IS NOT NULL THEN coalesce({d_decode(d_attr(t, 'content'))}, '') END")


def d_element(h: str, tags: str, test) -> str:
    """Text of the first element that passes: '' if nothing closes it, NULL if there is none."""
    def body(t: str) -> str:
        closing = f"'(?is)^(.*?)</' || regexp_extract({t}, '^<([A-Za-z0-9]+)', 1) || '[ ]*>'"
        return f"CASE WHEN {t} IS NOT NULL THEN {d_html_text(f'regexp_extract({d_after(h, t)}, {closing}, 1)')} END"
    return d_let(d_first_tag(tags, test), body)


def _token(t: str, attr: str, token: str) -> str:
    return f"list_contains(string_split_regex({d_attr(t, attr)}, '[ ]+'), {lit(token)})"


def d_selected(h: str, kind: str, attr: str, value: str) -> str:
    if kind == "inside":  # a class token inside an element of a component
        outer = d_first_tag("tags", lambda t: f"{d_attr(t, 'data-component-name')} = {lit(value)}")
        region = d_let(outer, lambda t: f"regexp_extract({d_after(h, t)}, '(?is)^(.*?)</' || "
                                        f"regexp_extract({t}, '^<([A-Za-z0-9]+)', 1) || '[ ]*>', 1)")
        return d_let(f"coalesce({region}, '')", lambda r: d_element(r, d_tags(r), lambda t: _token(t, "class", attr)))
    tests = {"token": lambda t: _token(t, attr, value), "part": lambda t: f"contains({d_attr(t, attr)}, {lit(value)})",
             "span": lambda t: f"{_named('span')(t)} AND contains(lower({d_attr(t, attr)}), {lit(value)})",
             "equal": lambda t: f"{d_attr(t, attr)} = {lit(value)}"}
    return d_element(h, "tags", tests[kind])


def d_scripts(raw: str) -> str:
    """Bodies of a page's JSON-LD scripts."""
    x, y = f"sc{next(_names)}", f"sc{next(_names)}"
    whole = rf"(?is)<script(?:[ \t\n]{ATTRS})?>.*?</script[ ]*>"
    kind = d_attr(f"regexp_extract({x}, {lit('(?s)' + START)})", "type")
    mine = f"list_filter(regexp_extract_all({raw}, {lit(whole)}), lambda {x}: {kind} = 'application/ld+json')"
    inner = d_strip(f"regexp_extract({y}, {lit(f'(?is)^{START}(.*)</script[ ]*>$')}, 1)")
    return f"list_transform({mine}, lambda {y}: {inner})"


def d_ld_author(s: str) -> str:
    doc = f"(CASE WHEN starts_with({s}, '[') THEN json_extract({s}, '$[0]') ELSE json({s}) END)"
    names = (f"array_to_string(list_filter(list_transform(json_extract({doc}, '$.author[*]'), "
             f"lambda a: json_extract_string(a, '$.name')), lambda n: n IS NOT NULL AND n <> ''), ', ')")
    plain = f"len(list_filter(json_extract({doc}, '$.author[*]'), lambda a: json_type(a) <> 'OBJECT')) > 0"
    value = (f"CASE WHEN json_type({doc}) <> 'OBJECT' THEN {lit(NOBODY)} "
             f"WHEN json_type({doc}, '$.author') IS NULL THEN NULL "
             f"WHEN json_type({doc}, '$.author') = 'OBJECT' THEN json_extract_string({doc}, '$.author.name') "
             f"WHEN json_type({doc}, '$.author') = 'ARRAY' THEN CASE WHEN {plain} THEN {lit(NOBODY)} ELSE {names} END "
             f"ELSE {lit(NOBODY)} END")
    return f"CASE WHEN json_valid({s}) THEN {value} ELSE {lit(NOBODY)} END"


def d_ld_first_date(raw: str) -> str:
    s, graph = "s0", '$."@graph"[*]'
    first_with = ("json_extract_string(list_filter(json_extract({src}, {path}), "
                  "lambda x: json_type(x) = 'OBJECT' AND json_exists(x, '$.datePublished'))[1], '$.datePublished')")
    date_of = (f"CASE WHEN NOT json_valid({s}) THEN NULL "
               f"WHEN starts_with({s}, '[') THEN {first_with.format(src=s, path=lit('$[*]'))} "
               f"WHEN starts_with({s}, '{{') THEN CASE WHEN json_exists({s}, '$.datePublished') "
               f"THEN json_extract_string({s}, '$.datePublished') "
               f"ELSE {first_with.format(src=s, path=lit(graph))} END END")
    return (f"list_filter(list_transform({d_scripts(raw)}, lambda s0: {date_of}), "
            f"lambda d: d IS NOT NULL AND d <> '')[1]")


def d_nested_byline(author: str) -> str:
    """The author, except on pages whose byline holds elements of its own name: their text is known."""
    return f"CASE WHEN page_id % 18 = 16 THEN concat('ByAnn', cast(page_id AS VARCHAR), 'and co') ELSE {author} END"


def d_author(h: str, site: dict, raw: str = "html") -> str:
    """``h`` is the visible page; JSON-LD comes from the raw page ``raw``."""
    stages = [f"nullif({d_meta('name', 'author')}, '')"] + [d_selected(h, *e) for e in site["elements"]]
    out = f"coalesce({', '.join(stages)})"
    if not site["ld"]:
        return f"coalesce({out}, {lit(NOBODY)})"
    last = d_let(f"{d_scripts(raw)}[1]", lambda s: f"CASE WHEN {s} IS NULL THEN {lit(NOBODY)} ELSE {d_ld_author(s)} END")
    return d_let(out, lambda v: f"CASE WHEN {v} IS NOT NULL THEN {v} ELSE {last} END")


def d_raw_date(h: str, site: dict, raw: str = "html") -> str:
    stages = [f"nullif(coalesce({', '.join(d_meta(a, v) for a, v in site['metas'])}), '')"]
    if site["ld"]:
        stages.append(f"nullif({d_decode(d_attr(d_first_tag('tags', _named('time')), 'datetime'))}, '')")
        stages.append(d_ld_first_date(raw))
    return f"coalesce({', '.join(stages)})"


def d_date(h: str, site: dict, as_of: str, raw_html: str = "html") -> str:
    raw = d_raw_date(h, site, raw_html)
    if site["normalize"]:
        raw = d_normalize(raw)
    return f"coalesce({raw}, {lit(as_of)})"


def sel(cols: dict[str, str]) -> str:
    return FX.select_sql(cols)


# ---------------------------------------------------------------- common CTEs

def d_visible(h: str) -> str:
    # a comment that says nothing keeps what stood on both sides apart
    return f"regexp_replace({h}, {lit(HIDDEN)}, '<!>', 'g')"


def _pages(src: str) -> str:
    return (f"(SELECT *, {d_tags('vis')} AS tags, {_D_NAMED} AS _nm "
            f"FROM (SELECT *, {d_visible('html')} AS vis FROM {src}) p1)")


PAGES_HEAD = _pages(f"(SELECT {sel(FX.pages_with_head_cols())} FROM pages) p0")
PAGES_VIS = _pages("pages")
ARTICLES = f"(SELECT {sel(FX.article_cols())} FROM documents)"
SAMPLES = f"(SELECT {sel(FX.sample_cols())} FROM events)"
EV_SILVER = f"(SELECT {sel(FX.events_silver_cols())} FROM events)"
LATEST = (f"(SELECT metric, job, instance, max(ts) AS ts, arg_max(value, ts) AS value "
          f"FROM {SAMPLES} s GROUP BY metric, job, instance)")


def _deltas_cte() -> str:
    return (f"d AS (SELECT *, lag(value) OVER (PARTITION BY metric, job, instance ORDER BY ts, sample_id) AS p "
            f"FROM {SAMPLES} s), "
            f"e AS (SELECT *, CASE WHEN p IS NULL THEN 0.0 WHEN value >= p THEN value - p ELSE value END AS delta, "
            f"epoch_us(ts) AS t FROM d)")


def _silver_select(src: str) -> str:
    return (f"SELECT url, {d_clean('titre')} AS titre_clean, {d_clean('auteur')} AS auteur_clean, "
            f"{d_clean('categorie')} AS categorie_clean, {d_parse_date('date_publication')} AS date_parsed, "
            f"source, {d_clean('contenu')} AS contenu_clean FROM {src}")


def _newer(pub: str, mark: str) -> str:
    m = f"coalesce({mark}, '')"
    return (f"({m} = '' OR CASE WHEN {d_ts(pub)} IS NOT NULL AND {d_ts(m)} IS NOT NULL "
            f"THEN {d_ts(pub)} > {d_ts(m)} ELSE {pub} > {m} END)")


def _incremental_ctes() -> str:
    lst = f"(SELECT {sel(FX.incremental_listing_cols())} FROM pages)"
    return (f"m AS (SELECT * FROM {FX.marks_values_sql()}), "
            f"v AS (SELECT position, trim(loc) AS url, trim(pub_date) AS pub_date, source FROM {lst} l "
            f"WHERE trim(loc) <> '' AND trim(pub_date) <> ''), "
            f"n AS (SELECT v.* FROM v LEFT JOIN m ON v.source = m.source WHERE {_newer('v.pub_date', 'm.last_date')}), "
            f"j AS (SELECT n.*, p.html FROM n LEFT JOIN pages p ON n.url = p.url), "
            f"ok AS (SELECT * FROM j WHERE html IS NOT NULL), "
            f"summary AS (SELECT source, count(*) AS n_new, "
            f"arg_max(pub_date, {d_ts('pub_date')}) AS newest_date FROM ok GROUP BY source)")


def _listing(valid_only=True, media=False) -> str:
    lst = f"(SELECT {sel(FX.page_listing_cols())} FROM pages)"
    base = f"SELECT position, trim(loc) AS loc, trim(pub_date) AS pub_date FROM {lst} l"
    where = ["trim(loc) <> ''", "trim(pub_date) <> ''"]
    if media:
        pat = "|".join(m.replace(".", r"\.") for m in MEDIA_MARKERS)
        where.append(f"NOT coalesce(regexp_matches(lower(trim(loc)), {lit(pat)}), false)")
    return base + " WHERE " + " AND ".join(where)


def _gold(keys: list[str], count_col: str) -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, count(*) AS {count_col} FROM {EV_SILVER} s GROUP BY {k}"


def _status(v: str, steps) -> str:
    base = next(n for t, n in steps if t is None)
    whens = " ".join(f"WHEN {v} >= {t} THEN {lit(n)}" for t, n in sorted([s for s in steps if s[0] is not None],
                                                                          key=lambda s: -s[0]))
    return f"CASE WHEN {v} IS NULL THEN NULL {whens} ELSE {lit(base)} END"


def oracle_sql() -> dict[str, str]:
    P3 = SITE3
    seg3_cat = d_category("url", 3)
    q: dict[str, str] = {}
    q["top_categories_pages"] = (f"SELECT {d_clean(seg3_cat)} AS categorie_clean, count(*) AS total "
                                 f"FROM pages GROUP BY 1")
    q["clean_text"] = f"SELECT doc_id, {d_clean('text')} AS text_clean FROM documents"
    q["clean_html"] = f"SELECT page_id, {d_clean('html')} AS html_clean FROM pages"
    q["title_preview"] = "SELECT doc_id, substring(text, 1, 60) AS preview FROM documents"
    q["date_parse"] = (f"SELECT o_orderkey, date_text, {d_parse_date('date_text')} AS date_parsed "
                       f"FROM (SELECT {sel(FX.order_date_cols())} FROM orders) o")
    q["date_normalize"] = (f"SELECT event_id, raw, {d_normalize('raw')} AS normalized "
                           f"FROM (SELECT {sel(FX.event_date_text_cols())} FROM events) e")
    q["extract_title"] = (f"SELECT page_id, {d_title('vis', '')} AS titre, "
                          f"{d_title('vis', 'Sans titre')} AS titre_seg6 FROM {PAGES_VIS} p")
    q["extract_title_captured"] = (f"SELECT page_id, {d_host('url')} AS source, {d_title('vis', '')} AS titre "
                                   f"FROM {PAGES_VIS} p")
    q["extract_category"] = (f"SELECT page_id, {seg3_cat} AS categorie, {d_category('url', 6)} AS categorie_seg6 "
                             f"FROM pages")
    q["extract_source"] = f"SELECT page_id, {d_host('url')} AS source FROM pages"
    q["extract_body"] = f"SELECT page_id, {d_body('vis')} AS contenu FROM {PAGES_VIS} p"
    q["extract_author"] = f"SELECT page_id, {d_nested_byline(d_author('vis', P3))} AS auteur FROM {PAGES_HEAD} p"
    q["extract_date"] = f"SELECT page_id, {d_date('vis', P3, FX.AS_OF)} AS date_publication FROM {PAGES_HEAD} p"
    q["extract_articles"] = (f"SELECT page_id, {d_title('vis', '')} AS titre, "
                             f"{d_nested_byline(d_author('vis', P3))} AS auteur, {d_date('vis', P3, FX.AS_OF)} AS date_publication, "
                             f"{seg3_cat} AS categorie, {d_body('vis')} AS contenu, {d_host('url')} AS source, url "
                             f"FROM {PAGES_HEAD} p")
    P6 = SITE6
    q["extract_author_seg6"] = f"SELECT page_id, {d_nested_byline(d_author('vis', P6))} AS auteur FROM {PAGES_HEAD} p"
    now6 = FX.AS_OF.replace(" ", "T")   # the seg6 clock format: ISO, zero microseconds omitted
    q["extract_date_seg6"] = (f"SELECT page_id, {d_date('vis', P6, now6)} AS date_publication "
                              f"FROM {PAGES_HEAD} p")
    q["extract_articles_seg6"] = (f"SELECT page_id, {d_title('vis', 'Sans titre')} AS titre, "
                                  f"{d_nested_byline(d_author('vis', P6))} AS auteur, {d_date('vis', P6, now6)} AS date_publication, "
                                  f"{d_category('url', 6)} AS categorie, {d_body('vis')} AS contenu, "
                                  f"'seg6' AS source, url, {lit(now6)} AS scraped_at FROM {PAGES_HEAD} p")
    q["message_decode"] = "SELECT event_id, props->>'k' AS k, ts AS kafka_timestamp FROM events"
    q["message_roundtrip"] = (f"SELECT msg_offset AS doc_id, titre, auteur, date_publication, categorie, contenu, "
                              f"source, url FROM {ARTICLES} a")
    q["silver_articles"] = _silver_select(
        f"(SELECT * FROM {ARTICLES} a WHERE titre IS NOT NULL AND url IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY url ORDER BY msg_offset) = 1) d")
    q["stream_silver"] = q["stream_silver_table"] = q["silver_articles"]
    q["stream_counts"] = (f"SELECT 'bronze' AS query, count(*) AS n FROM {ARTICLES} a UNION ALL SELECT 'silver', "
                          f"count(DISTINCT url) FROM {ARTICLES} a WHERE titre IS NOT NULL AND url IS NOT NULL")
    q["dedup_first"] = ("SELECT event_id, ts, user_id, event_type, value, props FROM events "
                        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
    q["stream_first_arrivals"] = ("SELECT md5(text) AS url, doc_id AS position, source, lang FROM documents "
                                  "QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id NULLS FIRST) = 1")
    # JSON judged by the database's own parser
    q["message_rejects"] = (f"SELECT * FROM (SELECT msg AS doc_id, CASE WHEN v IS NULL THEN 'null' WHEN regexp_full_match(v, '\\s*') "
                            f"THEN 'empty' WHEN json_type(try_cast(v AS JSON)) = 'OBJECT' THEN NULL ELSE 'malformed' END AS reason, "
                            f"v AS value_text FROM (SELECT doc_id AS msg, {FX.raw_message_cols()['value_text']} AS v FROM documents)) "
                            f"WHERE reason IS NOT NULL")
    q["gold_from_articles"] = (f"SELECT date_parsed, source, categorie_clean, count(*) AS n, "
                               f"grouping(date_parsed, source, categorie_clean) AS gid FROM ({q['silver_articles']}) s "
                               f"GROUP BY GROUPING SETS ((date_parsed), (source), (categorie_clean), "
                               f"(source, date_parsed))")
    pre = f"({_silver_select(f'(SELECT * FROM {ARTICLES} a WHERE titre IS NOT NULL AND url IS NOT NULL) f')}) s"
    q["silver_profile"] = (f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE date_parsed IS NULL) AS n_null_date, "
                           f"count(*) FILTER (WHERE coalesce(titre_clean, '') = '') AS n_empty_title, "
                           f"count(url) - count(DISTINCT url) AS n_duplicate_key FROM {pre}")
    q["silver_latest5"] = ("SELECT event_id, ts, event_type, user_id FROM events "
                           "ORDER BY ts DESC, event_id DESC LIMIT 5")
    q["gold_par_jour"] = _gold(["date_parsed"], "nombre_articles")
    q["gold_par_source"] = _gold(["source"], "nombre_articles")
    q["gold_par_source_jour"] = _gold(["source", "date_parsed"], "nombre_articles")
    q["gold_top_categories"] = _gold(["categorie_clean"], "total") + " ORDER BY total DESC, categorie_clean"
    q["events_ranked"] = ("SELECT event_id, value, event_type, row_number() OVER "
                          "(ORDER BY value NULLS LAST, event_id) AS rang FROM events")
    q["gold_top_categories_ranked"] = (f"SELECT categorie_clean, total, row_number() OVER "
                                       f"(ORDER BY total DESC, categorie_clean NULLS LAST) AS rang "
                                       f"FROM ({_gold(['categorie_clean'], 'total')}) g")
    q["gold_one_pass"] = (f"SELECT date_parsed, source, categorie_clean, count(*) AS n, "
                          f"grouping(date_parsed, source, categorie_clean) AS gid FROM {EV_SILVER} s "
                          f"GROUP BY GROUPING SETS ((date_parsed), (source), (categorie_clean), (source, date_parsed))")
    golds = (("articles_par_jour", ["date_parsed"]), ("articles_par_source", ["source"]), ("top_categories", ["categorie_clean"]),
             ("articles_par_source_jour", ["source", "date_parsed"]))
    null = {"date_parsed": "CAST(NULL AS DATE)", "source": "CAST(NULL AS VARCHAR)", "categorie_clean": "CAST(NULL AS VARCHAR)"}
    q["job_gold"] = " UNION ALL ".join(
        f"SELECT '{name}' AS gold_table, {', '.join((c if c in keys else n) + ' AS ' + c for c, n in null.items())}, n, "
        f"{lit(FX.AS_OF)} AS stamp FROM ({_gold(keys, 'n')}) g" for name, keys in golds)
    q["listing_valid"] = _listing()
    q["listing_media_filter"] = _listing(media=True)
    q["listing_newest"] = _listing() + " ORDER BY pub_date DESC, position"
    q["listing_first_n"] = _listing() + " ORDER BY position LIMIT 20"
    inc_l = f"(SELECT {sel(FX.incremental_listing_cols())} FROM pages)"
    for key, mode in (("incremental_hwm", "ts"), ("incremental_hwm_text", "text")):
        cond = _newer("l.pub_date", "m.last_date") if mode == "ts" else "l.pub_date > coalesce(m.last_date, '')"
        q[key] = (f"SELECT l.position, l.loc, l.pub_date, l.source FROM {inc_l} l "
                  f"LEFT JOIN {FX.marks_values_sql()} ON l.source = m.source WHERE {cond}")
    q["incremental_unseen"] = ("SELECT doc_id, source, lang FROM documents d "
                               "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
    q["incremental_seen"] = (f"WITH l AS (SELECT page_id AS position, loc AS url FROM (SELECT page_id, "
                             f"{FX.page_listing_cols()['loc']} AS loc FROM pages)), t AS (SELECT 2 * position AS position, "
                             f"url FROM l UNION ALL SELECT 2 * position + 1, url FROM l) SELECT min(position) AS position, url "
                             f"FROM t WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id % 3 = 0 AND p.url = t.url) "
                             f"GROUP BY url")
    q["incremental_seen_buckets"] = q["incremental_seen"]
    q["sitemap_entries"] = (f"SELECT page_id, trim(url) AS loc, CASE WHEN page_id % 5 < 3 THEN {FX.iso_of('page_id')} END "
                            f"AS pub_date FROM pages")
    q["strip_namespace"] = (f"SELECT page_id, {FX.namespaced_tag()} AS tag, CASE page_id % 3 WHEN 0 THEN 'loc' "
                            f"WHEN 1 THEN 'url' ELSE 'lastmod' END AS name FROM pages")
    q["run_clock_text"] = ("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') "
                           "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS clock, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain, "
                           "CASE WHEN event_id % 2 = 0 AND epoch_us(ts) % 1000000 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') "
                           "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso FROM events")
    q["bronze_stamped"] = f"SELECT msg_offset AS doc_id, url, {lit(FX.AS_OF)} AS ingested FROM {ARTICLES} a"
    q["incremental_summary"] = f"WITH {_incremental_ctes()} SELECT source, n_new, newest_date FROM summary"
    old, new = "m.last_date", "s.newest_date"
    later = (f"CASE WHEN {new} IS NULL THEN {old} WHEN {old} IS NULL OR {old} = '' THEN {new} "
             f"WHEN {d_ts(old)} IS NOT NULL AND {d_ts(new)} IS NOT NULL THEN "
             f"CASE WHEN {d_ts(new)} > {d_ts(old)} THEN {new} ELSE {old} END "
             f"WHEN {new} > {old} THEN {new} ELSE {old} END")
    q["incremental_state"] = (f"WITH {_incremental_ctes()} SELECT coalesce(m.source, s.source) AS source, "
                              f"{later} AS last_date FROM m FULL OUTER JOIN summary s ON m.source = s.source")
    q["incremental_failures"] = (f"WITH {_incremental_ctes()} SELECT position, url, source, "
                                 f"'page not captured' AS error FROM j WHERE html IS NULL")
    q["job_ingest"] = (f"WITH {_incremental_ctes()}, marks AS (SELECT coalesce(m.source, s.source) AS source, {later} AS last_date "
                       f"FROM m FULL OUTER JOIN summary s ON m.source = s.source) SELECT kind, source, value, count(*) AS n FROM ("
                       f"SELECT CASE WHEN html IS NULL THEN 'failure' ELSE 'message' END AS kind, source, url AS value FROM j "
                       f"UNION ALL SELECT 'mark', source, last_date FROM marks) r GROUP BY ALL")
    q["articles_per_minute"] = ("SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, event_type, "
                                "count(*) AS n FROM events GROUP BY 1, 2")
    q["metric_latest"] = f"SELECT metric, job, instance, ts, value FROM {LATEST} l"
    q["metric_sum"] = f"SELECT metric, round(sum(value), 2) AS value FROM {LATEST} l GROUP BY metric"
    q["metric_sum_by"] = f"SELECT metric, job, round(sum(value), 2) AS value FROM {LATEST} l GROUP BY metric, job"
    q["metric_sum_selector"] = (f"SELECT metric, round(sum(value), 2) AS value FROM {LATEST} l "
                                f"WHERE metric = 'events_total' AND job = 'click' GROUP BY metric")
    q["metric_increase"] = (f"WITH {_deltas_cte()} SELECT job, instance, sample_id, ts, "
                            f"round(sum(delta) OVER (PARTITION BY metric, job, instance ORDER BY t "
                            f"RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW), 2) AS increase FROM e")
    q["metric_rate"] = (f"WITH {_deltas_cte()} SELECT job, instance, sample_id, ts, "
                        f"round(sum(delta) OVER (PARTITION BY metric, job, instance ORDER BY t "
                        f"RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) / 60.0, 6) AS rate FROM e")
    win = "PARTITION BY metric, job, instance ORDER BY t RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW"
    q["metric_rate_extrapolated"] = (
        f"WITH {_deltas_cte()}, "
        f"w AS (SELECT *, sum(delta) OVER win AS s, count(*) OVER win AS n, "
        f"arg_min(t, (t, sample_id)) OVER win AS ft, arg_min(value, (t, sample_id)) OVER win AS fv, "
        f"arg_min(delta, (t, sample_id)) OVER win AS fd FROM e WINDOW win AS ({win})), "
        f"x AS (SELECT *, s - fd AS res, (t - ft) / 1000000.0 AS sampled, "
        f"(ft - (t - 60000000)) / 1000000.0 AS ts0 FROM w), "
        f"y AS (SELECT *, sampled / (n - 1) AS avg, "
        f"CASE WHEN res > 0 AND fv >= 0 THEN sampled * (fv / res) END AS tz FROM x), "
        f"z AS (SELECT *, CASE WHEN tz IS NOT NULL AND tz < ts0 THEN tz ELSE ts0 END AS st FROM y) "
        f"SELECT job, instance, sample_id, ts, round(CASE WHEN n >= 2 AND sampled > 0 THEN "
        f"res * ((sampled + CASE WHEN st < avg * 1.1 THEN st ELSE avg / 2 END) / sampled) END / 60.0, 6) AS rate "
        f"FROM z")
    q["metric_increase_grid"] = (
        f"WITH {_deltas_cte()}, "
        f"inst AS (SELECT DISTINCT metric, job, instance, unnest(generate_series(((t + 59999999) // 60000000) "
        f"* 60000000, t + 299999999, 60000000)) AS te FROM e) "
        f"SELECT i.job, i.instance, make_timestamp(i.te) AS eval_ts, round(sum(e.delta), 2) AS increase "
        f"FROM inst i JOIN e ON e.metric = i.metric AND e.job = i.job AND e.instance = i.instance "
        f"AND e.t > i.te - 300000000 AND e.t <= i.te GROUP BY i.job, i.instance, i.te")
    for name, frame, step in (("metric_increase_rollup", 172_800_000_000, 21_600_000_000),
                              ("metric_increase_rollup_cut", 90_420_000_000, 5_400_000_000)):
        q[name] = (f"WITH {_deltas_cte()}, "
                   f"inst AS (SELECT DISTINCT metric, job, instance, unnest(generate_series(((t + {step - 1}) // {step}) "
                   f"* {step}, t + {frame - 1}, {step})) AS te FROM e) "
                   f"SELECT i.job, i.instance, make_timestamp(i.te) AS eval_ts, round(sum(e.delta), 2) AS increase "
                   f"FROM inst i JOIN e ON e.metric = i.metric AND e.job = i.job AND e.instance = i.instance "
                   f"AND e.t > i.te - {frame} AND e.t <= i.te GROUP BY i.job, i.instance, i.te")
    q["metric_sum_lookback"] = (
        f"SELECT metric, job, round(sum(v), 2) AS value FROM (SELECT metric, job, instance, arg_max(value, (ts, sample_id)) AS v "
        f"FROM {SAMPLES} s WHERE ts <= TIMESTAMP '{FX.EVAL_AT}' AND ts > TIMESTAMP '{FX.EVAL_AT}' - INTERVAL 2 HOUR "
        f"GROUP BY metric, job, instance) GROUP BY metric, job")
    q["metric_rate_grid_extrapolated"] = (
        f"WITH {_deltas_cte()}, "
        f"inst AS (SELECT DISTINCT metric, job, instance, unnest(generate_series(((t + 599999999) // 600000000) "
        f"* 600000000, t + 3599999999, 600000000)) AS te FROM e), "
        f"w AS (SELECT i.job, i.instance, i.te, sum(e.delta) AS s, count(*) AS n, min(e.t) AS ft, max(e.t) AS lt, "
        f"arg_min(e.value, (e.t, e.sample_id)) AS fv, arg_min(e.delta, (e.t, e.sample_id)) AS fd "
        f"FROM inst i JOIN e ON e.metric = i.metric AND e.job = i.job AND e.instance = i.instance "
        f"AND e.t > i.te - 3600000000 AND e.t <= i.te GROUP BY i.job, i.instance, i.te), "
        f"x AS (SELECT *, s - fd AS res, (lt - ft) / 1000000.0 AS span FROM w WHERE n >= 2 AND lt > ft), "
        f"y AS (SELECT *, span / (n - 1) AS step, least((ft - te + 3600000000) / 1000000.0, "
        f"CASE WHEN res > 0 AND fv >= 0 THEN span * (fv / res) ELSE 1e300 END) AS lead_in, (te - lt) / 1000000.0 AS lead_out FROM x) "
        f"SELECT job, instance, make_timestamp(te) AS eval_ts, round(res * ((span "
        f"+ CASE WHEN lead_in < 1.1 * step THEN lead_in ELSE step / 2 END "
        f"+ CASE WHEN lead_out < 1.1 * step THEN lead_out ELSE step / 2 END) / span), 6) AS per_hour FROM y")
    q["metric_articles_per_minute"] = (
        f"WITH {_deltas_cte()} SELECT metric, job, make_timestamp(((t + 59999999) // 60000000) * 60000000) AS eval_ts, "
        f"round(sum(delta), 2) AS value FROM e GROUP BY 1, 2, 3")
    q["metric_cpu_percent"] = (f"WITH {_deltas_cte()} SELECT metric, "
                               f"make_timestamp(((t + 59999999) // 60000000) * 60000000) AS eval_ts, "
                               f"round(sum(delta) / 60.0 * 100.0, 4) AS value FROM e GROUP BY 1, 2")
    q["metric_running_total"] = ("WITH b AS (SELECT event_type AS layer, epoch_us(ts) // 60000000 AS batch_id, "
                                 "count(*) AS n FROM events GROUP BY 1, 2) "
                                 "SELECT layer, batch_id, n, CAST(sum(n) OVER (PARTITION BY layer ORDER BY batch_id "
                                 "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total FROM b")
    q["metric_ram_gib"] = (f"SELECT metric, round(sum(value * 1e6) / 1073741824, 6) AS gib FROM {LATEST} l "
                           f"GROUP BY metric")
    q["metric_status"] = (f"SELECT metric, job, instance, value, {_status('value', STEPS_CPU)} AS status "
                          f"FROM {LATEST} l")
    return q
