"""HTML field extraction as native expressions (X1-X7 building blocks).

Captured pages are parsed with regular expressions inside the JVM; each
helper returns a pair ``(exists, value)`` where needed, because the
extraction chains pick the first *existing* tag, not the first non-empty
value (an existing but empty author element yields "").
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.functions.text import (ATTR_VALUE_RE, ATTRS_RE, NODE, decode_entities, decode_value, html_text, join_nodes, let,
                                      mark_tags, strip_ws)

_TAGNAME = r"[A-Za-z][A-Za-z0-9]*"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(text: Column, pattern: Column, group: int) -> Column:
    """``regexp_extract`` with a pattern that is a column."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def _value_eq(value: str) -> str:
    """Regex for an attribute value equal to ``value`` (case-sensitive), quoted or not."""
    v = "(?-i:" + re.escape(value) + ")"
    return r"""(?:"VV"|'VV'|VV(?=[\s>]))""".replace("VV", v)


def attr_eq(attr: str, value: str) -> str:
    """Start-tag condition: attribute ``attr`` equals ``value``."""
    return re.escape(attr) + r"\s*=\s*" + _value_eq(value)


def class_has(token: str) -> str:
    """Start-tag condition: the class list contains ``token``."""
    return r"""class\s*=\s*(?:"(?:[^"]*\s)?TT(?:\s[^"]*)?"|'(?:[^']*\s)?TT(?:\s[^']*)?'|TT(?=[\s>]))""".replace(
        "TT", "(?-i:" + re.escape(token) + ")")


def class_contains(text: str, case_insensitive: bool = False) -> str:
    """Start-tag condition: the class attribute contains ``text`` as a substring."""
    core = re.escape(text) if case_insensitive else "(?-i:" + re.escape(text) + ")"
    return r"""class\s*=\s*(?:"[^"]*CC[^"]*"|'[^']*CC[^']*'|[^\s"'>]*CC[^\s>]*)""".replace("CC", core)


def start_tag(tag: str | None, cond: str = "") -> str:
    """Regex for a start tag named ``tag`` (any tag if None; group 1 is the name), with
    an attribute that satisfies ``cond``.

    Quotes count only after "=": a quoted ">" does not end the tag, and a
    condition never matches inside another attribute's value.
    """
    name = re.escape(tag) if tag else _TAGNAME
    if not cond:
        return r"(?is)<(" + name + r")(?=[\s/>])" + ATTRS_RE + ">"
    before = r"(?:(?!\s+" + cond + r")(?:\s|[^>=\s]++|=\s*+" + ATTR_VALUE_RE + r"?+))*+"
    return r"(?is)<(" + name + r")(?=[\s/])" + before + r"\s++" + cond + ATTRS_RE + ">"


@dataclass(frozen=True)
class Selector:
    """An element test: optional tag name + one start-tag condition.

    ``within`` is an optional condition that an enclosing element must satisfy
    (a descendant selector such as ``[a=b] .c``).
    """
    tag: str | None
    cond: str
    within: str | None = None
    guard: str | None = None     # literal that must occur in the page for a match

    def pattern(self) -> str:
        """Regex of the element's start tag; group 1 is its name."""
        return start_tag(self.tag, self.cond)


def element(html, sel: Selector, finish: bool = True) -> tuple[Column, Column]:
    """(exists, text) of the first element matching ``sel``, see :func:`first_element`."""
    text = first_element(html, [sel])
    return text.isNotNull(), (html_text(text) if finish else mark_tags(text))


def _found(pattern: str):
    return lambda h: F.when(h.rlike(pattern), F.struct(h.alias("html"), F.lit(pattern).alias("pattern")))


def first_element(html, selectors: Sequence[Selector]) -> Column:
    """Inner html of the first element of the first selector that matches; NULL if none does.

    The selector is chosen first, by one search each; its element's text is then taken once: it runs to the
    first closing tag of its name, or is empty if there is none (a void
    element). Where that span contains another start tag of the same name, the
    page's tags are balanced (:func:`inside`); other pages never get there. For a descendant selector
    :func:`inner_html` gives the inside of the enclosing elements first.
    """
    html, chosen = _c(html), F.lit(None).cast("struct<html:string,pattern:string>")
    for sel in selectors:
        found = _found(sel.pattern())
        # a byte search on the UTF-8 page skips the regex on pages that cannot match
        match = let(inner_html(html, start_tag(None, sel.within), sel.guard), found) if sel.within else found(html)
        if sel.guard:
            match = F.when(F.instr(html, sel.guard) > 0, match)
        chosen = F.coalesce(chosen, match)

    def text(at: Column) -> Column:
        page, pat = at["html"], at["pattern"]
        # the optional tail keeps the match at the first start tag, closed or not
        lazy = _extract(page, F.concat(pat, F.lit(r"(?:(.*?)</\1\s*>)?")), 2)
        name = F.lower(_extract(page, pat, 1))
        return let(lazy, lambda t: F.coalesce(
            F.when(F.instr(F.lower(t), F.concat(F.lit("<"), name)) > 0, inside(page, pat, first=True)), t))
    return let(chosen, lambda at: F.when(at.isNotNull(), text(at)))


# A start or end tag of any name.
TAG_EVENT_RE = r"(?is)</?" + _TAGNAME + r"(?=[\s/>])" + ATTRS_RE + ">"
_TAG_OF = "^</?(" + _TAGNAME + ")"


def inside(html, start_pattern: str | Column, first: bool = False) -> Column:
    """What stands inside the outermost elements whose start tag matches ``start_pattern`` (group 1 its name), tags of an
    element's own name balanced; NULL without any.

    The page's tags are an array of events, and one pass over it keeps the open element's name and depth and notes where
    each element begins and ends. Of all of them joined by a node border, an unclosed one runs to the end of the page;
    with ``first``, only the first one counts, if it is closed, and a self-closed tag opens nothing.
    """
    if isinstance(start_pattern, str):
        start_pattern = F.lit(start_pattern)
    pattern = F.concat(F.lit("^"), start_pattern)
    span = "struct<a:int,b:int>"

    def spans(tags: Column) -> Column:
        start = F.struct(F.lit(0).alias("i"), F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(0).alias("a"),
                         F.array().cast(f"array<{span}>").alias("spans"))

        def step(s: Column, tag: Column) -> Column:
            def moved(name: Column) -> Column:
                closes = tag.startswith("</")
                # a match has a name; unlike a search, extraction keeps the compiled pattern of the last row
                opens = (s["depth"] == 0) & ~closes & (_extract(tag, pattern, 1) != "")
                if first:
                    opens = opens & (F.size(s["spans"]) == 0)
                same = (s["depth"] > 0) & (name == s["name"])
                deeper = same & ~closes & (~tag.endswith("/>") if first else F.lit(True))
                ends = same & closes & (s["depth"] == 1)
                depth = F.when(opens, 1).when(same & closes, s["depth"] - 1).when(deeper, s["depth"] + 1).otherwise(s["depth"])
                done = F.struct(s["a"].alias("a"), s["i"].alias("b"))
                return F.struct((s["i"] + 1).alias("i"), F.when(opens, name).otherwise(s["name"]).alias("name"), depth.alias("depth"),
                                F.when(opens, s["i"]).otherwise(s["a"]).alias("a"),
                                F.when(ends, F.array_append(s["spans"], done)).otherwise(s["spans"]).alias("spans"))
            return let(F.lower(F.regexp_extract(tag, _TAG_OF, 1)), moved)

        def finish(s: Column) -> Column:
            if first:
                return s["spans"]
            rest = F.struct(s["a"].alias("a"), s["i"].alias("b"))
            return F.when(s["depth"] > 0, F.array_append(s["spans"], rest)).otherwise(s["spans"])
        return F.aggregate(tags, start, step, finish)

    def content(page: Column) -> Column:
        tags, between = page["tags"], page["between"]

        def joined(x: Column) -> Column:
            n = x["b"] - x["a"]
            return F.array_join(F.zip_with(F.slice(between, x["a"] + 2, n), F.slice(tags, x["a"] + 2, n - 1),
                                           lambda t, tag: F.concat(t, F.coalesce(tag, F.lit("")))), "")
        found = F.transform(spans(tags), joined)
        return F.when(F.size(found) > 0, F.array_join(found, NODE))
    return let(let(_c(html), lambda h: F.struct(F.regexp_extract_all(h, F.lit(TAG_EVENT_RE), 0).alias("tags"),
                                                F.split(h, TAG_EVENT_RE, -1).alias("between"))), content)


# ---------------------------------------------------------------- page parts

# Content a parser never reads as markup: script and style bodies and
# comments (an unclosed one runs to the end of the page, as in a parser).
# A name ends at white space, "/" or ">": a custom element such as script-x is an element like any other.
HIDDEN_RE = r"(?is)<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*>|\z)|<!--.*?(?:-->|\z)"
META_TAG_RE = start_tag("meta")
H1_RE = start_tag("h1") + r"(.*?)(?:</h1\s*>|\z)"
TIME_TAG_RE = start_tag("time")


@dataclass(frozen=True)
class Parts:
    """The few page fragments the field rules read, each found by one pass
    over the page: the visible page (scripts, styles and comments removed),
    and in it all ``<meta>`` tags, the first ``<h1>`` element and the first
    ``<time>`` tag; plus all JSON-LD script bodies of the raw page. Rules
    then run on these instead of rescanning the page per rule."""
    html: Column        # the visible page
    metas: Column
    h1: Column
    time_tag: Column
    ld: Column


def visible_html(html) -> Column:
    """The page without script/style bodies and comments; a text node ends where one stood."""
    return F.regexp_replace(_c(html), HIDDEN_RE, NODE)


def part_exprs(html, visible) -> dict[str, Column]:
    html, visible = _c(html), _c(visible)
    return {
        "_p_metas": F.regexp_extract_all(visible, F.lit(META_TAG_RE), 0),
        "_p_h1": F.regexp_extract(visible, H1_RE, 0),
        "_p_time": F.regexp_extract(visible, TIME_TAG_RE, 0),
        "_p_ld": F.regexp_extract_all(html, F.lit(LD_SCRIPT_RE), 2),
    }


def inline_parts(html) -> Parts:
    """Parts as expressions over ``html`` (for a single rule on its own)."""
    vis = visible_html(html)
    e = part_exprs(html, vis)
    return Parts(vis, e["_p_metas"], e["_p_h1"], e["_p_time"], e["_p_ld"])


def column_parts() -> Parts:
    """Parts read from columns materialised by :func:`with_parts`."""
    return Parts(F.col("_p_vis"), F.col("_p_metas"), F.col("_p_h1"), F.col("_p_time"), F.col("_p_ld"))


def title_of(parts: Parts) -> tuple[Column, Column]:
    """(exists, inner html) of the first ``<h1>``; unclosed runs to the end."""
    return parts.h1 != "", F.regexp_extract(parts.h1, H1_RE, 2)


def meta_of(parts: Parts, attr: str, value: str, content_attr: str = "content",
            decode: bool = True) -> tuple[Column, Column]:
    """(exists, content) of the first ``<meta attr="value">``; ``decode=False``
    leaves character references for a single decode after a choice."""
    cond = start_tag("meta", attr_eq(attr, value))
    tag = F.get(F.filter(parts.metas, lambda m: m.rlike(cond)), 0)
    return tag.isNotNull(), _attr_of(F.coalesce(tag, F.lit("")), content_attr, decode)


def time_of(parts: Parts, attr: str = "datetime", decode: bool = True) -> tuple[Column, Column]:
    return parts.time_tag != "", _attr_of(parts.time_tag, attr, decode)


def ld_first_of(parts: Parts) -> tuple[Column, Column]:
    return F.size(parts.ld) > 0, strip_ws(F.get(parts.ld, 0))


def ld_first_date_of(parts: Parts) -> Column:
    dates = F.transform(parts.ld, ld_date)
    return F.get(F.filter(dates, lambda d: d.isNotNull() & (d != "")), 0)


def _attr_of(tag_text: Column, attr: str, decode: bool = True) -> Column:
    """Value of ``attr`` in one start tag ('' when absent), entities decoded."""
    a = re.escape(attr) + r"\s*="
    before = r"(?:(?!\s+" + a + r")(?:\s|[^>=\s]++|=\s*+" + ATTR_VALUE_RE + r"?+))*+"
    pat = r"(?is)^<" + _TAGNAME + before + r"""\s++""" + a + r"""\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
    raw = let(tag_text, lambda t: F.concat(*[F.regexp_extract(t, pat, k) for k in (1, 2, 3)]))
    return decode_entities(raw) if decode else raw


def first_existing(pairs: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """Value of the first pair whose ``exists`` is true (``otherwise`` if none)."""
    expr = None
    for exists, value in pairs:
        expr = F.when(exists, value) if expr is None else expr.when(exists, value)
    if expr is None:
        return otherwise if otherwise is not None else F.lit(None).cast("string")
    return expr.otherwise(otherwise) if otherwise is not None else expr


# ---------------------------------------------------------------- JSON-LD

LD_SCRIPT_RE = start_tag("script", attr_eq("type", "application/ld+json")) + r"(.*?)</script\s*>"

_MAP = T.MapType(T.StringType(), T.StringType())
_MAP_LIST = T.ArrayType(_MAP)
_NAMED_LIST = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))


def ld_author(script: Column, default: str) -> Column:
    """Author from one JSON-LD document.

    A list document uses its first element. ``author`` as a list of objects gives the
    non-empty names joined by ", " (a list that holds anything else gives ``default``); as an object, its ``name`` (NULL when
    missing; a missing ``author`` behaves like an empty object); any other
    shape, an unparsable script or a non-object document gives ``default``.
    """
    s = strip_ws(script)
    doc = F.when(s.startswith("["), F.get_json_object(s, "$[0]")).otherwise(s)
    doc_ok = F.get_json_object(s, "$").isNotNull() & F.coalesce(strip_ws(doc).startswith("{"), F.lit(False))
    author = strip_ws(F.get_json_object(doc, "$.author"))
    names = F.filter(F.from_json(author, _NAMED_LIST).getField("name"),
                     lambda x: x.isNotNull() & (x != ""))
    value = (F.when(author.isNull(), F.lit(None).cast("string"))
             .when(author.startswith("{"), F.get_json_object(author, "$.name"))
             .when(author.startswith("["), F.when(F.forall(F.from_json(author, "array<string>"), lambda x: F.coalesce(
                 strip_ws(x).startswith("{"), F.lit(False))), F.array_join(names, ", ")).otherwise(F.lit(default)))
             .otherwise(F.lit(default)))
    return F.when(doc_ok, value).otherwise(F.lit(default))


def _first_with_key(items: Column, key: str) -> Column:
    return F.get(F.filter(items, lambda m: F.map_contains_key(m, key)), 0)[key]


def ld_date(script: Column) -> Column:
    """``datePublished`` of one JSON-LD document: first list item that has it,
    else the object's own, else the first ``@graph`` item that has it."""
    s = strip_ws(script)
    as_list = F.from_json(s, _MAP_LIST)
    as_obj = F.from_json(s, _MAP)
    graph = F.from_json(as_obj["@graph"], _MAP_LIST)
    return (F.when(s.startswith("["), _first_with_key(as_list, "datePublished"))
            .when(s.startswith("{"),
                  F.when(F.map_contains_key(as_obj, "datePublished"), as_obj["datePublished"])
                  .otherwise(_first_with_key(graph, "datePublished"))))


# ---------------------------------------------------------------- paragraphs

P_START_RE = start_tag("p")
# End tags that close an open paragraph (its own, or that of a
# block element that can contain it).
P_CLOSERS = ["p", "article", "div", "section", "main", "body", "html", "td", "th", "tr", "table",
             "li", "ul", "ol", "blockquote", "form", "header", "footer", "aside", "nav"]
P_END_RE = r"(?is)</(?:" + "|".join(P_CLOSERS) + r")\s*>.*"


def paragraphs(html) -> Column:
    """Text of every ``<p>`` in document order.

    A paragraph runs from its start tag to the next ``<p>``, ``</p>`` or
    end tag of an enclosing block, whichever comes first (unclosed
    paragraphs do not swallow their successors); its text is each node
    stripped, joined by "".
    """
    pieces = F.split(_c(html), P_START_RE, -1)
    body = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(body, lambda x: html_text(F.regexp_replace(x, P_END_RE, "")))


def paragraph_raws(html) -> Column:
    """Like :func:`paragraphs`, before character references are decoded and
    the ends stripped (for a single decode pass over all of a page's text)."""
    pieces = F.split(_c(html), P_START_RE, -1)
    body = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(body, lambda x: mark_tags(F.regexp_replace(x, P_END_RE, "")))


def body_raws(html, container: Column | None = None) -> Column:
    """Paragraphs of the content container if it has any, else all paragraphs, before they are decoded."""
    all_p = paragraph_raws(html)
    if container is None:
        return all_p
    return let(paragraph_raws(container), lambda box: F.when(F.size(box) > 0, box).otherwise(all_p))


def body_text(html, container: Column | None = None) -> Column:
    """The paragraphs of :func:`body_raws` as text, joined with one space."""
    return F.array_join(F.transform(body_raws(html, container), lambda x: join_nodes(decode_value(x))), " ")


def inner_html(html, start_pattern: str, guard: str | None) -> Column:
    """:func:`inside`, only for pages that hold the literal ``guard``; NULL for others."""
    html = _c(html)
    return inside(html, start_pattern) if guard is None else F.when(F.instr(html, guard) > 0, inside(html, start_pattern))


def container_html(html, class_token: str) -> Column:
    """Inner html of every ``<div class~=class_token>`` (outermost, balanced)."""
    return inner_html(html, start_tag("div", class_has(class_token)), class_token)


def with_parts(df, html: str = "html"):
    """``df`` plus the page-part columns (one pass per fragment), for rules
    applied through :func:`column_parts`. The visible page is materialised
    first so the fragment passes read it once."""
    df = df.select("*", visible_html(F.col(html)).alias("_p_vis"))
    return df.select("*", *[v.alias(k) for k, v in part_exprs(F.col(html), F.col("_p_vis")).items()])
