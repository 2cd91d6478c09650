"""Article extraction over captured pages.

The per-page scraping of the original pipeline is re-aimed as one
distributed projection: every field is a native expression over the
``html`` column, so a pages table of any size is extracted in a single
narrow stage (no shuffle). The page is scanned once per fragment (visible
page, metas, first h1, first time tag, JSON-LD scripts) and the field rules
run on those fragments. Site differences are data (a :class:`Profile`),
not code paths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.dates import normalize_date, now_text
from presslake.functions.scalars import split_part, url_host
from presslake.functions.text import decode_entities, decode_value, html_text, join_nodes, let, mark_tags
from presslake.schemas import ARTICLE_FIELDS  # noqa: F401  (the article record, re-exported)


@dataclass(frozen=True)
class Profile:
    """How one site's pages are read.

    * ``category_index``: 0-based segment of ``url.split('/')``; "news" when short.
    * ``title_default``: title when the page has no ``<h1>``.
    * ``author_selectors``: element tests tried after the author meta, first
      existing wins (its text, possibly "").
    * ``author_from_jsonld``: last author stage = the first JSON-LD script.
    * ``date_metas``: ``(attribute, value)`` meta tests; first existing wins,
      its non-empty ``content`` is the raw date.
    * ``date_from_time_tag`` / ``date_from_jsonld``: further date stages.
    * ``normalize_date``: raw dates go through :func:`normalize_date`.
    * ``now_format``: format of the default date (the run clock).
    * ``container_class``: class of the body container whose paragraphs win.
    """
    name: str
    category_index: int
    title_default: str
    author_selectors: tuple[H.Selector, ...]
    author_from_jsonld: bool
    date_metas: tuple[tuple[str, str], ...]
    date_from_time_tag: bool
    date_from_jsonld: bool
    normalize_date: bool
    now_format: str
    container_class: str = "article__content"
    author_default: str = "Anonyme"
    category_default: str = "news"
    extra_fields: tuple[str, ...] = field(default_factory=tuple)


# Selectors, meta names, defaults and URL segment of the
# dated-sitemap site profile (category = 4th path piece).
PROFILE_SEG3 = Profile(
    name="seg3",
    category_index=3,
    title_default="",
    author_selectors=(
        H.Selector(None, H.class_has("article-author-name"), guard="article-author-name"),
        H.Selector(None, H.class_has("author-link"), guard="author-link"),
        H.Selector(None, H.class_has("article__author-name"), guard="article__author-name"),
        H.Selector(None, H.class_contains("ArticleAuthor"), guard="ArticleAuthor"),
        H.Selector(None, H.attr_eq("data-testid", "article-author"), guard="article-author"),
    ),
    author_from_jsonld=True,
    date_metas=(
        ("property", "article:published_time"),
        ("itemprop", "datePublished"),
        ("name", "pubdate"),
        ("name", "DC.date.issued"),
    ),
    date_from_time_tag=True,
    date_from_jsonld=True,
    normalize_date=True,
    now_format="yyyy-MM-dd HH:mm:ss",
)

# Selectors, meta names, defaults and URL segment of the
# polled-sitemap site profile (category = 7th path piece).
PROFILE_SEG6 = Profile(
    name="seg6",
    category_index=6,
    title_default="Sans titre",
    author_selectors=(
        H.Selector(None, H.class_has("byline__name"), within=H.attr_eq("data-component-name", "byline"),
                   guard="byline__name"),
        H.Selector(None, H.class_has("byline__name"), guard="byline__name"),
        H.Selector(None, H.class_has("headline__sub-description"), guard="headline__sub-description"),
        H.Selector(None, H.class_contains("byline"), guard="byline"),
        H.Selector("span", H.class_contains("author", case_insensitive=True)),
        H.Selector(None, H.attr_eq("data-testid", "byline"), guard="byline"),
    ),
    author_from_jsonld=False,
    date_metas=(
        ("itemprop", "datePublished"),
        ("property", "article:published_time"),
    ),
    date_from_time_tag=False,
    date_from_jsonld=False,
    normalize_date=False,
    now_format="iso",
    extra_fields=("scraped_at",),
)

PROFILES = {p.name: p for p in (PROFILE_SEG3, PROFILE_SEG6)}


def _parts(html: Column, parts: H.Parts | None) -> H.Parts:
    return parts if parts is not None else H.inline_parts(html)


def title_expr(html: Column, profile: Profile, parts: H.Parts | None = None) -> Column:
    """Text of the first ``<h1>``; the profile default without one."""
    exists, inner = H.title_of(_parts(html, parts))
    return F.when(exists, html_text(inner)).otherwise(F.lit(profile.title_default))


def author_choice(html: Column, profile: Profile, parts: H.Parts | None = None) -> Column:
    """X2/X3 stage choice: struct ``(k, v)``: the first existing stage's raw
    text tagged with what it still needs: 1 = meta content (decode), 2 =
    element text (decode, strip), 0 = JSON-LD name or default (nothing)."""
    p = _parts(html, parts)

    def tagged(kind: int, v: Column) -> Column:
        return F.struct(F.lit(kind).alias("k"), v.alias("v"))

    m_exists, m_raw = H.meta_of(p, "name", "author", decode=False)
    rest = tagged(0, F.lit(profile.author_default))
    if profile.author_from_jsonld:
        ld_exists, ld_body = H.ld_first_of(p)
        rest = F.when(ld_exists, tagged(0, H.ld_author(ld_body, profile.author_default))).otherwise(rest)
    element = H.first_element(p.html, profile.author_selectors)
    by_page = let(element, lambda raw: F.when(raw.isNotNull(), tagged(2, mark_tags(raw))).otherwise(rest))
    return let(F.when(m_exists & (m_raw != ""), m_raw), lambda m: F.when(m.isNotNull(), tagged(1, m)).otherwise(by_page))


def _author_finish(kind: Column, raw: Column, decoded: Column) -> Column:
    return F.when(kind == 2, join_nodes(decoded)).when(kind == 1, decoded).otherwise(raw)


def author_expr(html: Column, profile: Profile, parts: H.Parts | None = None) -> Column:
    """Non-empty author meta -> first existing selector element ->
    first JSON-LD script (seg3) -> default.

    Stages yield raw text tagged with what it still needs (meta content:
    decoding; element text: decoding and stripping; JSON-LD and the
    default: nothing), so character references are decoded once, after
    the choice, instead of once per stage.
    """
    def finish(c):
        kind, raw = c.getField("k"), c.getField("v")
        return _author_finish(kind, raw, F.when(kind > 0, decode_entities(raw)))
    return let(author_choice(html, profile, parts), finish)


def raw_date_parts(html: Column, profile: Profile, parts: H.Parts | None = None) -> tuple[Column, Column | None]:
    """X4/X5 stages as (attribute text still to decode, JSON-LD date or None).

    Meta stage: the first existing meta of the profile's list; its content
    if non-empty (an empty one falls through to the next stage). Then the
    first ``<time>``'s ``datetime``; then JSON-LD ``datePublished``.
    """
    p = _parts(html, parts)
    metas = [H.meta_of(p, a, v, decode=False) for a, v in profile.date_metas]
    attr_stages = [F.nullif(H.first_existing(metas), F.lit(""))]
    if profile.date_from_time_tag:
        t_exists, t_raw = H.time_of(p, decode=False)
        attr_stages.append(F.when(t_exists & (t_raw != ""), t_raw))
    attr = F.coalesce(*attr_stages) if len(attr_stages) > 1 else attr_stages[0]
    return attr, (H.ld_first_date_of(p) if profile.date_from_jsonld else None)


def raw_date_expr(html: Column, profile: Profile, parts: H.Parts | None = None) -> Column:
    """Raw date text or NULL (attribute stages decoded once, after the choice)."""
    attr, ld = raw_date_parts(html, profile, parts)
    decoded = decode_entities(attr)
    return decoded if ld is None else F.coalesce(decoded, ld)


def _finish_date(raw: Column, profile: Profile, as_of: str | None) -> Column:
    if profile.normalize_date:
        raw = normalize_date(raw)
    return F.coalesce(raw, now_text(profile.now_format, as_of))


def date_expr(html: Column, profile: Profile, as_of: str | None, parts: H.Parts | None = None) -> Column:
    return _finish_date(raw_date_expr(html, profile, parts), profile, as_of)


def category_expr(url: Column, profile: Profile) -> Column:
    """URL path piece; the default when the URL is too short."""
    return F.coalesce(split_part(url, "/", profile.category_index), F.lit(profile.category_default))


def body_expr(html: Column, profile: Profile, with_container: bool = True,
              parts: H.Parts | None = None) -> Column:
    """Paragraphs of the content container, else all paragraphs (of the
    visible page: a ``<p>`` inside a script string is not a paragraph)."""
    vis = _parts(html, parts).html
    if not with_container or not profile.container_class:
        return H.body_text(vis)
    return H.body_text(vis, H.container_html(vis, profile.container_class))


def extract_articles(pages: DataFrame, profile: Profile = PROFILE_SEG3, source: str | None = None,
                     as_of: str | None = None, with_container: bool = True,
                     keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One article per captured page.

    ``pages`` has ``url`` and ``html`` (plus any columns in ``keep``).
    ``source`` is the constant source label (P7); without one the URL
    host is used. ``as_of`` fixes the run clock used by date defaults so a
    rerun gives identical rows. A page whose ``html`` is NULL (not
    captured) is a failed extraction: all fields NULL and ``error`` set.
    """
    url = F.col("url")
    keep_cols = [k for k in keep if k in pages.columns]
    # parts: one pass per page fragment; then raw field values from the
    # fragments, one decode over all of the page's text, final fields. Each
    # step's outputs are read several times by the next, so Catalyst keeps
    # the projections apart and every value is computed once per page.
    staged = H.with_parts(pages.select(*keep_cols, "url", "html"))
    raw_cols, decode_col, final_cols = _stage_columns(profile, source, as_of, with_container)
    keep_c = [F.col(k) for k in keep_cols]
    return (staged.select(*keep_c, "url", "html", *raw_cols)
            .select(*keep_c, "url", "html", "_r_title", "_r_author", "_r_ld_date", decode_col)
            .select(*keep_c, *final_cols))


def _stage_columns(profile: Profile, source: str | None, as_of: str | None, with_container: bool) -> tuple:
    """Columns of the three steps of :func:`extract_articles` after the page
    parts: raw field values (the title already decoded); ONE decode of
    character references over the rest of a page's text (author, date
    attribute, every paragraph), so the decoder appears twice in the plan,
    not once per field; final fields."""
    html, url = F.col("html"), F.col("url")
    parts = H.column_parts()
    t_exists, t_inner = H.title_of(parts)
    boxed = with_container and profile.container_class
    body = H.body_raws(parts.html, H.container_html(parts.html, profile.container_class) if boxed else None)
    date_attr, ld_date = raw_date_parts(html, profile, parts)
    raw_cols = (
        # the title is decoded on its own: it is often the only field read
        # (silver validity), and then the shared decode below is pruned away
        F.when(t_exists, html_text(t_inner)).otherwise(F.lit(profile.title_default)).alias("_r_title"),
        author_choice(html, profile, parts).alias("_r_author"),
        date_attr.alias("_r_date"),
        (ld_date if ld_date is not None else F.lit(None).cast("string")).alias("_r_ld_date"),
        body.alias("_r_body"),
    )
    author = F.col("_r_author")
    texts = F.concat(F.array(F.when(author.getField("k") > 0, author.getField("v")), F.col("_r_date")),
                     F.col("_r_body"))
    decode_col = F.transform(texts, decode_value).alias("_d")
    d = F.col("_d")
    fields = {
        "titre": F.col("_r_title"),
        "auteur": _author_finish(author.getField("k"), author.getField("v"), F.get(d, 0)),
        "date_publication": _finish_date(F.coalesce(F.get(d, 1), F.col("_r_ld_date")), profile, as_of),
        "categorie": category_expr(url, profile),
        "contenu": F.array_join(F.transform(F.slice(d, 3, F.size(d) - 2), join_nodes), " "),
        "source": F.lit(source) if source is not None else url_host(url),
        "url": url,
    }
    if "scraped_at" in profile.extra_fields:
        fields["scraped_at"] = now_text(profile.now_format, as_of)
    failed = F.col("html").isNull()
    final = [F.when(~failed, v).alias(k) if k != "url" else url.alias("url") for k, v in fields.items()]
    final.append(F.when(failed, F.lit("page not captured")).alias("error"))
    return raw_cols, decode_col, tuple(final)
