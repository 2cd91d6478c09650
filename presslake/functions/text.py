"""Text expressions: the silver cleaning rule (C1-C4), previews (C14) and
the HTML text helpers used by extraction (node text, character
references), all as native regex/string expressions.

The cleaning rule: strip tags, replace every character outside the kept
set by a space, collapse whitespace runs to one space, trim; NULL or empty
input gives "". The character classes are written out explicitly because
Java's ``\\w``/``\\s`` differ from the Unicode-aware classes of the
cleaning rule (see README, "Unicode residue").
"""

from __future__ import annotations

import html.entities as _html_entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of the cleaning rule, written so the same
# text is valid in Java regex and RE2.
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
# Characters kept by the cleaning rule besides letters, digits,
# underscore and whitespace: the Latin-1 supplement/Latin Extended-A range
# U+00C0..U+017F and the punctuation . , ! ? - ' "
KEEP_EXTRA = r"\x{C0}-\x{17F}.,!?\-'\""

TAG_RE = r"<[^>]+>"
DROP_RE = r"[^\p{L}\p{N}_" + WS + KEEP_EXTRA + r"]"
WS_RUN_RE = "[" + WS + "]+"
EDGE_WS_RE = "^[" + WS + "]+|[" + WS + "]+$"
# Steps C2 and C3 fused: a maximal run of dropped characters and whitespace
# becomes one space either way (C2 maps each dropped character to a space,
# C3 collapses the run), so one pass over the complement of the
# non-whitespace kept set gives the same text.
DROP_OR_WS_RUN_RE = r"[^\p{L}\p{N}_" + KEEP_EXTRA + r"]+"

# Character references in extracted text and attribute values, with the
# grammar an HTML parser uses: decimal or hex with an optional ";", or a
# name of up to 32 characters with an optional ";". Names come from the
# standard library's HTML5 table (2,231 keys: "amp;" and the legacy "amp"
# a parser accepts without ";"), generated here rather than written out.
NAMED_ENTITIES = dict(sorted(_html_entities.html5.items()))
ENTITY_RE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT_CHAR = "\ufffd"


def _c1_char(b: int) -> str:
    try:
        return bytes([b]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(b)


# Numeric references 0x80-0x9F name Windows-1252 characters in legacy pages
# (&#146; is a right quote); generated from Python's cp1252 codec, bytes the
# codec leaves undefined map to themselves.
CP1252_C1 = "".join(_c1_char(b) for b in range(0x80, 0xA0))
# The basic references, in replace order (ampersand last).
BASIC_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# A reference other than the five basic ones (then the general decoder runs).
OTHER_ENTITY_RE = r"&(?!(?:amp|lt|gt|quot|#39);)(?:#[0-9]+|#[xX][0-9a-fA-F]+|[^\t\n\f <&#;]{1,32})"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c, body) -> Column:
    """``body(v)`` with ``v`` bound once to ``c``.

    A Column referenced several times is copied into the expression tree,
    and conditional branches are not common-subexpression-eliminated, so an
    expensive input would be evaluated once per reference; a one-element
    ``transform`` evaluates it once and hands ``body`` a lambda variable.
    """
    return F.get(F.transform(F.array(_c(c)), body), 0)


def strip_tags(c) -> Column:
    """Remove every ``<...>`` run; words on either side fuse."""
    return F.regexp_replace(_c(c), TAG_RE, "")


def clean_text(c) -> Column:
    """The silver cleaning of one string column."""
    out = F.regexp_replace(_c(c), TAG_RE, "")
    out = F.regexp_replace(out, DROP_OR_WS_RUN_RE, " ")
    return F.coalesce(F.trim(out), F.lit(""))


def strip_ws(c) -> Column:
    """Strip Unicode whitespace from both ends (``str.strip`` semantics)."""
    return F.regexp_replace(_c(c), EDGE_WS_RE, "")


# The named table as two string literals: "\x01name\x01name...\x01" and the values in the same order, each padded to two
# code points with \x01 (values are one or two code points; neither string uses \x01). They stand in a plan once for each
# decoder, bound by ``let``.
_DELIM = "\x01"


def _table_strings(table: dict) -> tuple[str, str]:
    names = _DELIM + _DELIM.join(table) + _DELIM
    values = "".join(v + _DELIM * (2 - len(v)) for v in table.values())
    return names, values


# Names that need their ";" are listed without it. A proper prefix of a reference never contains ";", so the longest-prefix
# rule only ever matches the legacy names, which a parser accepts without one (a small table).
_LEGACY = {k: v for k, v in NAMED_ENTITIES.items() if not k.endswith(";")}
_TABLES = (*_table_strings({k[:-1]: v for k, v in NAMED_ENTITIES.items() if k.endswith(";")}), *_table_strings(_LEGACY))


def _tables() -> Column:
    return F.struct(*[F.lit(t).alias(n) for n, t in zip(("names", "values", "legacy", "legacy_values"), _TABLES)])


def _named_char(name: Column, names: Column, values: Column) -> Column:
    """Value of a name in a directory, NULL for an unknown one."""
    def found(at: Column) -> Column:
        prefix = F.substring(names, F.lit(1), at)
        index = F.length(prefix) - F.length(F.replace(prefix, F.lit(_DELIM), F.lit("")))   # 1-based
        return F.when(at > 0, F.replace(values.substr((index * 2 - 1).cast("int"), F.lit(2)), F.lit(_DELIM), F.lit("")))
    return let(F.instr(names, F.concat(F.lit(_DELIM), name, F.lit(_DELIM))), found)


def _named_ref(tok: Column, tables: Column) -> Column:
    """A named reference body (after ``&``, with its ``;`` if any): the
    exact name; else the longest name that is a proper prefix (at least two
    characters), followed by the rest as text; else the text unchanged."""
    n = F.length(tok)
    legacy, legacy_values = tables["legacy"], tables["legacy_values"]
    cands = F.transform(F.when(n >= 3, F.sequence(n - 1, F.lit(2), F.lit(-1))),
                        lambda x: F.struct(x.alias("x"), _named_char(tok.substr(F.lit(1), x), legacy, legacy_values).alias("v")))
    hit = F.get(F.filter(cands, lambda c: c.getField("v").isNotNull()), 0)
    by_prefix = F.concat(hit.getField("v"), tok.substr(hit.getField("x") + 1, F.lit(64)))
    exact = F.when(tok.endswith(";"), _named_char(tok.substr(F.lit(1), n - 1), tables["names"], tables["values"])) \
        .otherwise(_named_char(tok, legacy, legacy_values))
    return F.coalesce(exact, by_prefix, F.concat(F.lit("&"), tok))


def _entity_char(tok: Column, tables: Column) -> Column:
    """One reference body (after ``&``, with its ``;`` if any) -> its text:
    numeric references by the parser's code point rules (code 0,
    surrogates and values beyond U+10FFFF give U+FFFD), names by
    :func:`_named_ref`."""
    is_num = tok.startswith("#")
    is_hex = is_num & F.substring(tok, 2, 1).isin("x", "X")
    digits = F.regexp_replace(F.regexp_replace(tok, ";$", ""), "^#[xX]?0*", "")
    too_big = F.length(digits) > F.when(is_hex, F.lit(6)).otherwise(F.lit(7))
    cp = (F.when(~is_num, F.lit(None))
          .when(too_big, F.lit(0x110000))
          .when(digits == "", F.lit(0))
          .when(is_hex, F.conv(digits, 16, 10))
          .otherwise(digits)).cast("long")
    # code points a parser drops: C0/C1 controls (except tab, LF, FF, CR,
    # space), DEL, U+FDD0-U+FDEF and the last two code points of every plane
    dropped = (cp.between(1, 8) | (cp == 0x0B) | cp.between(0x0E, 0x1F) | (cp == 0x7F)
               | cp.between(0xFDD0, 0xFDEF) | (F.pmod(cp, F.lit(0x10000)) >= 0xFFFE))
    char = (F.when(cp == 0, F.lit(REPLACEMENT_CHAR))
            .when(cp == 0x0D, F.lit("\r"))
            .when(cp.between(0x80, 0x9F), F.lit(CP1252_C1).substr((cp - 0x7F).cast("int"), F.lit(1)))
            .when(cp.between(0xD800, 0xDFFF) | (cp > 0x10FFFF), F.lit(REPLACEMENT_CHAR))
            .when(dropped, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")))
    return F.when(is_num, char).otherwise(_named_ref(tok, tables))


def decode_value(c: Column) -> Column:
    """The decoding rule on a value that is cheap to reference (a column or
    a lambda variable); :func:`decode_entities` binds any input first."""
    return _decode_value(c)


def _decode_value(c: Column) -> Column:
    pieces = F.split(c, ENTITY_RE, -1)

    def replaced(tables: Column) -> Column:
        toks = F.transform(F.regexp_extract_all(c, F.lit(ENTITY_RE), 1), lambda t: _entity_char(t, tables))
        return F.array_join(F.zip_with(pieces, toks, lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))), "")
    joined = let(_tables(), replaced)
    # Fast path: with only the basic references present, ordered replaces
    # (ampersand last, so "&amp;lt;" stays "&lt;") equal the single pass.
    basic = c
    for ent, ch in BASIC_ENTITIES:
        basic = F.replace(basic, F.lit(ent), F.lit(ch))
    return (F.when(F.instr(c, "&") == 0, c)
            .when(~c.rlike(OTHER_ENTITY_RE), basic)
            .otherwise(joined))


def decode_entities(c) -> Column:
    """Decode character references the way an HTML parser does for text
    and attribute values (``&amp;lt;`` -> ``&lt;``: one pass). Natively: the
    references and the text between them are split by one regex and zipped
    back with each reference replaced.

    The input is bound once to a lambda variable: the rule refers to it
    several times, and an expensive input expression would otherwise be
    evaluated once per reference.
    """
    return let(c, _decode_value)


# A start or end tag, a declaration or a comment: quotes count only after "=", so
# a ">" inside a quoted attribute does not end the tag.
ATTR_VALUE_RE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
ATTRS_RE = r"(?:[^>=]++|=\s*+" + ATTR_VALUE_RE + r"?+)*+"
MARKUP_RE = r"(?s)<!--.*?(?:-->|\z)|<[A-Za-z/!?]" + ATTRS_RE + ">"
# Stands for markup between text nodes: a code point that no text holds (not a character).
NODE = "\ufdd0"


def mark_tags(c) -> Column:
    """An HTML fragment with each tag and comment replaced by a node border (first step of :func:`html_text`)."""
    return F.regexp_replace(_c(c), MARKUP_RE, NODE)


def join_nodes(c) -> Column:
    """Text nodes stripped and joined by "" (last step of :func:`html_text`)."""
    return strip_ws(F.regexp_replace(_c(c), "[" + WS + "]*" + NODE + "[" + WS + "]*", ""))


def html_text(c) -> Column:
    """Text of an HTML fragment: each text node decoded, then stripped; nodes joined by "".

    Markup becomes a border first, so a decoded ``<`` is never mistaken for a
    tag, and white space that a reference stands for is stripped like any other.
    """
    return join_nodes(decode_entities(mark_tags(c)))


def preview(c, n: int = 60) -> Column:
    """C14: first ``n`` characters (log preview)."""
    return F.substring(_c(c), 1, n)
