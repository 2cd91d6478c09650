"""Cleaning (C1-C4, C14) against the plain-Python definition of the rule."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.functions.text import clean_text, html_text, preview


_KEPT_PUNCT = set(".,!?-'\"")


def _strip_tags(text):
    """Remove every '<', one or more non-'>' characters, '>' (leftmost first)."""
    out, i = [], 0
    while True:
        j = text.find("<", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        k = text.find(">", j + 1)
        if k > j + 1:
            out.append(text[i:j])
            i = k + 1
        else:
            out.append(text[i:j + 1])
            i = j + 1


def _kept(ch):
    return ch == "_" or ch.isalnum() or ch.isspace() or 0xC0 <= ord(ch) <= 0x17F or ch in _KEPT_PUNCT


def clean_reference(text):
    """The cleaning rule restated with string methods (the equivalence
    oracle): strip tags, blank out characters outside the kept set,
    collapse whitespace runs, trim; NULL or empty gives ""."""
    if not text:
        return ""
    blanked = "".join(ch if _kept(ch) else " " for ch in _strip_tags(text))
    return " ".join(blanked.split())


EDGE = [
    None, "", "<b></b><i/>", "a < b", "unclosed <tag", "a<br>b", "x<tag\nspans>y", "&amp; stays amp",
    "Àéîõüÿ ĀŁŒſ", "中文字符 テスト", "x² ½ ⅓", "é combining", "no break", "emoji 😀 ok",
    "tabs\tand\nnew\r\nlines", "kept . , ! ? - ' \" punct", "drop @#$%^&*()[]{}", "  edge  ",
    " line sep ", "\x1c\x1d\x1e\x1f seps", "mixed <p>para</p> and <script>x</script> text",
    "___under_score___", "Ω ω ϑ Cyrillic Жж", "​ zero width", "\x0b vertical tab",
]


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_clean_edge_rows(spark):
    got = _run(spark, EDGE, clean_text)
    assert got == [clean_reference(v) for v in EDGE]


_ATOMS = list("ab <>/\u00e9\u00c0\u017f._-'\"\t\n\u00b2\u4e2d\U0001F600 \u0301!?@#") + ["<b>", "</p>"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_ATOMS), max_size=30).map("".join), min_size=1, max_size=30))
def test_clean_property(spark, values):
    assert _run(spark, values, clean_text) == [clean_reference(v) for v in values]


def test_clean_is_idempotent_on_output(spark):
    once = _run(spark, EDGE, clean_text)
    assert _run(spark, once, clean_text) == once


def test_html_text_strips_nodes_and_decodes(spark):
    vals = ["<p>a <b>b</b></p>", "  Hello <i> World </i> ", "&lt;b&gt; &amp; co", None]
    assert _run(spark, vals, html_text) == ["ab", "HelloWorld", "<b> & co", None]


def test_preview(spark):
    assert _run(spark, ["x" * 100, "short", None], lambda c: preview(c, 60)) == ["x" * 60, "short", None]


def test_decode_entities_matches_html_unescape(spark):
    import html

    from presslake.functions.text import decode_entities
    vals = ["a &amp; b", "&amp;lt;", "it&#8217;s &rsquo;q&lsquo; &eacute;t&eacute;", "&#x1F600; &#X41;",
            "&unknown; stays", "&#0; &#xD800;", "&copy; 2026 &middot; x &nbsp;y", "no refs", "&&amp;&",
            "it&#146;s &#150; &#151; &#128; &#129; &#159;", "a&#1;b&#11;c&#13;d&#127;e&#xFDD0;f&#xFFFE;g&#x1FFFF;h",
            "&#x110000; &#12;"]
    assert _run(spark, vals, decode_entities) == [html.unescape(v) for v in vals]


def test_decode_html5_names(spark):
    import html

    from presslake.functions.text import decode_entities
    vals = ["it&apos;s", "&NewLine;x&Tab;y", "&verbar;&vert;", "&NotEqualTilde; &Afr; &bigstar;", "&nbsp;&hellip;"]
    assert _run(spark, vals, decode_entities) == [html.unescape(v) for v in vals]


def test_decode_parser_grammar(spark):
    import html

    from presslake.functions.text import decode_entities
    vals = ["&amp &lt &copy 2026", "&#8217 and &#x2019", "&notit; &ampx", "Q&A and AT&T", "&#0000065;",
            "&#99999999999; &#x1234567;", "&&&; &;", "a & b", "&amp;amp &eacute", "&LT &GT; &NotEqualTilde;"]
    assert _run(spark, vals, decode_entities) == [html.unescape(v) for v in vals]


def test_rules_apply_to_columns_of_two_frames_and_sessions(spark):
    from presslake.functions.html import paragraphs
    from presslake.functions.text import decode_entities, html_text
    other = spark.newSession()
    frames = [s.createDataFrame([(f"<p>a &amp; {k}</p>",)], "html string") for k, s in enumerate((spark, spark, other))]
    for k, df in enumerate(frames):
        row = df.select(html_text(df["html"]).alias("t"), decode_entities(df["html"]).alias("d"), paragraphs(df["html"]).alias("p")).first()
        assert (row.t, row.d, row.p) == (f"a & {k}", f"<p>a & {k}</p>", [f"a & {k}"])
