"""Column -> Column expressions (all JVM-side, no Python UDFs)."""

from presslake.functions.text import clean_text, preview, strip_tags, html_text, decode_entities
from presslake.functions.dates import parse_date, normalize_date, now_text
from presslake.functions.scalars import scale, status, split_part, strip_ns, url_host

__all__ = [
    "clean_text", "preview", "strip_tags", "html_text", "decode_entities",
    "parse_date", "normalize_date", "now_text",
    "scale", "status", "split_part", "strip_ns", "url_host",
]
