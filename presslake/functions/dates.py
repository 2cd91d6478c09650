"""Date handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import WS, let

# Fixed value: the normalisation pattern, a date and a time of day joined by
# "T" or whitespace; digits are Unicode decimal digits.
NORM_RE = r"(\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2})[T" + WS + r"](\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2})"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c) -> Column:
    """ISO text (with or without offset) -> timestamp; anything else -> NULL.

    ``try_to_timestamp`` keeps the permissive behaviour under Spark 4's ANSI
    default, where ``to_timestamp`` raises on bad input.
    """
    return F.try_to_timestamp(_c(c))


def parse_date(c) -> Column:
    """C5+C6: text -> date in the session time zone (UTC in this library)."""
    return F.to_date(parse_timestamp(c))


def normalize_date(c) -> Column:
    """First ``YYYY-MM-DD[T ]HH:MM:SS`` as ``YYYY-MM-DD HH:MM:SS`` (offset
    dropped); text without such a match is returned unchanged."""
    def rule(v):
        return F.when(
            F.regexp_extract(v, NORM_RE, 0) != "",
            F.concat(F.regexp_extract(v, NORM_RE, 1), F.lit(" "), F.regexp_extract(v, NORM_RE, 2)),
        ).otherwise(v)
    return let(c, rule)


ISO = "iso"


def now_text(fmt: str = "yyyy-MM-dd HH:mm:ss", as_of=None) -> Column:
    """The run clock as text. ``as_of`` (a timestamp string) makes runs
    reproducible; without it the query's current timestamp is used.
    ``fmt="iso"`` is ISO 8601 with microseconds, omitted when zero."""
    ts = F.current_timestamp() if as_of is None else F.to_timestamp(F.lit(as_of))
    if fmt == ISO:
        return F.when(F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return F.date_format(ts, fmt)
