"""Small scalar helpers: URL parts, unit scaling, threshold status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_part(c, sep: str, index: int) -> Column:
    """0-based element of ``c`` split on the literal ``sep``; NULL if short.

    Trailing empty pieces are kept, as in ``str.split``.
    """
    import re
    return F.get(F.split(_c(c), re.escape(sep), -1), F.lit(index))


def url_host(c) -> Column:
    """Host part of an absolute URL (scheme://host[:port]/...)."""
    return F.regexp_extract(_c(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)", 1)


def scale(c, factor: float) -> Column:
    """Unit scaling, e.g. bytes / 2**30 -> GiB (factor = 1 / 2**30)."""
    return _c(c) * F.lit(factor)


def status(c, steps: Sequence[tuple[float | None, str]]) -> Column:
    """C20: threshold status from absolute steps.

    ``steps`` is ``[(None, base), (t1, s1), (t2, s2), ...]`` with increasing
    thresholds; a value >= t_i takes s_i (the highest one reached wins).
    NULL values give NULL.
    """
    c = _c(c)
    base = None
    ordered = []
    for thr, name in steps:
        if thr is None:
            base = name
        else:
            ordered.append((thr, name))
    ordered.sort(key=lambda s: s[0], reverse=True)
    expr = None
    for thr, name in ordered:
        cond = c >= F.lit(thr)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    out = F.lit(base) if expr is None else expr.otherwise(F.lit(base))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(out)


def strip_ns(c) -> Column:
    """C11: ``{namespace}tag`` -> ``tag``."""
    return F.regexp_replace(_c(c), r"^.*\}", "")
