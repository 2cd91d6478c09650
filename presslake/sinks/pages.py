"""Captured pages laid out so that scans split and prune (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.scalars import url_host

#: Bytes a row group holds at most, but for one page and the rows between two checks.
GROUP_BYTES = 16 << 20
#: Rows between two looks at a row group's size: pages are wide.
CHECK_ROWS = 8


def write_pages(pages: DataFrame, path: str, files: int | None = None, group_bytes: int = GROUP_BYTES,
                mode: str = "errorifexists") -> None:
    """Write pages sorted by ``(host, url, page_id)`` in row groups of bounded bytes.

    A scan of the result splits between row groups however few files there are, and filters on ``host`` or
    ``url`` skip the groups whose statistics exclude them. ``files`` is the number of ranges, one file each
    (default: the session's shuffle partitions, merged by AQE). A hot host is cut between its urls; equal rows are cut
    by their place in the input, so none of them must meet in one task. All columns are kept and ``host`` (NULL
    where the url has none) is added; NULL urls come first, no rows give a table of none. A column named ``host`` is refused.
    """
    clash = [c for c in pages.columns if c.lower() in ("host", "_place")]
    if clash:
        raise ValueError(f"the layout adds its own column: {clash}")
    order = ["host", "url", "page_id", "_place"]
    rows = pages.withColumn("host", url_host("url")).withColumn("_place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    (rows.sortWithinPartitions(*order).drop("_place").write.mode(mode)
     .option("parquet.block.size", group_bytes).option("parquet.page.size.row.check.min", CHECK_ROWS)
     .option("parquet.page.size.row.check.max", CHECK_ROWS).parquet(path))
