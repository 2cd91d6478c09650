"""Gold counts (A1-A5, T1, P4): four count tables from one scan of silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Gold table names, their grouping keys and count column.
GOLD_TABLES = {
    "articles_par_jour": (("date_parsed",), "nombre_articles"),
    "articles_par_source": (("source",), "nombre_articles"),
    "top_categories": (("categorie_clean",), "total"),
    "articles_par_source_jour": (("source", "date_parsed"), "nombre_articles"),
}
GOLD_KEYS = ("date_parsed", "source", "categorie_clean")


def _gid(keys: tuple[str, ...]) -> int:
    """``grouping_id()`` of a grouping set over GOLD_KEYS (bit set = absent)."""
    gid = 0
    for k in GOLD_KEYS:
        gid = (gid << 1) | (0 if k in keys else 1)
    return gid


def gold_one_pass(silver: DataFrame) -> DataFrame:
    """A5: all four counts in one scan: GROUPING SETS over day, source,
    category and source x day, tagged by ``grouping_id``.

    Plan: one file scan reading three columns -> Expand -> partial hash
    aggregate -> one shuffle -> final aggregate. NULL keys stay their own
    group (``grouping_id`` separates them from rolled-up columns).
    """
    sets = [list(keys) for keys, _ in GOLD_TABLES.values()]
    return (silver.select(*GOLD_KEYS)
            .groupingSets(sets, *GOLD_KEYS)
            .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))


def split_gold(one_pass: DataFrame, run_ts=None) -> dict[str, DataFrame]:
    """Slice the one-pass result into the four tables; one shared run stamp."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    out = {}
    for name, (keys, count_col) in GOLD_TABLES.items():
        out[name] = (one_pass.filter(F.col("gid") == _gid(keys))
                     .select(*keys, F.col("n").alias(count_col), stamp.alias("processing_time")))
    return out


def gold_counts(silver: DataFrame, run_ts=None, reliable: bool = True) -> dict[str, DataFrame]:
    """The four gold tables, computed by one aggregation.

    The aggregated result (one row per group, far smaller than silver) is
    checkpointed to the cluster's checkpoint folder so the four writes
    neither rescan silver nor depend on executor-local cache blocks.
    """
    one = gold_one_pass(silver)
    if reliable:
        one = one.checkpoint(eager=True)
    return split_gold(one, run_ts)


def count_by(silver: DataFrame, keys: tuple[str, ...], count_col: str = "nombre_articles") -> DataFrame:
    """A1-A4 individually (one aggregate per table)."""
    return silver.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def top_categories(silver_or_counts: DataFrame, k: int | None = None, with_rank: bool = False) -> DataFrame:
    """Categories by count, descending; ties by name. With ``k`` this is a
    top-k (TakeOrderedAndProject), otherwise a distributed range sort.
    ``with_rank`` stores the position as ``rang`` (the order of a table is
    lost once written), computed without a single-partition window."""
    from presslake.operators.ranking import global_row_number

    df = silver_or_counts
    if "total" not in df.columns:
        df = count_by(df, ("categorie_clean",), "total")
    order = [F.col("total").desc(), F.col("categorie_clean").asc_nulls_last()]
    if with_rank:
        df = global_row_number(df, order, "rang")
        if k is not None:
            df = df.filter(F.col("rang") <= k)
        return df.orderBy("rang")
    ordered = df.orderBy(*order)
    return ordered.limit(k) if k is not None else ordered
