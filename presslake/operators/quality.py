"""Layer inspection (A6, K7, T2, U4) returned as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(silver: DataFrame, key: str = "url", date_col: str = "date_parsed",
            title_col: str = "titre_clean") -> DataFrame:
    """One row of counts: rows, NULL dates, empty titles, duplicate keys."""
    return silver.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(date_col).isNull()).alias("n_null_date"),
        F.count_if(F.coalesce(F.col(title_col), F.lit("")) == "").alias("n_empty_title"),
        (F.count(F.col(key)) - F.count_distinct(F.col(key))).alias("n_duplicate_key"),
    )


def schema_rows(df: DataFrame):
    """K7: the schema as (column, type) rows (small, driver-side by nature)."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def latest_rows(df: DataFrame, order: Sequence[str], n: int = 5,
                columns: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` most recent rows by ``order`` (all descending; the last
    column should be a unique tiebreak). A top-k, not a full sort."""
    out = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return out.select(*columns) if columns else out
