"""Named queries that run the library's jobs and streams over whole tables, and return what these have written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.jobs import run_gold, run_ingest
from presslake.operators.gold import GOLD_TABLES
from presslake.operators.messages import decode_messages
from presslake.plans import fixtures as FX
from presslake.plans.queries import article_messages, events_silver, incremental_listing, marks
from presslake.schemas import SILVER_COLUMNS
from presslake.session import new_path
from presslake.sinks.writers import GoldTarget, register_gold, write_messages, write_state
from presslake.sources.layers import read_silver, read_state
from presslake.sources.messages import read_messages
from presslake.sources.tables import table
from presslake.streaming.epochs import read_counts
from presslake.streaming.layers import bronze_stream, run_available_now, start_bronze, start_silver_table_dedup


def _message_stream(spark: SparkSession, sf: str, out: str) -> DataFrame:
    write_messages(article_messages(spark, sf), f"{out}/messages")
    return read_messages(spark, f"{out}/messages")


def _silver(spark: SparkSession, path: str) -> DataFrame:
    return read_silver(spark, path).select(*[c for c in SILVER_COLUMNS if c != "ingestion_time"])


def _run_once(spark: SparkSession, sf: str) -> str:
    """One bounded run of both layers over published messages, with counts, dead letters and late rows."""
    out = new_path(spark, "stream")
    run_available_now(spark, _message_stream(spark, sf, out), f"{out}/bronze", f"{out}/silver", f"{out}/state",
                      counts_path=f"{out}/counts", rejects_path=f"{out}/rejects", late_path=f"{out}/late")
    return out


def q_stream_silver(spark, sf):
    """Messages published, followed into bronze and on into silver, and silver read back."""
    return _silver(spark, f"{_run_once(spark, sf)}/silver")


def q_stream_counts(spark, sf):
    """What the epochs of such a run have counted, by layer."""
    counts = read_counts(spark, f"{_run_once(spark, sf)}/counts")
    return counts.groupBy("query").agg(F.sum("n").alias("n"))


def q_stream_silver_table(spark, sf):
    """Bronze de-duplicated against the table of admitted urls, in two runs of the stream of which the second has
    only messages that the first has had."""
    out = new_path(spark, "stream-table")
    for run in range(2):
        messages = _message_stream(spark, sf, out)
        start_bronze(messages, f"{out}/bronze", f"{out}/state/bronze", "available_now").awaitTermination()
        start_silver_table_dedup(bronze_stream(spark, f"{out}/bronze"), f"{out}/silver", f"{out}/seen",
                                 f"{out}/state/silver", "available_now").awaitTermination()
    return _silver(spark, f"{out}/silver")


def q_job_gold(spark, sf):
    """The gold job over a silver layer; its four tables read back, by name, with the run's stamp."""
    out = new_path(spark, "gold")
    events_silver(spark, sf).write.parquet(f"{out}/silver")
    run_gold(spark, f"{out}/silver", GoldTarget(kind="parquet", path=f"{out}/gold"), FX.AS_OF, register=False)
    names = register_gold(spark, {n: spark.read.parquet(f"{out}/gold/{n}") for n in GOLD_TABLES}, prefix="job_gold_")
    rows = None
    for name, (keys, count_col) in zip(names, GOLD_TABLES.values()):
        cols = [F.col(c) if c in keys else F.lit(None).cast("date" if c == "date_parsed" else "string").alias(c)
                for c in ("date_parsed", "source", "categorie_clean")]
        one = spark.table(name).select(F.lit(name.removeprefix("job_gold_")).alias("gold_table"), *cols, F.col(count_col).alias("n"),
                                       F.date_format("processing_time", "yyyy-MM-dd HH:mm:ss").alias("stamp"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def q_job_ingest(spark, sf):
    """An ingest run and its rerun; every message and failed item with its copies, and the marks."""
    out = new_path(spark, "ingest")
    write_state(marks(spark), f"{out}/state", "2000-01-01 00:00:00")
    for attempt in range(2):
        run_ingest(spark, incremental_listing(spark, sf), table(spark, sf, "pages"), f"{out}/messages", f"{out}/state",
                   FX.AS_OF, quarantine_path=f"{out}/quarantine")
    messages = decode_messages(read_messages(spark, f"{out}/messages", streaming=False))
    failed = spark.read.parquet(f"{out}/quarantine")
    items = messages.select(F.lit("message").alias("kind"), "source", F.col("url").alias("value")).unionByName(
        failed.select(F.lit("failure").alias("kind"), "source", F.col("url").alias("value")))
    state = read_state(spark, f"{out}/state").select(F.lit("mark").alias("kind"), "source", F.col("last_date").alias("value"))
    return items.unionByName(state).groupBy("kind", "source", "value").agg(F.count("*").alias("n"))


JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_silver": q_stream_silver,
    "stream_counts": q_stream_counts,
    "stream_silver_table": q_stream_silver_table,
    "job_gold": q_job_gold,
    "job_ingest": q_job_ingest,
}
