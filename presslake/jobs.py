"""Job entry points any scheduler can call.

Each job is idempotent for a given run timestamp: gold overwrites its
tables, the ingest commits all that it writes at once, the streaming run
resumes from its checkpoints.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.extract import PROFILE_SEG3, Profile
from presslake.operators.gold import gold_counts
from presslake.operators.incremental import IncrementResult, advance_state, newest_by_source, run_incremental
from presslake.operators.messages import encode_messages
from presslake.operators.quality import latest_rows, profile, schema_rows
from presslake.session import ensure_checkpoint_dir
from presslake.sinks.files import STAGING, Files
from presslake.sinks.seen import SeenTable
from presslake.sinks.writers import GoldTarget, register_gold, state_rows, write_gold
from presslake.sources.layers import read_silver, read_state
from presslake.streaming.layers import run_available_now


def run_gold(spark: SparkSession, silver_path: str, target: GoldTarget, run_ts: str,
             register: bool = True) -> dict[str, DataFrame]:
    """Silver -> four gold tables in one aggregation -> overwrite."""
    tables = gold_counts(read_silver(spark, silver_path), run_ts=run_ts)
    write_gold(tables, target)
    if register:
        register_gold(spark, tables)
    return tables


@dataclass
class SilverReport:
    schema: DataFrame
    counts: DataFrame
    latest: DataFrame


def verify_silver(spark: SparkSession, silver_path: str, n: int = 5) -> SilverReport:
    """U4: schema, quality counts and the ``n`` latest rows of silver."""
    s = read_silver(spark, silver_path)
    return SilverReport(schema_rows(s), profile(s),
                        latest_rows(s, ["ingestion_time", "url"], n,
                                    ["source", "titre_clean", "auteur_clean", "date_parsed"]))


class Ingest:
    """The commit of ingest runs: what a run writes is staged out of sight, one small marker file commits it, then it is published.

    A crash before the marker leaves only staged folders, which the rerun writes anew; a crash after it is made up for by the
    next run, which first publishes what the marker lists. Publishing is renaming a folder, or adding an epoch to a seen
    table, and doing either again changes nothing. So readers see committed runs only, each once.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: int):
        self.spark, self.files, self.run_id = spark, Files(spark), run_id
        self.markers = f"{path.rstrip('/')}/_runs"
        self.steps: list[dict] = []

    def committed(self) -> bool:
        return self.files.exists(f"{self.markers}/{self.run_id}.done")

    def stage(self, rows: DataFrame, path: str, kind: str = "folder") -> None:
        staged = f"{path.rstrip('/')}/{STAGING}/run={self.run_id}" if kind == "folder" else f"{path.rstrip('/')}-staged/run={self.run_id}"
        rows.write.mode("overwrite").parquet(staged)
        self.steps.append({"kind": kind, "staged": staged, "path": path, "run": self.run_id})

    def commit(self) -> None:
        self.files.write_text(f"{self.markers}/{self.run_id}.json", json.dumps(self.steps))
        self.recover()

    def recover(self) -> None:
        """Publish whatever committed runs have not published yet."""
        for name in sorted(n for n in self.files.names(self.markers) if n.endswith(".json") and not n.startswith("_")):
            for step in json.loads(self.files.read_text(f"{self.markers}/{name}")):
                if step["kind"] == "folder":
                    self.files.publish(step["staged"], f"{step['path'].rstrip('/')}/run={step['run']}")
                elif self.files.exists(step["staged"]):
                    SeenTable(self.spark, step["path"]).add(self.spark.read.parquet(step["staged"]), step["run"])
                    self.files.delete(step["staged"])
            self.files.publish(f"{self.markers}/{name}", f"{self.markers}/{name[:-5]}.done")


def run_ingest(spark: SparkSession, listing: DataFrame, pages: DataFrame, message_path: str,
               state_path: str | None, run_ts: str, profile_: Profile = PROFILE_SEG3, source: str | None = None,
               *, quarantine_path: str, seen_path: str | None = None, mode: str = "timestamp",
               media_filter: bool = False, require_date: bool = True) -> IncrementResult | None:
    """U5 + K1 + K6 + F5 + F6 + F9: one incremental run.

    A dated listing advances the mark in ``state_path``; a polled one
    (``seen_path``, usually with ``media_filter`` and ``require_date=False``) takes
    each URL once and marks every tried URL as seen, failed ones too. Successes and
    failures come from one checkpoint, so they agree.

    Messages, quarantine, seen URLs and the mark are one commit (:class:`Ingest`, its markers beside the quarantine) under ``run=<digits of run_ts>``: however
    often and wherever a run dies, its rerun leaves exactly one copy of each. A run of a ``run_ts`` that is
    committed does nothing and returns None. Nothing is written when there is nothing new.
    """
    ensure_checkpoint_dir(spark)
    run = Ingest(spark, quarantine_path, int(re.sub(r"[^0-9]", "", run_ts)))
    run.recover()
    if run.committed():
        return None
    state = read_state(spark, state_path) if state_path else None
    seen = SeenTable(spark, seen_path) if seen_path else None
    res = run_incremental(listing, pages, state, seen, profile=profile_, source=source, as_of=run_ts, mode=mode,
                          media_filter=media_filter, require_date=require_date)
    rows = res.rows.checkpoint(eager=True)
    articles, failures = rows.filter(F.col("error").isNull()).drop("error"), rows.filter(F.col("error").isNotNull())
    summary = newest_by_source(articles, mode)
    new_state = advance_state(state, summary, mode) if state is not None else \
        summary.select("source", F.col("newest_date").alias("last_date"))
    res = IncrementResult(rows, articles, failures, summary, new_state)
    if not failures.isEmpty():
        run.stage(failures, quarantine_path)
    published = not articles.isEmpty()
    if published:
        msgs = encode_messages(articles, timestamp_col=None).withColumn("timestamp", F.lit(run_ts).cast("timestamp"))
        run.stage(msgs.withColumn("offset", F.lit(None).cast("long")), message_path)
    if seen_path and not rows.isEmpty():
        run.stage(rows.select("url").distinct(), seen_path, "seen")
    if state_path and published:
        run.stage(state_rows(res.state, run_ts), state_path)
    if run.steps:
        run.commit()
    return res


def run_streaming_once(spark: SparkSession, messages: DataFrame, bronze_path: str, silver_path: str,
                       checkpoint_root: str, mode: str = "global"):
    """R9/R11 bounded form: drain what is available into bronze, then silver."""
    return run_available_now(spark, messages, bronze_path, silver_path, checkpoint_root, mode)
