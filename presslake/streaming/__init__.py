"""Structured Streaming jobs: messages -> bronze -> silver."""

from presslake.streaming.dedup import first_arrivals
from presslake.streaming.epochs import read_counts
from presslake.streaming.layers import (
    bronze_stream, compact_seen, dedup_stream, read_rejects, run_available_now, silver_stream,
    start_bronze, start_gold_stream, start_silver, start_silver_table_dedup, trigger_kwargs,
)

__all__ = ["bronze_stream", "compact_seen", "dedup_stream", "first_arrivals", "read_counts", "read_rejects",
           "run_available_now", "silver_stream", "start_bronze", "start_gold_stream", "start_silver",
           "start_silver_table_dedup", "trigger_kwargs"]
