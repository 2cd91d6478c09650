"""Batch sinks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_messages(messages: DataFrame, path: str | None = None, kind: str = "files",
                   topic: str = "news_articles", bootstrap_servers: str | None = None) -> None:
    """K1: publish ``(value[, timestamp, offset])``. Kafka: no key, one record
    per row. Files: Parquet appended under ``path`` (a message folder a
    file-stream source can follow)."""
    if kind == "kafka":
        (messages.select("value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
    elif kind == "files":
        messages.write.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown message sink {kind!r}")


def state_rows(state: DataFrame, run_ts: str) -> DataFrame:
    """K6: the new marks as rows of the state log, of which the latest run's counts."""
    return state.select("source", "last_date", F.lit(run_ts).cast("timestamp").alias("run_ts"))


def write_state(state: DataFrame, path: str, run_ts: str) -> None:
    """K6: append the new marks to the state log. Each run commits its own
    files, so a crash leaves the previous mark readable; call it only
    after the messages of the run are published."""
    state_rows(state, run_ts).write.mode("append").parquet(path)


@dataclass
class GoldTarget:
    """Where gold tables go.

    * ``kind="jdbc"``: ``url`` + ``properties`` (user, password, driver);
      overwrite drops and recreates, ``truncate=True`` keeps the table
      definition (and grants) and only empties it.
    * ``kind="parquet"``: one folder per table under ``path``.
    * ``kind="table"``: managed tables in ``database`` (``saveAsTable``).
    """
    kind: str = "parquet"
    path: str | None = None
    url: str | None = None
    properties: dict = field(default_factory=dict)
    database: str | None = None
    truncate: bool = False


def write_gold(tables: dict[str, DataFrame], target: GoldTarget) -> None:
    """K4: overwrite every gold table, in as many parts as its rows have
    (adaptive execution joins small ones)."""
    for name, out in tables.items():
        if target.kind == "jdbc":
            (out.write.mode("overwrite").option("truncate", str(target.truncate).lower())
             .jdbc(target.url, name, properties=target.properties))
        elif target.kind == "parquet":
            out.write.mode("overwrite").parquet(f"{target.path.rstrip('/')}/{name}")
        elif target.kind == "table":
            full = f"{target.database}.{name}" if target.database else name
            out.write.mode("overwrite").saveAsTable(full)
        else:
            raise ValueError(f"unknown gold target {target.kind!r}")


def register_gold(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """K8: expose gold tables by name to SQL (``spark.sql('select * from top_categories')``)."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
