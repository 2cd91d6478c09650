"""Layer and state readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.schemas import STATE_SCHEMA
from presslake.sinks.seen import SeenTable


class SilverMissing(RuntimeError):
    """The silver layer path does not exist or holds no committed data."""


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver Parquet. A streaming sink folder is read through its commit
    log, so only committed files are visible."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise SilverMissing(f"silver layer not readable at {path}: {e}") from e


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system that its URL names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """D3: the URLs earlier runs have tried; empty before the first run. A folder
    that is there but cannot be read is an error, not an empty set."""
    return SeenTable(spark, path).read()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The current mark per source from the append-only state log
    ``(source, last_date, run_ts)``; empty when nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    log = spark.read.schema("source string, last_date string, run_ts timestamp").option("recursiveFileLookup", "true").parquet(path)
    return (log.groupBy("source")
            .agg(F.max_by("last_date", "run_ts").alias("last_date")))
