"""Parquet tables of a data folder (``{sf_dir}/{name}.parquet``)."""

from pyspark.sql import DataFrame, SparkSession

from presslake.sinks.files import Files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Spark's splits decide how wide the scan is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a bounded stream of its files; a single file is followed in its folder."""
    folder, file = sf_dir.rstrip("/"), f"{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if Files(spark).is_file(f"{folder}/{file}"):
        return reader.option("pathGlobFilter", file).parquet(folder)
    return reader.parquet(f"{folder}/{file}")
