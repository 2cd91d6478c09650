"""Article messages: encode to JSON bytes, decode with a fixed schema
(K1, P1, P2, P9, C16, C17). Works on batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.schemas import ARTICLE_SCHEMA


def encode_messages(articles: DataFrame, fields: list[str] | None = None,
                    timestamp_col: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Record -> UTF-8 JSON ``value`` (non-ASCII kept, NULL fields omitted).

    Output ``(value binary[, timestamp])``, the layout a message sink takes.
    """
    fields = fields or [c for c in ARTICLE_SCHEMA.fieldNames() if c in articles.columns]
    cols = [F.to_json(F.struct(*fields)).cast("binary").alias("value")]
    if timestamp_col:
        cols.append(F.col(timestamp_col).alias("timestamp"))
    cols += [F.col(k) for k in keep]
    return articles.select(*cols)


def decode_messages(messages: DataFrame, schema: T.StructType = ARTICLE_SCHEMA,
                    keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """``value`` bytes -> schema fields + ``kafka_timestamp``.

    Permissive: malformed JSON gives all-NULL fields (the row is kept; the
    silver filter drops it); fields outside the schema are dropped;
    wrong-typed values keep their JSON text.
    """
    extra = [F.col(k) for k in keep if k in messages.columns]
    return (messages
            .select(F.from_json(F.col("value").cast("string"), schema).alias("data"),
                    F.col("timestamp").alias("kafka_timestamp"), *extra)
            .select("data.*", "kafka_timestamp", *[k for k in keep if k in messages.columns]))


CORRUPT = "_corrupt_record"


def reject_reason(text, corrupt):
    """Why a message's text is no record, NULL if it is one: ``null``, ``empty``, or ``malformed`` (not one JSON object)."""
    return (F.when(text.isNull(), F.lit("null")).when(text.rlike(r"^\s*$"), F.lit("empty"))
            .when(corrupt.isNotNull(), F.lit("malformed")))


def decode_or_reject(messages: DataFrame, schema: T.StructType = ARTICLE_SCHEMA, keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """:func:`decode_messages` with ``reason`` and ``value_text``: both NULL for a record, else why it is none and its text."""
    kept = [k for k in keep if k in messages.columns]
    record = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = messages.select(F.col("value").cast("string").alias("_text"), F.col("timestamp").alias("kafka_timestamp"), *kept)
    parsed = parsed.withColumn("data", F.from_json("_text", record, {"columnNameOfCorruptRecord": CORRUPT}))
    reason = reject_reason(F.col("_text"), F.col(f"data.{CORRUPT}"))
    return parsed.select(*[F.col(f"data.{f}").alias(f) for f in schema.fieldNames()], "kafka_timestamp", *kept,
                         reason.alias("reason"), F.when(reason.isNotNull(), F.col("_text")).alias("value_text"))


def message_rejects(messages: DataFrame, schema: T.StructType = ARTICLE_SCHEMA, keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Dead letters ``(kafka_timestamp, offset, reason, value_text)``: every message that is no record, with its text."""
    rows = decode_or_reject(messages, schema, keep)
    return rows.where(F.col("reason").isNotNull()).select("kafka_timestamp", *[k for k in keep if k in rows.columns], "reason", "value_text")


def to_bronze(messages: DataFrame, schema: T.StructType = ARTICLE_SCHEMA,
              ingestion_time=None) -> DataFrame:
    """Decode + ingestion stamp (P3). ``ingestion_time`` fixes the stamp."""
    stamp = F.current_timestamp() if ingestion_time is None else F.lit(ingestion_time).cast("timestamp")
    return decode_messages(messages, schema).withColumn("ingestion_time", stamp)
