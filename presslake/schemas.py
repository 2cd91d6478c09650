"""Logical schemas of the layers."""

from pyspark.sql import types as T

_S = T.StringType()

ARTICLE_FIELDS = ["titre", "auteur", "date_publication", "categorie", "contenu", "source", "url"]

# Message payload. The NOT NULL flags are documentation only: JSON decoding
# makes every field nullable; the silver filter is the real guard.
ARTICLE_SCHEMA = T.StructType([T.StructField(f, _S, True) for f in ARTICLE_FIELDS])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("offset", T.LongType()),
])

BRONZE_SCHEMA = T.StructType(ARTICLE_SCHEMA.fields + [
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ingestion_time", T.TimestampType()),
])

#: Dead letters beside bronze.
REJECT_SCHEMA = T.StructType([
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ingestion_time", T.TimestampType()),
    T.StructField("reason", _S),
    T.StructField("value_text", _S),
])

SILVER_COLUMNS = ["url", "titre_clean", "auteur_clean", "categorie_clean", "date_parsed",
                  "source", "contenu_clean", "ingestion_time"]

LISTING_SCHEMA = T.StructType([
    T.StructField("position", T.LongType()),
    T.StructField("loc", _S),
    T.StructField("pub_date", _S),
])

STATE_SCHEMA = T.StructType([
    T.StructField("source", _S),
    T.StructField("last_date", _S),
])

METRIC_SAMPLE_SCHEMA = T.StructType([
    T.StructField("metric", _S),
    T.StructField("labels", T.MapType(_S, _S)),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])
