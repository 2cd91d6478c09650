"""The training-data pipeline over ``documents``: each stage calls one operator of ``presslake.llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from presslake.llm.common import read, shared_path
from presslake.llm.mixing import mixed
from presslake.llm.packing import pack
from presslake.llm.quality import allowed_rows, fit, keep_good
from presslake.llm.secrets import redact_secrets
from presslake.llm.simhash import keep_one


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below a half go."""
    return keep_good(docs, fit(docs, read(spark, sf_dir, "labels"), allowed_rows()))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within 3 bits stays: the smallest id's."""
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to their kind in brackets; every document stays."""
    return redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target weight takes it."""
    return mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, their sequences and places there, and the ids themselves."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return pack(docs, vocabulary, with_ids=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: A trained classifier, fingerprints, draws and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
