"""From raw documents to packed sequences, in five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import language, packing, secrets, simhash, tiling
from wayfold.llm.batches import held_out
from wayfold.session import shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the table's own labels teach."""
    return language.in_known_language(docs, language.learn(docs.where(~held_out(F.col("doc_id")))))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link at two bits or fewer."""
    return simhash.one_of_each(docs, 3, 2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than half of every benchmark item."""
    return tiling.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup), ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets), ("pack", pack),
]
#: Fingerprints, tiles and token ids are beyond SQL; tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is a table in the shared folder."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
