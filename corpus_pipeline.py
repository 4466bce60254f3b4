"""A training corpus from documents: identify the language, drop near duplicates, scrub personal data, mix the sources, pack."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import language, mixing, near_duplicates, packing, pii
from corvane.session import ensure_checkpoint_dir, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    taught = docs.where(~language.held_out(F.col("doc_id")))
    return language.keep_identified(docs, language.train(taught))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are alike by 0.8 or more, directly or through others, the one with the least doc_id stays."""
    return near_duplicates.drop_near_duplicates(docs, percent=80)


def scrub_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Addresses and numbers give way to tags."""
    return pii.scrub(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for."""
    return mixing.expand(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("pii", scrub_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenization and near-duplicate signatures are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the cluster's shared folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
