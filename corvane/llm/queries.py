"""The queries of this folder's operators over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import ann, fingerprints, language, lm_scoring, mixing, near_duplicates, packing, pii, sharding, url_filters
from corvane.llm.oracles import ORACLES as ORACLES
from corvane.session import table


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.learn_and_identify(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.components(table(spark, sf_dir, "documents"), percent=85)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.interleave(table(spark, sf_dir, "documents"))
    none = F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filters, op2_nearest, op3_pii, op4_packing, op5_mixing, op6_lm_scoring, op7_language, op8_near_duplicates, op9_sharding, op10_fingerprints)}
