"""Intervals on a sample timebase: range joins, overlap, runs of activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def range_join(spans: DataFrame, chunks: DataFrame, width: int, key: str = "episode") -> DataFrame:
    """Pairs of spans [begin, finish) and chunks [a, b) of one key that overlap, with their intersection [lo, hi).

    Both sides are dealt into buckets of `width` along the key, so a long episode is many small equi-joins;
    a pair that shares several buckets is kept in the one where its intersection begins. Any lengths are
    right; `width` near the usual length moves fewest rows. Empty intervals meet nothing.
    """
    bucket = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor((F.col(hi) - 1) / width)))
    left = spans.where("finish > begin").withColumn("bucket", bucket("begin", "finish"))
    right = chunks.where("b > a").withColumn("bucket", bucket("a", "b"))
    met = left.join(right, [key, "bucket"]).where("a < finish and b > begin")
    met = met.withColumn("lo", F.greatest("begin", "a")).withColumn("hi", F.least("finish", "b"))
    return met.where(F.floor(F.col("lo") / width) == F.col("bucket")).drop("bucket")


def runs(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Maximal runs of equal values along `order` within a key: key, value, first, last, n."""
    along = W.partitionBy(key).orderBy(order)
    new = F.when(F.lag(value).over(along).eqNullSafe(F.col(value)) & F.lag(order).over(along).isNotNull(), 0).otherwise(1)
    numbered = rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(along.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(key, value, "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("_run")


def turns(active: DataFrame, key: str = "span", step: int = 160) -> DataFrame:
    """Speaker turns in samples from active frames (key, speaker, frame): consecutive frames of a speaker are one turn."""
    along = W.partitionBy(key, "speaker").orderBy("frame")
    island = F.col("frame") - F.row_number().over(along)
    found = active.withColumn("_i", island).groupBy(key, "speaker", "_i").agg(F.min("frame").alias("f"), F.max("frame").alias("l"))
    return found.select(key, "speaker", (F.col("f") * step).alias("start"), ((F.col("l") + 1) * step).alias("end"))


def overlap(spans: DataFrame, frames: DataFrame, threshold: float = 0.5, step: int = 160, width: int = 480_000) -> DataFrame:
    """Per span [begin, finish): samples covered by frames, samples with two or more active speakers, speakers, ratio.

    frames: episode, a (first sample), p (probability by speaker). A span that its frames don't tile exactly
    gets error `incomplete_diarization_coverage`.
    """
    n = F.size(F.filter("p", lambda x: x >= threshold))
    chunks = frames.withColumn("b", F.col("a") + step).withColumn("n", n)
    met = range_join(spans, chunks, width)
    size = F.col("hi") - F.col("lo")
    speakers = F.flatten(F.collect_set(F.filter(F.transform("p", lambda x, i: F.when(x >= threshold, i)), lambda i: i.isNotNull())))
    found = met.groupBy("episode", "begin", "finish").agg(
        F.sum(size).alias("covered_samples"), F.coalesce(F.sum(F.when(F.col("n") >= 2, size)), F.lit(0)).alias("overlap_samples"),
        F.size(F.array_distinct(speakers)).alias("diar_speakers"),
    )
    found = spans.join(found, ["episode", "begin", "finish"], "left")
    length = F.col("finish") - F.col("begin")
    whole = F.col("covered_samples").eqNullSafe(length)
    return found.withColumn("overlap_ratio", F.when(whole, F.col("overlap_samples") / length)).withColumn(
        "error", F.when(~whole, "incomplete_diarization_coverage")
    )
