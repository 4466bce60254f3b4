"""Speaker activity of whole episodes: checks, chunks, and summaries per speech span."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.operators.intervals import range_join

SPEAKERS = 8
STEP = 160
RATE = 16_000
#: Frames of a stored chunk, 30 s.
CHUNK = 3000


def checked(probabilities: np.ndarray, step: int = STEP) -> np.ndarray:
    """Frames by speakers, finite and within 0 to 1."""
    p = np.asarray(probabilities, np.float32)
    if p.ndim != 2 or p.shape[1] != SPEAKERS or step != STEP or not np.isfinite(p).all() or (p < 0).any() or (p > 1).any():
        raise ValueError("diarization must be frames by 8 probabilities, a frame each 160 samples")
    return p


def chunks(probabilities: np.ndarray, start: int = 0):
    """(first sample, sample after the last, frames) of at most CHUNK frames."""
    for i in range(0, len(probabilities), CHUNK):
        part = probabilities[i : i + CHUNK]
        yield start + i * STEP, start + (i + len(part)) * STEP, part


def frames_of(stored: DataFrame) -> DataFrame:
    """(episode, a, p array<array<float>>) chunks to one row per frame."""
    one = stored.select("episode", F.col("a").alias("first"), F.posexplode("p").alias("i", "p"))
    return one.select("episode", (F.col("first") + F.col("i") * STEP).alias("a"), "p")


def summarize(spans: DataFrame, frames: DataFrame, threshold: float = 0.5) -> DataFrame:
    """spans (episode, begin, finish) with speakers, overlap and turns relative to the span.

    A frame is clipped to the span; a speaker's consecutive frames are one turn; turns are sorted by start
    and speaker. All frames of a span must tile it: a tail of under one frame gets review metadata and a
    forced cut, any other gap an error. An episode that uses all speakers marks its spans as at capacity.
    """
    tagged = frames.withColumn("b", F.col("a") + STEP)
    tagged = tagged.withColumn("who", F.filter(F.transform("p", lambda x, i: F.when(x > threshold, i)), lambda i: i.isNotNull()))
    whole = tagged.groupBy("episode").agg(F.max("b").alias("covered_end"), F.size(F.array_distinct(F.flatten(F.collect_set("who")))).alias("used"))
    met = range_join(spans, tagged.drop("p"), CHUNK * STEP)
    key = ["episode", "begin", "finish"]
    size = F.col("hi") - F.col("lo")
    covered = met.groupBy(*key).agg(F.sum(size).alias("covered"), F.coalesce(F.sum(F.when(F.size("who") >= 2, size)), F.lit(0)).alias("shared"))
    active = met.withColumn("speaker", F.explode("who")).withColumn("frame", F.expr(f"a div {STEP}"))
    island = F.col("frame") - F.row_number().over(W.partitionBy(*key, "speaker").orderBy("frame"))
    turns = active.withColumn("island", island).groupBy(*key, "speaker", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    at = lambda c: ((F.col(c) - F.col("begin")) / RATE)
    turn = F.struct(at("lo").alias("start"), at("hi").alias("end"), F.concat(F.lit("speaker_"), F.col("speaker").cast("string")).alias("speaker"))
    by_start = lambda x, y: F.when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).when(x["speaker"] < y["speaker"], -1).when(x["speaker"] > y["speaker"], 1).otherwise(0)
    turns = turns.groupBy(*key).agg(F.array_sort(F.collect_list(turn), by_start).alias("speaker_turns"), F.countDistinct("speaker").alias("diar_speakers"))
    out = spans.join(covered, key, "left").join(turns, key, "left").join(whole, "episode", "left")
    length = F.col("finish") - F.col("begin")
    tail = F.col("finish") - F.coalesce("covered_end", F.lit(0))
    exact = F.coalesce(F.col("covered") == length, F.lit(False))
    short = ~exact & (tail > 0) & (tail < STEP) & (F.coalesce("covered", F.lit(0)) == length - tail)
    none = F.array().cast(turns.schema["speaker_turns"].dataType)
    return out.select(
        *key,
        F.when(exact, F.coalesce("diar_speakers", F.lit(0))).alias("diar_speakers"),
        F.when(exact, F.col("shared") / length).alias("overlap_ratio"),
        F.when(exact, F.col("shared") / RATE).alias("overlap_seconds"),
        F.when(exact, F.coalesce("speaker_turns", none)).alias("speaker_turns"),
        (F.coalesce("used", F.lit(0)) >= SPEAKERS).alias("speaker_capacity_reached"),
        F.when(short, tail).alias("unscored_tail_samples"),
        F.when(short, "review").when(exact, "ok").alias("diarization_status"),
        short.alias("boundary_cut"),
        F.when(~exact & ~short, "incomplete_diarization_coverage").alias("error"),
    )
