"""Structured Streaming front ends: sessions of events, and voice activity with state across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators.vad import Activity


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user (user_id, ts, value): start, end, events, total. Batch or stream; late events past the watermark are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    found = timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n_events"), F.sum("value").alias("total_value"))
    return found.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", "total_value")


def activity_stream(frames: DataFrame, **options) -> DataFrame:
    """A stream of (episode string, frame long, p double, last boolean) to speech spans, in any micro-batches.

    Frames of an episode must arrive in order; its state is a few numbers and goes when `last` is seen.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else None
        now = Activity(**options)
        if kept:
            now.position, start, quiet, now.continued = kept
            now.start, now.quiet = (None if start < 0 else start), (None if quiet < 0 else quiet)
        rows = pd.concat(list(batches)).sort_values("frame")
        found = list(now.feed(rows["p"].tolist()))
        if rows["last"].any():
            found += list(now.finish(now.position))
            state.remove()
        else:
            start, quiet = (-1 if x is None else x for x in (now.start, now.quiet))
            state.update((now.position, start, quiet, now.continued))
        yield pd.DataFrame([(key[0], a, b, c) for a, b, c in found], columns=["episode", "begin", "finish", "cut"])

    return frames.groupBy("episode").applyInPandasWithState(
        run, "episode string, begin long, finish long, cut boolean", "position long, start long, quiet long, continued boolean", "append", "NoTimeout"
    )
