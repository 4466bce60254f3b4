"""Streams give what batches give."""

import numpy as np
from pyspark.sql import functions as F

from corvane.operators import vad
from corvane.streaming.sessions import activity_stream, sessions


def test_activity_across_micro_batches(spark, tmp_path):
    rng = np.random.default_rng(5)
    p = {e: np.clip(rng.normal(0.5, 0.4, 90), 0, 1).round(3).tolist() for e in ("a", "b")}
    frames = "episode string, frame long, p double, last boolean"
    for k in range(3):
        rows = [(e, i, v, i == 89) for e, ps in p.items() for i, v in enumerate(ps) if 30 * k <= i < 30 * k + 30]
        spark.createDataFrame(rows, frames).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(frames).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    out = activity_stream(stream, speech=1024).writeStream.format("memory").queryName("spans").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination(120)
    got = {(r["episode"], r["begin"], r["finish"], r["cut"]) for r in spark.table("spans").collect()}
    assert got == {(e, *s) for e, ps in p.items() for s in vad.spans_of(ps, speech=1024)} and got


def test_sessions_batch(spark):
    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:20:00", 2.0), (1, "2024-01-01 02:00:00", 4.0)]
    found = sessions(spark.createDataFrame(rows, "user_id long, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp")))
    assert sorted((r["n_events"], r["total_value"]) for r in found.collect()) == [(1, 4.0), (2, 3.0)]
