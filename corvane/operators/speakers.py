"""Speaker similarity: each distinct reference is embedded once, vectors are compared as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.numeric import cosine

KEY = ("reference_sha256", "reference_start", "reference_end")


def embed_references(rows: DataFrame, embed: Callable[[dict], list[float]]) -> DataFrame:
    """rows (with KEY) and `reference_embedding`; `embed` sees each distinct reference once. Rows without one keep null."""
    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in KEY)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(reference_embedding=[embed(r) for r in pdf.to_dict("records")])

    distinct = rows.where("reference_sha256 is not null").select(*KEY).distinct()
    found = distinct.mapInPandas(run, f"{fields}, reference_embedding array<float>").alias("f")
    same = F.lit(True)
    for c in KEY:
        same &= F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
    return rows.alias("r").join(found, same, "left").select("r.*", "f.reference_embedding")


def compare(rows: DataFrame) -> DataFrame:
    """rows (embedding, windows array<array<float>>, reference_embedding) with similarity, consistency and their status.

    Consistency is the mean cosine of neighbouring windows, null under two windows, which calls for review.
    """
    neighbours = F.zip_with(F.slice("windows", 1, F.size("windows") - 1), F.slice("windows", 2, F.size("windows") - 1), lambda a, b: cosine(a, b))
    n = F.size("windows")
    mean = F.aggregate(neighbours, F.lit(0.0), lambda s, v: s + v) / (n - 1)
    return rows.select(
        "*",
        F.when(F.col("reference_embedding").isNotNull(), cosine(F.col("embedding"), F.col("reference_embedding"))).alias("speaker_similarity"),
        F.when(n >= 2, mean).alias("speaker_consistency"),
        F.col("reference_embedding").isNotNull().alias("speaker_reference_available"),
        F.when(n >= 2, "ok").otherwise("review").alias("speaker_status"),
    )
