"""Leakage-safe splits: records that share any key stay together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.hashing import seeded, split
from corvane.operators.groups import connected_components


def record_keys() -> F.Column:
    """Grouping keys of a record: audio and sample hashes, and source, speaker and reference where they exist."""
    named = [("audio", "source_sha256"), ("pcm", "pcm_sha256"), ("source", "source_id"), ("speaker", "speaker_id"), ("audio", "reference_sha256")]
    return F.array_compact(F.array(*[F.concat(F.lit(f"{prefix}:"), F.col(c).cast("string")) for prefix, c in named]))


def grouped(rows: DataFrame, keys: F.Column, id_: str = "id") -> DataFrame:
    """rows with root, the least key reachable through shared keys, and group_id, its hash.

    Each row links its least key to its others, so the graph has as many edges as rows have keys.
    """
    keyed = rows.select(id_, F.array_sort(F.array_distinct(keys)).alias("k"))
    first = F.element_at("k", 1)
    edges = keyed.select(first.alias("a"), F.explode(F.slice("k", 2, 1 << 30)).alias("b"))
    roots = connected_components(edges)
    named = rows.withColumn("_first", F.element_at(F.array_sort(keys), 1)).join(roots, F.col("_first") == F.col("node"), "left")
    root = F.coalesce("component", "_first")
    return named.withColumn("root", root).withColumn("group_id", F.sha2(root.cast("binary"), 256)).drop("_first", "node", "component")


def assign(rows: DataFrame, seed: str = "0", train: float = 0.9, validation: float = 0.05) -> DataFrame:
    """rows (group_id) with split, the same for a whole group."""
    return rows.withColumn("split", split(seeded(seed, F.col("group_id")), train, validation))
