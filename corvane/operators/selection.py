"""Selecting records: exact duplicates, counts, review samples and calibration against human labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions.hashing import seeded


def first_accepted_wins(decided: DataFrame, key: str = "pcm_sha256", order: str = "seq", id_: str = "id") -> DataFrame:
    """Among accepted rows with equal key the first by `order` stays accepted; the others are rejected and name it.

    decided: id, key, order, status, reasons. Only accepted rows are shuffled by key; null keys are never equal.
    """
    kept = decided.where((F.col("status") == "accept") & F.col(key).isNotNull())
    rest = decided.where(~F.coalesce((F.col("status") == "accept") & F.col(key).isNotNull(), F.lit(False)))
    winners = kept.groupBy(key).agg(F.min_by(F.struct(F.col(order).alias("o"), F.col(id_).alias("i")), F.col(order)).alias("first"))
    told = kept.join(winners, key)
    lost = F.col(order) != F.col("first.o")
    told = told.withColumn("reasons", F.when(lost, F.array(F.concat(F.lit("exact_pcm_duplicate:"), F.col("first.i").cast("string")))).otherwise(F.col("reasons")))
    told = told.withColumn("status", F.when(lost, "reject").otherwise(F.col("status")))
    return told.select(*decided.columns).unionByName(rest)


def counts_by(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(column, n) for each of the values, zero where there is none."""
    named = rows.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return named.join(rows.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def review_sample(rows: DataFrame, strata: Sequence[str], per_group: int = 20, seed: str = "0", id_: str = "id") -> DataFrame:
    """The `per_group` rows of each stratum with the least seeded hash of the id, in order."""
    if per_group < 1:
        raise ValueError("per_group must be at least 1")
    ranked = rows.withColumn("digest", seeded(seed, F.col(id_).cast("string")))
    order = W.partitionBy(*strata).orderBy("digest", id_)
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_group)


def check_labels(labels: DataFrame, records: DataFrame, id_: str = "id") -> None:
    """Every label must name a record, once."""
    if not labels.join(records, id_, "left_anti").isEmpty():
        raise ValueError("a label names an unknown record")
    if not duplicate_ids(labels, id_).isEmpty():
        raise ValueError("a record has several labels")


def duplicate_ids(rows: DataFrame, id_: str = "id") -> DataFrame:
    return rows.groupBy(id_).agg(F.count("*").alias("n")).where("n > 1")


def stale_labels(labels: DataFrame, records: DataFrame, id_: str = "id") -> DataFrame:
    """Labels whose source, samples or input aren't those of the record now."""
    both = labels.alias("l").join(records.alias("r"), id_)
    same = F.lit(True)
    for name in ("source_sha256", "pcm_sha256"):
        same &= F.col(f"l.{name}").isNotNull() & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return both.where(~(same & F.col("l.input").eqNullSafe(F.col("r.input")))).select(id_)


def calibration(labelled: DataFrame, cell: Sequence[str], seconds: str = "duration_s") -> DataFrame:
    """Confusion of decisions (status) with human labels (human_label) per cell, with rates; null on zero denominators."""
    good = labelled.where(F.col("human_label").isin("accept", "reject"))
    accepted, rejected = F.col("status") == "accept", F.col("human_label") == "reject"
    cells = good.groupBy(*cell).agg(
        F.count("*").alias("labels"),
        F.count_if(~rejected).alias("human_accept"),
        F.count_if(rejected).alias("human_reject"),
        F.count_if(accepted).alias("accepted"),
        F.count_if(accepted & rejected).alias("false_accept"),
        F.count_if((F.col("status") == "reject") & ~rejected).alias("false_reject"),
        F.count_if(F.col("status").isin("review", "error")).alias("review_or_error"),
        F.coalesce(F.sum(F.when(accepted, F.col(seconds))), F.lit(0.0)).alias("accepted_seconds"),
    )
    return cells.withColumn("accept_precision", F.try_divide(F.col("accepted") - F.col("false_accept"), F.col("accepted"))).withColumn(
        "false_accept_rate", F.try_divide(F.col("false_accept"), F.col("human_reject"))
    )


def source_changes(decided: DataFrame, now: DataFrame) -> DataFrame:
    """Errors where a source's hash isn't what was scored; a record that has an error keeps its own. decided: audio, source_sha256, status, reasons; now: audio, sha256."""
    both = decided.join(now.select(F.col("audio").alias("_a"), F.col("sha256").alias("_now")), F.col("audio") == F.col("_a"), "left")
    why = F.when(F.col("_now").isNull(), "source_unavailable_since_scoring").when(F.col("_now") != F.col("source_sha256"), "source_changed_since_scoring")
    changed = why.isNotNull() & (F.col("status") != "error")
    return both.withColumn("reasons", F.when(changed, F.array(why)).otherwise(F.col("reasons"))).withColumn(
        "status", F.when(changed, "error").otherwise(F.col("status"))
    ).select(*decided.columns)
