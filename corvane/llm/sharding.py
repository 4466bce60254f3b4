"""Sharding by proportional stratified interleaving, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.llm.common import parts, require

SHARDS = 16
#: Rows that one sort of a rank holds, about.
CELL_ROWS = 4096


def _offsets(counts: DataFrame, within: list[str]) -> DataFrame:
    """Cells with their counts n to cells with the rows before them (first) and in all (total)."""
    before = W.partitionBy(*within).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*within)
    return counts.select(
        *within, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(whole).alias("total")
    )


def interleave(documents: DataFrame, shards: int = SHARDS, seed: int = 11, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Deal documents (doc_id, text, source) into shards of equal row counts, each with the corpus's mixture.

    1. Shuffle each source by a seeded hash of doc_id and rank it. 2. The fractional rank (rank - 1/2) / rows
    of the source spreads every source evenly over 0 to 1. 3. Sort all rows by it and cut the order into
    `shards` runs whose counts are at most one apart (law `rows`); a run holds each source in its share.

    Neither a source nor the corpus is sorted in one task: both ranks are taken within cells (of the hash,
    then of the fractional rank) of about `cell_rows` rows, plus the counts of the cells before. Only small
    columns are shuffled. Null source: a source of its own. Null text: size 1, CRC of no bytes. Null or
    repeated doc_id: ordered by the text's CRC and size after the hash; rows equal in all of these take
    neighbouring places in any order. Equal texts are not kept together (law `rows` allows no such promise).
    Extra columns are left aside. No documents: no rows.
    Returns doc_id, size, text_crc32, source, shard, slot.
    """
    docs = require(documents, "doc_id", "text", "source")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    cells = parts(docs.count(), cell_rows)
    # Eight hexadecimal digits of the hash, scaled to the number of cells.
    cell = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(cells) / F.lit(1 << 32))
    keyed = docs.withColumn("key", key).withColumn("cell", cell)
    ranks = _offsets(keyed.groupBy("source", "cell").agg(F.count("*").alias("n")), ["source"])
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = keyed.select(
        "doc_id", "source", "key", "cell", (F.octet_length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32")
    )
    order = ["key", "doc_id", "text_crc32", "size"]
    local = F.row_number().over(W.partitionBy("source", "cell").orderBy(*order))
    ranked = rows.withColumn("local", local).alias("r").join(
        ranks.alias("o"), F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("r.cell") == F.col("o.cell"))
    )
    place = ((F.col("first") + F.col("local")) * 2 - 1).cast("double") / (F.col("total") * 2).cast("double")
    placed = ranked.select("r.doc_id", "r.source", "key", "size", "text_crc32", place.alias("place"))
    placed = placed.withColumn("cell", F.least(F.floor(F.col("place") * cells), F.lit(cells - 1)))
    sums = _offsets(placed.groupBy("cell").agg(F.count("*").alias("n")), [])
    local = F.row_number().over(W.partitionBy("cell").orderBy("place", F.col("source").asc_nulls_last(), *order))
    at = placed.withColumn("local", local).join(sums, "cell").withColumn("at", F.col("first") + F.col("local") - 1)
    # Row `at` of `total` goes to shard floor(at * shards / total); that shard begins at ceil(shard * total / shards).
    shard = F.expr(f"at * {shards} div total")
    return at.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "source", F.col("shard").cast("int").alias("shard"),
        (F.col("at") - F.expr(f"(shard * total + {shards - 1}) div {shards}")).alias("slot"),
    )
