"""Document fingerprints: mergeable bottom-k sketches of shingle hashes, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.llm.common import WORD, lower_az, parts, require

K = 128
WORDS = 5
#: A hash value lies in 0 .. 2**48 - 1.
SPACE_BITS = 48
#: Documents that one sort by doc_id holds, about, and the most cut points for such sorts.
CELL_ROWS, MOST_CELLS = 512, 1 << 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def shingles(text: Column, size: int = WORDS) -> Column:
    """Hashes of the runs of `size` words of the text, A-Z lower-cased; fewer words: one hash of all; none: empty."""

    def of(words: Column) -> Column:
        n = F.size(words)
        runs = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[words[i + k] for k in range(size)]))
        return F.when(n >= size, runs).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<long>"))

    words = F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), 1)
    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def sketch(text: Column, k: int = K, size: int = WORDS) -> Column:
    """The k least distinct hash values, ascending; all of them if there are fewer."""
    values = F.transform(shingles(text, size), lambda h: F.shiftrightunsigned(h, 64 - SPACE_BITS))
    return F.slice(F.sort_array(F.array_distinct(values)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Jaccard likeness of the shingle sets, from the sketches; exact while both are whole. Two empty sets: 1."""
    return _let(
        merge(a, b, k),
        lambda u: F.when(F.size(u) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u)),
    )


def distinct(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is whole."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (F.element_at(a, k) / float(1 << SPACE_BITS)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds. a empty: 1."""
    share = resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda v: F.lpad(F.lower(F.hex(v)), SPACE_BITS // 4, "0")), "")


def fingerprint(documents: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text and `sketch` of every whole text. Null text: the empty sketch. Narrow: no shuffle."""
    return require(documents, "doc_id", "text").withColumn("sketch", sketch(F.col("text"), k))


def _cell(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most `key`, by binary search."""
    if not bounds:
        return F.lit(0)
    top = 1 << (len(bounds).bit_length() - 1)
    table = F.lit(bounds)
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])
    inside = lambda at, step: (at + step <= len(bounds)) & (F.try_element_at(table, at + step) <= key)
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.coalesce(inside(at, step), F.lit(False)), step).otherwise(0))


def with_next(rows: DataFrame, derived: dict[str, Column], columns: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """`rows` (doc_id, ...) with `derived` columns, and next_<column> of the following document by doc_id; after the last: the first.

    Rows are dealt into ranges of doc_id at approximate quantiles and each range is ordered on its own; the
    first row of the range after it is copied to its end. The derived columns are computed after the rows
    are dealt, so they aren't shuffled. Null doc_id comes first; rows of equal doc_id are ordered by a hash.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    cells = min(parts(rows.count(), cell_rows), MOST_CELLS)
    shares = [i / cells for i in range(1, cells)]
    bounds: list[int] = []
    if shares:
        bounds = sorted(set(rows.select(F.percentile_approx(key, shares, 10 * cells)).first()[0] or []))
    keyed = rows.withColumn("_key", key).withColumn("_cell", _cell(F.col("_key"), bounds))
    heads = keyed.groupBy("_cell").agg(F.min("_key").alias("_head"))
    order, everything = W.orderBy("_cell"), W.partitionBy()
    heads = heads.select("_head", F.coalesce(F.lag("_cell").over(order), F.max("_cell").over(everything)).alias("_to"))
    # There are MOST_CELLS heads at most.
    wanted = rows.withColumn("_key", key).join(F.broadcast(heads), F.col("_key") == F.col("_head"))
    tie = F.xxhash64(*rows.columns)
    wanted = wanted.groupBy("_to").agg(F.min_by(F.struct(*rows.columns, "_key"), tie).alias("r"))
    ends = wanted.select("r.*", F.col("_to").alias("_cell"), F.lit(1).alias("_end"))
    both = keyed.withColumn("_end", F.lit(0)).unionByName(ends).repartition("_cell")
    both = both.select("*", tie.alias("_tie"), *[c.alias(name) for name, c in derived.items()])
    after = W.partitionBy("_cell").orderBy("_end", "_key", "_tie")
    led = both.select("*", *[F.lead(c).over(after).alias(f"next_{c}") for c in columns])
    return led.where("_end = 0").drop("_key", "_cell", "_end", "_tie")


def against_next(documents: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each document (doc_id, text), of its edited text, and their likeness.

    Edited: the last half (rounded down) of its code points replaced by as many first ones of the next
    document by doc_id, or all it has. One shuffle carries the texts, by ranges of doc_id.

    Null text: as empty. Empty and short texts: see `shingles`. Null and repeated doc_id: see `with_next`;
    documents that share a doc_id are sorted in one task. Extra columns are left aside. No rows: none.
    Returns doc_id, n_chars, edited, sketch, edited_sketch, next_sketch.
    """
    docs = require(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    led = with_next(docs, {"sketch": sketch(F.col("text"), k)}, ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    out = led.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", F.col("next_sketch"))
    return out.withColumn("edited_sketch", sketch(F.col("edited"), k))


def digest(documents: DataFrame, k: int = K) -> DataFrame:
    near = against_next(documents, k)
    return near.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
