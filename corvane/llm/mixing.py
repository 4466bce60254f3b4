"""Mixing sources to target weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.llm.common import WORD, require
from corvane.session import cut

#: Weights of the sources by code point, null last, over and over.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Rows of a source that one rounding run holds, about.
CELL_ROWS = 4096
#: Sources up to which a table of one row per source (under 200 bytes) is broadcast; above, rows are joined by shuffle.
MOST_SOURCES = 50_000
#: Numbers of copies that are broadcast to their documents (about 100 bytes each); above, they are joined by shuffle.
MOST_BROADCAST_ROWS = 500_000


def _small(df: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(df) if sources <= MOST_SOURCES else df


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size to the same with `target`.

    Weighted shares of `share` times all sizes, none above `most` times its source's size, the excess
    reshared by weight. This water level L gives each source min(weight * L, most * size); with sources in
    order of size / weight, the capped ones are a prefix, so running sums find L without a loop. One row
    per source passes one task here, never documents.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("weight", F.element_at(choices, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * float(most)
    by_need = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    leveled = (
        named.withColumn("cap", cap)
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("pool", F.sum("source_size").over(everything) * float(share))
        .withColumn("level", (F.col("pool") - F.col("capped")) / F.col("open"))
        # Later levels are lower: the first source that its level doesn't fill sets the level of all after it.
        .withColumn("fits", F.col("weight") * F.col("level") <= F.col("cap"))
        .withColumn("found", F.max(F.when(F.col("fits"), F.col("level"))).over(everything))
    )
    level = F.coalesce(F.least(F.col("weight") * F.col("found"), F.col("cap")), F.col("cap"))
    return leveled.select("source", "source_size", level.alias("target"))


def balance(histogram: DataFrame, goals: DataFrame, most: float = MOST, sources: int = 1 << 62, tolerance: float = 1e-9, max_rounds: int = 60) -> DataFrame:
    """source, size, n and source, source_size, target to source, mean, tilt: one Newton step per distributed pass.

    The rates closest in relative entropy to an even base on 0..most, given a source's total, are
    most / (1 + exp(-tilt * size / mean size)). The dual is convex with one tilt per source; its gradient
    and curvature are sums over the histogram, which represents every document exactly. Steps that leave
    the bracket are bisected. Sources at 0 or at `most` times their size need no tilt (null).
    """
    start = goals.where("target > 0 and target < source_size * %r * (1 - 1e-12)" % float(most))
    mean = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    logit = F.log(F.col("target") / (float(most) * F.col("source_size") - F.col("target")))
    state = start.join(mean, start["source"].eqNullSafe(mean["source"])).select(
        start["source"], "mean", "source_size", "target", logit.alias("tilt"),
        F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(1.0).alias("miss"),
    )
    state = cut(state)
    for _ in range(max_rounds):
        x = F.col("size") / F.col("mean")
        rate = float(most) / (1 + F.exp(-F.col("tilt") * x))
        slope = rate * (1 - rate / float(most)) * x
        joined = histogram.join(_small(state.withColumnRenamed("source", "s"), sources), F.col("source").eqNullSafe(F.col("s")))
        sums = joined.groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("total"), F.sum(F.col("n") * F.col("size") * slope).alias("curve"),
            *[F.first(c).alias(c) for c in ("mean", "source_size", "target", "tilt", "low", "high")],
        )
        off = F.col("total") - F.col("target")
        bracket = sums.withColumn("low", F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn(
            "high", F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        )
        newton = F.col("tilt") - F.try_divide(off, F.col("curve"))
        safe = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise((F.col("low") + F.col("high")) / 2)
        miss = F.abs(off) / F.col("source_size")
        state = cut(bracket.select("source", "mean", "source_size", "target", F.when(miss == 0, F.col("tilt")).otherwise(safe).alias("tilt"), "low", "high", miss.alias("miss")))
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst < tolerance:
            break
    # Rounded, so that the order of floating-point sums can't move a document between reruns.
    return state.select("source", "mean", F.round("tilt", 6).alias("tilt"))


def mix(
    documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    seed: int = 5, cell_rows: int = CELL_ROWS, closeness: float = 1e-3, max_fixes: int = 12,
) -> DataFrame:
    """Copies of each document (doc_id, text, source) so that each source's words come near its target.

    Sizes are words. Rates from `balance`, then whole copies: within runs of about `cell_rows` rows of a
    source, largest documents first, the fractional parts of the rates are accumulated and a copy falls where
    the sum passes a whole number, so errors cancel between documents of like size. While a source is off by
    more than `closeness` of its target, the one document whose copy more or less helps most is changed, at
    most `max_fixes` times (large sources need none). Newton steps end at `balance`'s `tolerance` or after its `max_rounds`; copies
    are set right either way. A source whose documents are all too large to come nearer stays off by less than its smallest one.

    A hot source is cut into many runs; what passes one task is one row per source. Null source: a source
    of its own, last. Null or empty text: size 0, rate 0. Repeated rows: each is a document. Ties: by doc_id.
    Extra columns are left aside. No documents: no rows.
    Returns doc_id, source, size, source_size, target, copies.
    """
    docs = require(documents, "doc_id", "text", "source").select("doc_id", "source", words(F.col("text")).alias("size"))
    docs = cut(docs)
    histogram = cut(docs.groupBy("source", "size").agg(F.count("*").alias("n")))
    sizes = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    goals = targets(sizes.select("source", "source_size"), weights, share, most)
    goals = cut(goals.alias("g").join(sizes.alias("z"), F.col("g.source").eqNullSafe(F.col("z.source"))).select("g.source", "g.source_size", "target", "rows"))
    sources = goals.count()
    tilts = balance(histogram, goals, most, sources).withColumnRenamed("source", "s")
    plan = goals.join(tilts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    # Sources that take nothing or everything have no tilt.
    tilted = float(most) / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean")))
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("tilt").isNotNull(), tilted).when(F.col("target") > 0, float(most)).otherwise(0.0)
    salt = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.ceil(F.col("rows") / cell_rows))
    rated = docs.join(_small(plan, sources), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", rate.alias("rate"), salt.alias("cell")
    )
    order = W.partitionBy("source", "cell").orderBy(F.desc("size"), "doc_id")
    run, before = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    part = F.col("rate") - F.floor("rate")
    offset = F.pmod(F.xxhash64(F.lit(seed), "source", "cell"), F.lit(1 << 20)) / float(1 << 20)
    dealt = (
        rated.withColumn("sum", F.sum(part).over(run) + offset)
        .withColumn("sum_before", F.coalesce(F.sum(part).over(before), F.lit(0.0)) + offset)
        .withColumn("copies", F.floor("rate") + F.floor("sum") - F.floor("sum_before"))
        .withColumn("copies", F.greatest(F.lit(0), F.least(F.lit(most), F.col("copies"))).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )
    return _fix(cut(dealt), most, sources, closeness, max_fixes)


def _fix(dealt: DataFrame, most: int, sources: int, closeness: float, max_fixes: int) -> DataFrame:
    for _ in range(max_fixes):
        taken = dealt.groupBy("source").agg(
            F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("goal"), F.max("size").alias("largest")
        )
        off = taken.withColumn("off", F.col("taken") - F.col("goal")).where(F.abs("off") > closeness * F.col("goal"))
        off = cut(off.select(F.col("source").alias("s"), "off"))
        if off.isEmpty():
            break
        here = F.col("source").eqNullSafe(F.col("s"))
        step = F.when(F.col("off") > 0, -1).otherwise(1)
        movable = (F.col("size") > 0) & (F.col("copies") + step).between(0, most)
        left = F.abs(F.col("off") + step * F.col("size"))
        best = (
            dealt.join(_small(off, sources), here)
            .where(movable & (left < F.abs("off")))
            .groupBy("source")
            .agg(F.min(F.struct(left.alias("left"), "size", "copies", "doc_id", step.alias("step"))).alias("best"))
            .select(F.col("source").alias("s"), "best.*")
        )
        best = cut(best.select("s", F.col("doc_id").alias("d"), F.col("size").alias("z"), F.col("copies").alias("c"), "step"))
        if best.isEmpty():
            break
        # One row of several equal ones: the first by number among them.
        same = W.partitionBy("source", "doc_id", "size", "copies").orderBy(F.lit(0))
        hit = here & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z")) & (F.col("copies") == F.col("c"))
        chosen = dealt.join(_small(best, sources), hit, "left_semi").withColumn("turn", F.row_number().over(same))
        chosen = chosen.join(_small(best, sources), hit).withColumn("copies", F.col("copies") + F.when(F.col("turn") == 1, F.col("step")).otherwise(0))
        dealt = cut(dealt.join(_small(best, sources), hit, "left_anti").unionByName(chosen.select(*dealt.columns)))
    return dealt


def expand(documents: DataFrame, **options) -> DataFrame:
    """documents with each row as many times as `mix` takes it, none where it takes none.

    Copies belong to doc_id, source and size; rows that share all three, and only these, are told apart by the
    order of their texts. All others meet their number of copies in one join, without a shuffle of the texts
    while there are at most MOST_BROADCAST_ROWS numbers. Null or empty text: no copies. Null doc_id or source:
    as any other value. All columns are kept, whatever their names. No documents: no rows.
    """
    plan = mix(documents, **options)
    names = {"doc_id": "_mix_id", "source": "_mix_source", "size": "_mix_size"}
    key, short = list(names), list(names.values())
    plan = cut(plan.select(*[F.col(old).alias(new) for old, new in names.items()], F.col("copies").alias("_mix_copies")))
    seen = plan.groupBy(*short).agg(F.count("*").alias("_mix_rows"), F.max("_mix_copies").alias("_mix_copies"))
    single = seen.where("_mix_rows = 1 and _mix_copies > 0")
    turn = F.row_number().over(W.partitionBy(*short).orderBy(F.desc("_mix_copies")))
    several = seen.where("_mix_rows > 1").select(*short)
    same_plan = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in short]
    dealt = plan.alias("a").join(several.alias("b"), reduce(and_, same_plan), "left_semi").withColumn("_mix_turn", turn)

    # A row's columns stay together, so that their names clash with none here.
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole")
    rows = documents.select(whole, *key[:2], words(F.col("text")).alias("size"))
    here = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(key, short, strict=True)]
    few = plan.count() <= MOST_BROADCAST_ROWS
    small = F.broadcast if few else lambda df: df
    alone = rows.join(small(single), reduce(and_, here))
    order = F.row_number().over(W.partitionBy(*key).orderBy("whole.text"))
    shared = rows.join(small(several), reduce(and_, here), "left_semi").withColumn("_turn", order)
    shared = shared.join(dealt, reduce(and_, [*here, F.col("_turn") == F.col("_mix_turn")])).where("_mix_copies > 0")
    taken = alone.select("whole", "_mix_copies").unionByName(shared.select("whole", "_mix_copies"))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))).select("whole.*")
