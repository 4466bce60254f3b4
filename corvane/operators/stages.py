"""Resumable stages: what is pending, and folding stage results into records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pending(base: DataFrame, results: DataFrame, stage: str, languages: Sequence[str] | None = None, retry_errors: bool = False, id_: str = "id") -> DataFrame:
    """Rows of base without error or silence that have no result of the stage, or, retrying, only a failed one."""
    done = results.where(F.col("stage") == stage)
    if retry_errors:
        done = done.where(F.col("error").isNull())
    rows = base.where(F.col("error").isNull() & ~F.coalesce(F.col("silent"), F.lit(False)))
    if languages is not None:
        rows = rows.where(F.col("language").isin(*languages))
    return rows.join(done.select(id_), id_, "left_anti")


def latest(results: DataFrame, id_: str = "id", order: str = "attempt") -> DataFrame:
    """The last attempt of each record and stage."""
    best = results.groupBy(id_, "stage").agg(F.max_by(F.struct(*[c for c in results.columns if c not in (id_, "stage")]), order).alias("r"))
    return best.select(id_, "stage", "r.*")


def by_stage(a: Column, b: Column) -> Column:
    """An order for array_sort of structs with a stage, which may hold maps."""
    return F.when(a["stage"] < b["stage"], -1).when(a["stage"] > b["stage"], 1).otherwise(0)


def fold(base: DataFrame, results: DataFrame, id_: str = "id") -> DataFrame:
    """base with stages (map stage to struct(status, seconds)), metrics (map, later stages by name win) and error.

    results: id, stage, metrics map<string,double>, error, seconds. Errors are the base's and then the
    stages' in order of name, joined by "; ".
    """
    status = F.when(F.col("error").isNull(), "ok").otherwise("error")
    one = F.struct("stage", status.alias("status"), "seconds", "error", "metrics")
    by = results.groupBy(id_).agg(F.array_sort(F.collect_list(one), by_stage).alias("all"))
    stages = F.map_from_entries(F.transform("all", lambda s: F.struct(s["stage"], F.struct(s["status"].alias("status"), s["seconds"].alias("seconds")))))
    good = F.filter("all", lambda s: s["error"].isNull() & s["metrics"].isNotNull())
    entries = F.flatten(F.transform(good, lambda s: F.map_entries(s["metrics"])))
    merged = F.aggregate(entries, F.create_map().cast("map<string,double>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.map_from_entries(F.array(e))))
    errors = F.filter(F.transform("all", lambda s: s["error"]), lambda e: e.isNotNull())
    joined = F.array_join(F.concat(F.array_compact(F.array("error")), F.coalesce(errors, F.array().cast("array<string>"))), "; ")
    return base.join(by, id_, "left").select(
        *[c for c in base.columns if c != "error"], F.when(joined != "", joined).alias("error"), stages.alias("stages"), merged.alias("metrics")
    )


def agreed(identities: Sequence[str], now: str) -> None:
    """Outputs of different models or settings must not be mixed."""
    if any(i != now for i in identities):
        raise ValueError("run identity changed")


def with_flags(stages: Column) -> Column:
    """Names of the stages that are ok, from the folded map."""
    return F.map_keys(F.map_filter(stages, lambda k, v: v["status"] == "ok"))
