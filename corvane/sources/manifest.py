"""Manifests: JSON lines with an open schema around a validated core."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.policy import KINDS, LANGUAGES

_TEXTS = ("id", "audio", "language", "kind", "reference_text", "source_id", "speaker_id", "reference_audio")
_SECONDS = ("start", "end", "reference_start", "reference_end")
_SAMPLES = ("start_sample", "end_sample", "timebase_hz")


def problems(value: Column, languages: Sequence[str] = LANGUAGES, kinds: Sequence[str] = KINDS) -> Column:
    """The first thing wrong with a manifest row given as a variant, or null."""
    get = lambda key, kind: F.try_variant_get(value, f"$.{key}", kind)
    # The type as written: true is not a number and 1.0 is not an integer. Absent keys and JSON nulls have no type.
    kind = lambda key: F.schema_of_variant(F.try_variant_get(value, f"$.{key}", "variant"))
    is_ = lambda key, pattern: F.coalesce(kind(key).rlike(pattern), F.lit(False))
    present = lambda key: F.coalesce(kind(key) != "VOID", F.lit(False))
    text, number, whole = "^STRING$", "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "^(BIGINT|DECIMAL\\(\\d+,0\\))$"
    checks: list[tuple[Column, str]] = [(value.isNull(), "not a JSON object")]
    checks += [(~is_(k, text) | (get(k, "string") == ""), f"{k} must be a non-empty string") for k in ("id", "audio", "language")]
    checks.append((~get("language", "string").isin(*languages), "unknown language"))
    checks.append((present("kind") & ~F.coalesce(get("kind", "string").isin(*kinds), F.lit(False)), "unknown kind"))
    checks.append((present("reference_text") & ~is_("reference_text", text), "reference_text must be a string"))
    unread = F.coalesce(get("reference_text", "string"), F.lit("")) == ""
    checks.append((F.coalesce(get("kind", "string") == "synthetic", F.lit(False)) & unread, "synthetic rows need reference_text"))
    checks.append((present("boundary_cut") & ~is_("boundary_cut", "^BOOLEAN$"), "boundary_cut must be true or false"))
    for k in _SECONDS:
        bad = ~is_(k, number) | F.isnan(get(k, "double")) | (F.abs(get(k, "double")) == float("inf"))
        checks.append((present(k) & bad, f"{k} must be a finite number"))
    for k in ("source_id", "speaker_id", "reference_audio"):
        checks.append((present(k) & (~is_(k, text) | (get(k, "string") == "")), f"{k} must be a non-empty string"))
    some = F.lit(False)
    every = F.lit(True)
    for k in _SAMPLES:
        some, every = some | present(k), every & is_(k, whole)
    a, b, hz = (get(k, "long") for k in _SAMPLES)
    checks.append((some & ~every, "start_sample, end_sample and timebase_hz are integers and come together"))
    checks.append((some & ~((a >= 0) & (a < b) & (hz > 0)), "samples must satisfy 0 <= start < end"))
    for k, sample in (("start", a), ("end", b)):
        checks.append((some & present(k) & (F.abs(get(k, "double") - F.try_divide(sample, hz)) > 1e-8), f"{k} differs from its sample"))
    found = F.lit(None).cast("string")
    for bad, why in reversed(checks):
        found = F.when(F.coalesce(bad, F.lit(False)), why).otherwise(found)
    return found


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): the file's lines in order, from 1. The one place where order comes from the file itself."""
    lines = spark.read.text(path).rdd.zipWithIndex().map(lambda x: (x[1] + 1, x[0][0]))
    return spark.createDataFrame(lines, "line long, value string")


def parse(lines: DataFrame, languages: Sequence[str] = LANGUAGES, kinds: Sequence[str] = KINDS) -> DataFrame:
    """(line, value) to typed columns, `input` (the text as read) and `problem`; blank lines are left out.

    `seq` is the line number, which grows in manifest order. All other keys stay readable in `input`.
    """
    rows = lines.where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    get = lambda key, kind: F.try_variant_get("v", f"$.{key}", kind).alias(key)
    typed = [get(k, "string") for k in _TEXTS if k != "kind"] + [get(k, "double") for k in _SECONDS] + [get(k, "long") for k in _SAMPLES]
    kind = F.coalesce(F.try_variant_get("v", "$.kind", "string"), F.lit("podcast")).alias("kind")
    cut = F.coalesce(F.try_variant_get("v", "$.boundary_cut", "boolean"), F.lit(False)).alias("boundary_cut")
    return rows.select(F.col("line").alias("seq"), *typed, kind, cut, F.col("value").alias("input"), problems(F.col("v"), languages, kinds).alias("problem"))


def read(spark: SparkSession, path: str, languages: Sequence[str] = LANGUAGES, kinds: Sequence[str] = KINDS) -> DataFrame:
    """The manifest's rows; ValueError at the first bad line or at repeated ids."""
    rows = parse(numbered(spark, path), languages, kinds)
    first = rows.where("problem is not null").orderBy("seq").select("seq", "problem").first()
    if first:
        raise ValueError(f"{path}:{first['seq']}: {first['problem']}")
    if twice := rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").first():
        raise ValueError(f"{path}: id {twice['id']} occurs {twice['n']} times")
    return rows.drop("problem")


def bounds(duration: Column) -> tuple[Column, Column]:
    """Start and end in seconds: samples first, then seconds, then the whole source."""
    at = lambda sample: F.try_divide(F.col(sample), F.col("timebase_hz"))
    return F.coalesce(at("start_sample"), "start", F.lit(0.0)), F.coalesce(at("end_sample"), "end", duration)
