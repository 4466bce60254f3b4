"""The library's operators over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions import dsp, numeric, text
from corvane.functions.hashing import seeded, split, threshold
from corvane.operators import intervals, policy, selection, splits, stages, vad
from corvane.session import table
from corvane.sources import manifest
from corvane.streaming.sessions import sessions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
LANGUAGES = ("en", "fr", "de", "es")

#: Bounds of the example policies; es is left uncalibrated on purpose.
POLICY = {"languages": {
    "en": {"duration_s": {"min": 1.0, "max": 60.0}, "reference_cer": {"max": 0.1}},
    "fr": {"duration_s": {"max": 40.0}},
    "de": {"reference_cer": {"max": 0.1}, "peak": {"min": 0.2}},
}}
PROFILE = {"profiles": {"asr": {"languages": {
    "en": {"podcast": {"avg_logprob": {"min": -1.0}, "compression_ratio": {"max": 2.4}}, "synthetic": {"reference_cer": {"max": 0.1}}},
    "fr": {"podcast": {"duration_s": {"max": 40.0}}},
}}}}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


NORMAL = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"


@query(f"SELECT doc_id, {NORMAL.format('text')} AS normalized FROM documents")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The tables' texts are in compatibility form already, so no Python is needed.
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.normalize(F.col("text")).alias("normalized"))


PAIRS = """
    SELECT conv_id, turn, ref, hyp FROM (
      SELECT conv_id, turn, {0} AS ref, lead({0}) OVER (PARTITION BY conv_id ORDER BY turn) AS hyp FROM conversations)
    WHERE hyp IS NOT NULL AND ref <> ''
""".format(NORMAL.format("text"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation with the next, as reference and hypothesis."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.normalize(F.col("text")).alias("ref"))
    pairs = turns.withColumn("hyp", F.lead("ref").over(W.partitionBy("conv_id").orderBy("turn")))
    return pairs.where(F.col("hyp").isNotNull() & (F.col("ref") != ""))


# DuckDB counts bytes: each of a pair's distinct characters becomes one byte there.
@query(f"""WITH c AS (SELECT conv_id, turn, string_split(replace(ref, ' ', ''), '') AS r, string_split(replace(hyp, ' ', ''), '') AS h FROM ({PAIRS})),
    k AS (SELECT *, list_distinct(list_concat(r, h)) AS known FROM c)
    SELECT conv_id, turn, round(levenshtein(
      array_to_string(list_transform(r, lambda x: chr((list_position(known, x) + 32)::INT)), ''),
      array_to_string(list_transform(list_filter(h, lambda x: x <> ''), lambda x: chr((list_position(known, x) + 32)::INT)), '')) / len(r)::DOUBLE, 6) AS cer
    FROM k""")
def cer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("conv_id", "turn", F.round(text.cer(F.col("ref"), F.col("hyp")), 6).alias("cer"))


@query()
def wer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("conv_id", "turn", F.round(text.wer(F.col("ref"), F.col("hyp")), 6).alias("wer"))


RECORDS = """
    SELECT d.doc_id, d.text, d.lang AS language, CASE WHEN d.doc_id % 3 = 0 THEN 'synthetic' ELSE 'podcast' END AS kind,
      CASE WHEN l.toxic = 1 THEN 'decode failed' END AS error, d.doc_id % 17 = 0 AS boundary_cut, d.n_chars < 60 AS silent,
      d.n_chars / 100.0::DOUBLE AS duration_s, 0.2::DOUBLE * (1 - l.quality) AS reference_cer,
      CASE WHEN d.doc_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE (d.doc_id % 10) / 10.0::DOUBLE END AS peak,
      CASE WHEN d.doc_id % 7 <> 0 THEN -0.25::DOUBLE * (d.doc_id % 8) END AS avg_logprob, (d.n_chars % 40) / 10.0::DOUBLE AS compression_ratio
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels seen as measured records."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    id_ = F.col("doc_id")
    return joined.select(
        "doc_id", "text", F.col("lang").alias("language"), F.when(id_ % 3 == 0, "synthetic").otherwise("podcast").alias("kind"),
        F.when(F.col("toxic") == 1, "decode failed").alias("error"), (id_ % 17 == 0).alias("boundary_cut"), (F.col("n_chars") < 60).alias("silent"),
        (F.col("n_chars") / 100.0).alias("duration_s"), (0.2 * (1 - F.col("quality"))).alias("reference_cer"),
        F.when(id_ % 11 == 0, float("nan")).otherwise((id_ % 10) / 10.0).alias("peak"),
        F.when(id_ % 7 != 0, -0.25 * (id_ % 8)).alias("avg_logprob"), ((F.col("n_chars") % 40) / 10.0).alias("compression_ratio"),
    )


def _sql_reasons(bounds: dict) -> tuple[str, str]:
    good = lambda m: f"({m} IS NOT NULL AND NOT isnan({m}) AND abs({m}) < 'inf'::DOUBLE)"
    out, missing = [], []
    for m, limits in bounds.items():
        over = " OR ".join(f"{m} {sign} {limits[end]}" for end, sign in (("min", "<"), ("max", ">")) if end in limits)
        out.append(f"CASE WHEN {good(m)} AND ({over}) THEN '{m}:outside_bounds' END")
        missing.append(f"CASE WHEN NOT coalesce({good(m)}, false) THEN '{m}:missing' END")
    return f"concat_ws(',', {', '.join(out)})", f"concat_ws(',', {', '.join(missing)})"


def _sql_decision(cells: dict[str, str], uncalibrated: str, language_mode: bool) -> tuple[str, str]:
    """status and reasons of the last rules; cells maps a condition to an id of its bounds' reasons."""
    status = "".join(f" WHEN {c} THEN CASE WHEN out{i} <> '' THEN 'reject' WHEN miss{i} <> '' THEN 'review' ELSE 'accept' END" for c, i in cells.items())
    reasons = "".join(f" WHEN {c} THEN concat_ws(',', nullif(out{i}, ''), nullif(miss{i}, ''))" for c, i in cells.items())
    first = "WHEN error IS NOT NULL THEN {0} WHEN boundary_cut THEN {1} WHEN silent THEN {2} WHEN norm = '' THEN {3}"
    assert language_mode
    return (
        "CASE " + first.format("'error'", "'review'", "'reject'", "'reject'") + status + " ELSE 'review' END",
        "CASE " + first.format("'error'", "'boundary_cut'", "'silent'", "'empty_transcript'") + reasons + f" ELSE '{uncalibrated}' END",
    )


def _decision_sql() -> str:
    columns, cells = [], {}
    for i, (language, bounds) in enumerate(POLICY["languages"].items()):
        out, miss = _sql_reasons(bounds)
        columns.append(f"{out} AS out{i}, {miss} AS miss{i}")
        cells[f"language = '{language}'"] = str(i)
    status, reasons = _sql_decision(cells, "language_not_calibrated", True)
    inner = f"SELECT *, {NORMAL.format('text')} AS norm, {', '.join(columns)} FROM ({RECORDS})"
    return f"SELECT doc_id, text, {status} AS status, {reasons} AS reasons FROM ({inner})"


DECISIONS = _decision_sql()


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy.validate_policy(POLICY, LANGUAGES)
    rows = _records(spark, sf_dir)
    found = policy.decision(POLICY, {c: F.col(c) for c in rows.columns}, text.kept(F.col("text")))
    return rows.withColumn("d", found).select("doc_id", "text", "language", "kind", "duration_s", "d.status", "d.reasons")


@query(f"SELECT doc_id, status, reasons FROM ({DECISIONS})")
def policy_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select("doc_id", "status", F.array_join("reasons", ",").alias("reasons"))


@query(f"""SELECT s.status, count(d.status) AS n FROM (VALUES ('accept'), ('reject'), ('review'), ('error')) s(status)
    LEFT JOIN ({DECISIONS}) d USING (status) GROUP BY s.status""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.counts_by(_decided(spark, sf_dir), "status", policy.STATUSES)


def _profile_sql() -> str:
    stages_ = "CASE WHEN doc_id % 5 = 0 THEN 'alignment_qwen:missing_stage' END, CASE WHEN doc_id % 13 = 0 THEN 'asr:missing_stage' END"
    flags = "CASE WHEN doc_id % 19 = 0 THEN 'alignment_requires_review' END, CASE WHEN boundary_cut THEN 'boundary_cut' END"
    columns, status, reasons = [], "", ""
    for i, (language, kind, bounds) in enumerate((x, k, b) for x, by in PROFILE["profiles"]["asr"]["languages"].items() for k, b in by.items()):
        out, miss = _sql_reasons(bounds)
        extra = []
        if not {"reference_cer", "reference_wer"} & bounds.keys():
            extra.append("CASE WHEN referenced THEN 'reference_agreement_bound_required' END")
        if not {"avg_logprob", "compression_ratio"} <= bounds.keys():
            extra.append("CASE WHEN NOT referenced THEN 'untranscribed_asr_bounds_required' END")
        columns.append(f"{out} AS out{i}, {miss} AS miss{i}, concat_ws(',', {', '.join([stages_, flags, *extra])}) AS more{i}")
        here = f"language = '{language}' AND kind = '{kind}'"
        inner = f"CASE WHEN boundary_cut THEN 'boundary_cut' WHEN norm = '' THEN 'empty_transcript' ELSE concat_ws(',', nullif(out{i}, ''), nullif(miss{i}, '')) END"
        rejected = f"NOT boundary_cut AND (norm = '' OR out{i} <> '')"
        reasons += f" WHEN {here} THEN concat_ws(',', nullif({inner}, ''), nullif(more{i}, ''))"
        status += f" WHEN {here} THEN CASE WHEN {rejected} THEN 'reject' WHEN {inner} <> '' OR more{i} <> '' THEN 'review' ELSE 'accept' END"
    named = f"SELECT *, kind = 'synthetic' AS referenced, {NORMAL.format('text')} AS norm FROM ({RECORDS})"
    first = "WHEN error IS NOT NULL THEN 'error' WHEN silent THEN {0}"
    return f"""SELECT doc_id, CASE {first.format("'reject'")} {status} ELSE 'review' END AS status,
        CASE {first.format("'silent'")} {reasons} ELSE 'language_source_profile_not_calibrated' END AS reasons
        FROM (SELECT *, {', '.join(columns)} FROM ({named}))"""


@query(_profile_sql())
def profile_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy.validate_profiles(PROFILE, LANGUAGES)
    rows, id_ = _records(spark, sf_dir), F.col("doc_id")
    columns = {c: F.col(c) for c in rows.columns} | {
        "reference_text": F.when(F.col("kind") == "synthetic", F.lit("said")),
        "ok_stages": F.array_compact(F.array(F.when(id_ % 13 != 0, "asr"), F.when(id_ % 5 != 0, "alignment_qwen"))),
        "alignment_status": F.when(id_ % 19 == 0, "review").otherwise("ok"),
    }
    found = policy.profile_decision(PROFILE, "asr", columns, text.kept(F.col("text")))
    return rows.withColumn("d", found).select("doc_id", "d.status", F.array_join("d.reasons", ",").alias("reasons"))


@query(f"""WITH d AS (SELECT doc_id, sha256(text) AS pcm, status, reasons FROM ({DECISIONS})),
    w AS (SELECT *, min(CASE WHEN status = 'accept' THEN doc_id END) OVER (PARTITION BY pcm) AS winner FROM d)
    SELECT doc_id, CASE WHEN status = 'accept' AND doc_id <> winner THEN 'reject' ELSE status END AS status,
      CASE WHEN status = 'accept' AND doc_id <> winner THEN 'exact_pcm_duplicate:' || winner ELSE reasons END AS reasons FROM w""")
def first_accepted_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = _decided(spark, sf_dir).withColumn("pcm_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text")
    kept = selection.first_accepted_wins(decided, "pcm_sha256", "doc_id", "doc_id")
    return kept.select("doc_id", "status", F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT doc_id, lang, source, rank::INT AS rank FROM (SELECT doc_id, lang, source,
      row_number() OVER (PARTITION BY lang, source ORDER BY sha256('0' || chr(0) || doc_id::VARCHAR), doc_id) AS rank FROM documents) WHERE rank <= 5""")
def review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return selection.review_sample(docs, ["lang", "source"], 5, "0", "doc_id").select("doc_id", "lang", "source", "rank")


@query(f"""WITH j AS (SELECT d.doc_id, d.status, r.language, r.kind, r.duration_s, CASE WHEN l.quality = 1 THEN 'accept' ELSE 'reject' END AS human
      FROM ({DECISIONS}) d JOIN ({RECORDS}) r USING (doc_id) JOIN labels l USING (doc_id)),
    c AS (SELECT language, kind, count(*) AS labels, count_if(human = 'accept')::BIGINT AS human_accept, count_if(human = 'reject')::BIGINT AS human_reject,
      count_if(status = 'accept')::BIGINT AS accepted, count_if(status = 'accept' AND human = 'reject')::BIGINT AS false_accept,
      count_if(status = 'reject' AND human = 'accept')::BIGINT AS false_reject, count_if(status IN ('review', 'error'))::BIGINT AS review_or_error,
      round(coalesce(sum(CASE WHEN status = 'accept' THEN duration_s END), 0), 4) AS accepted_seconds FROM j GROUP BY 1, 2)
    SELECT *, round((accepted - false_accept) / nullif(accepted, 0)::DOUBLE, 6) AS accept_precision,
      round(false_accept / nullif(human_reject, 0)::DOUBLE, 6) AS false_accept_rate FROM c""")
def calibration_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("human_label"))
    cells = selection.calibration(_decided(spark, sf_dir).join(labels, "doc_id"), ["language", "kind"])
    for name, digits in (("accepted_seconds", 4), ("accept_precision", 6), ("false_accept_rate", 6)):
        cells = cells.withColumn(name, F.round(name, digits))
    return cells


@query(f"""SELECT conv_id, CASE WHEN h < '{threshold(0.9)}' THEN 'train' WHEN h < '{threshold(0.9 + 0.05)}' THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT DISTINCT conv_id, sha256('0' || chr(0) || conv_id::VARCHAR) AS h FROM conversations)""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return ids.select("conv_id", split(seeded("0", F.col("conv_id").cast("string"))).alias("split"))


@query("""WITH RECURSIVE k AS (SELECT doc_id, unnest(['text:' || sha256(text), 'bucket:' || source || ':' || lang || ':' || (n_chars // 20)::VARCHAR]) AS key FROM documents),
    e AS (SELECT DISTINCT a.key AS x, b.key AS y FROM k a JOIN k b USING (doc_id)),
    r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
    m AS (SELECT x, min(y) AS root FROM r GROUP BY x)
    SELECT doc_id, min(root) AS root, sha256(min(root)) AS group_id FROM k JOIN m ON k.key = m.x GROUP BY doc_id""")
def leakage_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bucket = F.concat(F.lit("bucket:"), "source", F.lit(":"), "lang", F.lit(":"), F.floor(F.col("n_chars") / 20).cast("string"))
    keys = F.array(F.concat(F.lit("text:"), F.sha2(F.col("text").cast("binary"), 256)), bucket)
    return splits.grouped(docs, keys, "doc_id").select("doc_id", "root", "group_id")


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'fr') AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id AND l.toxic = 0)")
def pending_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), F.lit(None).cast("string").alias("error"), F.lit(False).alias("silent"))
    results = table(spark, sf_dir, "labels").select("doc_id", F.lit("asr").alias("stage"), F.when(F.col("toxic") == 1, "failed").alias("error"))
    return stages.pending(base, results, "asr", ("en", "fr"), retry_errors=True, id_="doc_id").select("doc_id")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN '' ELSE concat('asr=', CASE WHEN toxic = 1 THEN 'error' ELSE 'ok' END, ',quality=', CASE WHEN quality = 0 THEN 'error' ELSE 'ok' END) END AS stages,
      CASE WHEN toxic = 0 THEN l.doc_id % 10 / 10.0::DOUBLE END AS avg_logprob, CASE WHEN quality = 1 THEN 3.5::DOUBLE END AS dnsmos_ovrl,
      nullif(concat_ws('; ', CASE WHEN toxic = 1 THEN 'asr failed' END, CASE WHEN quality = 0 THEN 'quality failed' END), '') AS error
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def stage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    one = lambda stage, metric, value, bad: labels.select(
        "doc_id", F.lit(stage).alias("stage"), F.create_map(F.lit(metric), value).alias("metrics"), F.when(bad, f"{stage} failed").alias("error"), F.lit(0.0).alias("seconds")
    )
    asr = one("asr", "avg_logprob", F.col("doc_id") % 10 / 10.0, F.col("toxic") == 1)
    results = asr.unionByName(one("quality", "dnsmos_ovrl", F.lit(3.5), F.col("quality") == 0))
    base = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("string").alias("error"))
    folded = stages.fold(base, results, "doc_id")
    said = F.transform(F.map_entries("stages"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["status"]))
    metric = lambda m: F.col("metrics")[m].alias(m)
    return folded.select("doc_id", F.coalesce(F.array_join(F.array_sort(said), ","), F.lit("")).alias("stages"), metric("avg_logprob"), metric("dnsmos_ovrl"), "error")


SPANS = "SELECT event_id, user_id, epoch_us(ts) // 1000 AS a, epoch_us(ts) // 1000 + 60000 * (1 + event_id % 9) AS b, event_type FROM events"


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    return table(spark, sf_dir, "events").select("event_id", "user_id", begin.alias("a"), (begin + 60_000 * (1 + F.col("event_id") % 9)).alias("b"), "event_type")


@query(f"""WITH s AS ({SPANS}) SELECT x.event_id AS span_id, y.event_id AS other_id, least(x.b, y.b) - greatest(x.a, y.a) AS shared_ms
    FROM s x JOIN s y ON x.user_id = y.user_id AND y.a < x.b AND y.b > x.a AND x.event_type = 'click' AND y.event_type = 'view'""")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _spans(spark, sf_dir)
    left = spans.where("event_type = 'click'").select("user_id", F.col("event_id").alias("span_id"), F.col("a").alias("begin"), F.col("b").alias("finish"))
    right = spans.where("event_type = 'view'").select("user_id", F.col("event_id").alias("other_id"), "a", "b")
    met = intervals.range_join(left, right, 600_000, "user_id")
    return met.select("span_id", "other_id", (F.col("hi") - F.col("lo")).alias("shared_ms"))


@query("""WITH o AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    c AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, event_type ORDER BY i) AS island FROM o)
    SELECT user_id, event_type, min(i) AS first, max(i) AS last, count(*) AS n FROM c GROUP BY user_id, event_type, island""")
def speaker_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = table(spark, sf_dir, "events").withColumn("i", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long"))
    return intervals.runs(numbered, "user_id", "i", "event_type")


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    along = W.partitionBy("user_id").orderBy("ts", "event_id")
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("episode"), F.row_number().over(along).alias("frame"), F.least(F.lit(1.0), F.col("value") / 20.0).alias("p"))


@query()
def vad_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vad.segments(_frames(spark, sf_dir), speech=1024, silence=1024, pad=256)


@query("""SELECT user_id, unnest(range(0, b, 30)) AS begin, least(unnest(range(0, b, 30)) + 30, b) AS finish FROM
    (SELECT user_id, count(*) AS b FROM events GROUP BY user_id)""")
def forced_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("b"))
    blocks = episodes.withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b") - 1, F.lit(30).cast("long"))))
    return blocks.select("user_id", "begin", F.least(F.col("begin") + 30, "b").alias("finish"))


@query("""SELECT label, round(avg(c), 5) AS consistency, count(c) AS pairs FROM (SELECT label, list_cosine_similarity(embedding::DOUBLE[],
      lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id)) AS c FROM embeddings) GROUP BY label""")
def adjacent_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("embedding").over(W.partitionBy("label").orderBy("vec_id"))
    rows = table(spark, sf_dir, "embeddings").withColumn("before", before)
    both = rows.withColumn("c", F.when(F.col("before").isNotNull(), numeric.cosine(F.col("embedding"), F.col("before"))))
    return both.groupBy("label").agg(F.round(F.avg("c"), 5).alias("consistency"), F.count("c").alias("pairs"))


@query("""SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], r.embedding::DOUBLE[]), 5) AS similarity
    FROM embeddings e JOIN (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) r USING (label)""")
def reference_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    references = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("reference"))
    return rows.join(references, "label").select("vec_id", F.round(numeric.cosine(F.col("embedding"), F.col("reference")), 5).alias("similarity"))


@query("""WITH o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    w AS (SELECT user_id, i, avg(value / 10) OVER (PARTITION BY user_id ORDER BY i ROWS 8 PRECEDING) AS m, count(*) OVER (PARTITION BY user_id ORDER BY i ROWS 8 PRECEDING) AS n FROM o)
    SELECT user_id, count(*) AS windows, round(avg(-0.08397278 * m * m + 1.22083953 * m + 0.0052439), 5) AS sig FROM w WHERE n = 9 GROUP BY user_id""")
def window_poly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    along = W.partitionBy("user_id").orderBy("ts", "event_id")
    last = along.rowsBetween(-8, 0)
    rows = table(spark, sf_dir, "events").select("user_id", F.avg(F.col("value") / 10).over(last).alias("m"), F.count("*").over(last).alias("n"))
    score = numeric.polynomial(F.col("m"), numeric.CALIBRATION["sig"])
    return rows.where("n = 9").groupBy("user_id").agg(F.count("*").alias("windows"), F.round(F.avg(score), 5).alias("sig"))


@query("""SELECT user_id, round(20 * log10(greatest(sqrt(avg(x * x)), 1e-12)), 5) AS rms_dbfs, max(abs(x)) AS peak,
      round(avg(CASE WHEN abs(x) >= 1 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS full_scale_ratio, max(abs(x)) = 0 AS silent FROM (SELECT user_id, value / 50 AS x FROM events) GROUP BY user_id""")
def signal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", (F.col("value") / 50).alias("x"))
    level = 20 * F.log10(F.greatest(F.sqrt(F.avg(F.col("x") * F.col("x"))), F.lit(1e-12)))
    peak = F.max(F.abs("x"))
    full = F.avg(F.when(F.abs("x") >= 1, 1.0).otherwise(0.0))
    return rows.groupBy("user_id").agg(F.round(level, 5).alias("rms_dbfs"), peak.alias("peak"), F.round(full, 6).alias("full_scale_ratio"), (peak == 0).alias("silent"))


@query("""SELECT l_suppkey, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean_discount FROM lineitem WHERE l_quantity > 0 GROUP BY l_suppkey""")
def weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy("l_suppkey").agg(F.round(numeric.weighted_mean(F.col("l_discount"), F.col("l_quantity")), 6).alias("mean_discount"))


@query("""SELECT s AS source_rate, t AS target_rate, count(*) AS n, CASE
      WHEN s < t THEN 'upsampling from ' || s || ' Hz to ' || t || ' Hz does not restore missing bandwidth'
      WHEN s > t THEN 'downsampling from ' || s || ' Hz to ' || t || ' Hz keeps content below ' || t // 2 || ' Hz' END AS warning
    FROM (SELECT 8000 * l_linenumber AS s, CASE WHEN l_returnflag = 'N' THEN 16000 ELSE 24000 END AS t FROM lineitem) GROUP BY s, t""")
def rate_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select((8000 * F.col("l_linenumber")).cast("int").alias("source_rate"), F.when(F.col("l_returnflag") == "N", 16000).otherwise(24000).alias("target_rate"))
    counted = rows.groupBy("source_rate", "target_rate").agg(F.count("*").alias("n"))
    return counted.withColumn("warning", numeric.rate_warning(F.col("source_rate"), F.col("target_rate")))


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.duplicate_ids(table(spark, sf_dir, "conversations"), "conv_id")


@query("SELECT l.doc_id FROM labels l ANTI JOIN (SELECT doc_id FROM documents WHERE lang <> 'es') d USING (doc_id)")
def unknown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "documents").where("lang <> 'es'")
    return table(spark, sf_dir, "labels").join(known, "doc_id", "left_anti").select("doc_id")


@query("SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT doc_id AS seq, CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN 'unknown language' WHEN doc_id % 7 = 0 THEN 'kind: unknown kind' ELSE NULL END AS problem
    FROM documents""".replace("kind: unknown kind", "unknown kind"))
def manifest_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kind = F.when(F.col("doc_id") % 7 == 0, "radio").otherwise("podcast")
    row = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("audio"), F.col("lang").alias("language"), kind.alias("kind"))
    lines = docs.select(F.col("doc_id").alias("line"), F.to_json(row).alias("value"))
    return manifest.parse(lines, ("en", "fr", "de")).select("seq", "problem")


def _clips(spark: SparkSession, sf_dir: str, of) -> DataFrame:
    """Each user's event values as a short clip, measured by a NumPy function."""
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))).alias("e"))

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame([(u, *of(np.tile(np.array([x["value"] for x in e]) / 200 - 0.1, 200))) for u, e in zip(pdf["user_id"], pdf["e"], strict=True)], columns=["user_id", "n", "value"])

    return rows.mapInPandas(run, "user_id long, n long, value double")


@query()
def fbank(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(clip):
        features = dsp.mean_normalize(dsp.fbank(clip))
        return len(features), float(np.abs(features).mean())

    return _clips(spark, sf_dir, of)


@query()
def ctc_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(clip):
        logits = clip[: len(clip) // 5 * 5].reshape(-1, 5)
        scores, tokens = dsp.log_softmax(logits * 50), [1, 2, 2, 3]
        path = np.array(dsp.ctc_viterbi(scores, tokens))
        # A repeated clip has equal paths; their score is the same whichever is taken.
        return len(path), float(scores[np.arange(len(path)), np.where(path >= 0, np.take(tokens, path), 0)].sum())

    return _clips(spark, sf_dir, of)


@query("""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events, round(sum(value), 4) AS total_value FROM s GROUP BY user_id, k""")
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions(table(spark, sf_dir, "events"))
    ends = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")]
    return found.select("user_id", *ends, "n_events", F.round("total_value", 4).alias("total_value"))
