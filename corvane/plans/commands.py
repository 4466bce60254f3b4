"""The five commands on Spark: prepare, score, calibrate, select, export."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import session
from corvane.functions import dsp
from corvane.functions.hashing import canonical
from corvane.functions.text import agreement, kept, normalize
from corvane.operators import diarization, selection, splits, stages, vad
from corvane.operators import policy as rules
from corvane.sources import audio, manifest

BASE = (
    "seq long, id string, language string, kind string, boundary_cut boolean, reference_text string, source_id string, speaker_id string, input string, "
    "audio string, reference_audio string, source_sha256 string, reference_sha256 string, source_sample_rate int, start double, end double, duration_s double, rms_dbfs double, peak double, "
    "full_scale_ratio double, silent boolean, pcm_sha256 string, error string, attempt long"
)
RESULTS = "id string, stage string, metrics map<string,double>, texts map<string,string>, error string, seconds double, attempt long"

#: What stages say besides numbers, in the merged view; lists as JSON.
SAID = ("alignment_status", "speaker_status", "diarization_status", "diarization_reasons", "speaker_turns", "speaker_id_scope", "alignment", "alignment_reasons")


@dataclass
class Stage:
    """A measurement: `make()` gives, once per Python worker, a callable from (clip, row) to metrics and texts."""

    name: str
    make: Callable[[], Callable[[Any, Mapping[str, Any]], Mapping[str, Any]]]
    languages: Sequence[str] = rules.LANGUAGES
    identity: Mapping[str, Any] = field(default_factory=dict)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _save(spark: SparkSession, path: str, value: Any) -> None:
    spark.createDataFrame([(canonical(value),)], "value string").coalesce(1).write.text(path)


def _load(spark: SparkSession, path: str) -> Any:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))


def _same_run(spark: SparkSession, path: str, identity: Any) -> None:
    """Outputs of different inputs, models or settings are never mixed."""
    if exists(spark, path):
        stages.agreed([canonical(_load(spark, path))], canonical(identity))
    else:
        _save(spark, path, identity)


def _probe(folder: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Path, hash, rate and duration of each distinct source, read once however many rows use it."""

    def one(name: str) -> tuple:
        try:
            path = audio.resolve(name, folder)
            found = audio.info(path)
            return name, path, audio.file_hash(path), found["sample_rate"], found["duration"], None
        except (OSError, ValueError, RuntimeError, EOFError) as problem:
            return name, None, None, None, None, str(problem) or type(problem).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([one(n) for n in pdf["name"]], columns=["name", "path", "sha256", "rate", "seconds", "problem"])

    return run


def _bounds(row: Mapping[str, Any], seconds: float | None) -> tuple[float, float | None]:
    """Start and end in seconds, from samples where they are given; without an end `seconds`."""
    if row["timebase_hz"]:
        return row["start_sample"] / row["timebase_hz"], row["end_sample"] / row["timebase_hz"]
    return row["start"] or 0.0, row["end"] or seconds


def _measure(attempt: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = [c.split()[0] for c in BASE.split(", ")]

    def one(row: dict) -> dict:
        try:
            if row["problem"] or row["reference_problem"]:
                raise ValueError(row["problem"] or row["reference_problem"])
            row |= {"audio": row["path"], "source_sha256": row["sha256"], "source_sample_rate": row["rate"]}
            begin, finish = _bounds(row, row["seconds"])
            clip = dsp.checked(audio.decode(row["path"], begin, finish))
            row |= dsp.signals(clip) | {"start": begin, "end": finish}
        except (OSError, ValueError, RuntimeError) as problem:
            row["error"] = str(problem) or type(problem).__name__
        return row | {"attempt": attempt}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
            yield pd.DataFrame([one(r) for r in rows]).reindex(columns=names)

    return run


def _prepared(stage: Stage, row: Mapping[str, Any]) -> Mapping[str, Any] | None:
    """What prepare measured already, for the diarization stage: of the same model and source, or an error."""
    given = json.loads(row["input"])
    if stage.name != "diarization" or not given.get("prepared_diarization"):
        return None
    if canonical(given.get("diarization_identity") or {}) != canonical(dict(stage.identity)):
        raise ValueError("prepared diarization is of another model")
    if given.get("source_sha256") not in (None, row["source_sha256"]):
        raise ValueError("prepared diarization is of another source")
    return given["prepared_diarization"]


def _apply(stage: Stage, attempt: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in batches:
            out = []
            for row in pdf.astype(object).where(pdf.notna(), None).to_dict("records"):
                began, numbers, texts, error = time.monotonic(), {}, {}, None
                try:
                    if row["source_sha256"] != row["sha256_now"]:
                        raise ValueError("the source changed since it was measured")
                    found = _prepared(stage, row)
                    if found is None:
                        model = model or stage.make()
                        found = model(audio.decode(row["audio"], row["start"], row["end"]), row)
                    for key, value in found.items():
                        if value is None or isinstance(value, str):
                            texts[key] = value
                        elif isinstance(value, list | tuple | dict):  # turns, reasons, alignments: as JSON
                            texts[key] = canonical(value)
                        else:
                            numbers[key] = float(value)
                    canonical(numbers)  # numbers that aren't finite are errors
                except Exception as problem:  # noqa: BLE001  any failure of a model is this record's result
                    numbers, texts, error = {}, {}, str(problem) or type(problem).__name__
                out.append((row["id"], stage.name, numbers, texts, error, time.monotonic() - began, attempt))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULTS.replace("<string,", "<string;").split(", ")])

    return run


def _base(spark: SparkSession, out: str) -> DataFrame:
    rows = spark.read.parquet(f"{out}/base")
    return rows.groupBy("id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "id"]), "attempt").alias("r")).select("id", "r.*")


def _results(spark: SparkSession, out: str) -> DataFrame:
    if exists(spark, f"{out}/results"):
        return stages.latest(spark.read.parquet(f"{out}/results").select("id", "stage", "metrics", "texts", "error", "seconds", "attempt"))
    return spark.createDataFrame([], RESULTS)


def score(spark: SparkSession, path: str, out: str, run: Sequence[Stage], retry_errors: bool = False) -> dict[str, int]:
    """Measure each row of a manifest and run the stages that are still missing; counts of scored, resumed, errors."""
    if not run or run[0].name != "asr" or len({s.name for s in run}) != len(run):
        raise ValueError("stages start with asr and are unique")
    # Adding stages later is a resume; other inputs or models for the same stage are not.
    _same_run(spark, f"{out}/config", {"manifest": os.path.abspath(path), "sha256": audio.file_hash(path)})
    for stage in run:
        _same_run(spark, f"{out}/identity/{stage.name}", dict(stage.identity))
    rows, attempt = manifest.read(spark, path), time.time_ns()
    total = rows.count()
    todo = rows
    if exists(spark, f"{out}/base"):
        known = _base(spark, out)
        todo = rows.join(known.where("error is null") if retry_errors else known, "id", "left_anti")
    if not todo.isEmpty():
        names = [c.split()[0] for c in BASE.split(", ")]
        used = todo.select(F.explode(F.array_compact(F.array("audio", "reference_audio"))).alias("name")).distinct()
        found = used.mapInPandas(_probe(path), "name string, path string, sha256 string, rate int, seconds double, problem string")
        reference = found.select(F.col("name").alias("r"), F.col("sha256").alias("reference_sha256"), F.col("problem").alias("reference_problem"))
        wide = todo.join(found, F.col("audio") == F.col("name"), "left").join(reference, F.col("reference_audio") == F.col("r"), "left")
        wide = wide.select("*", *[F.lit(None).alias(n) for n in names if n not in wide.columns])
        wide.mapInPandas(_measure(attempt), BASE).write.mode("append").parquet(f"{out}/base")
    base = _base(spark, out)
    for stage in run:
        missing = stages.pending(base, _results(spark, out), stage.name, stage.languages, retry_errors)
        if stage.name != "asr":
            texts = _results(spark, out).where("stage = 'asr'").select("id", F.col("texts")["text"].alias("text"))
            missing = missing.join(texts, "id", "left")
        if not missing.isEmpty():
            # Each distinct source is hashed once more before a stage reads it.
            now = missing.select("audio").distinct().mapInPandas(_hash_now("sha256_now"), "audio string, sha256_now string")
            missing = missing.join(now, "audio", "left")
            missing.mapInPandas(_apply(stage, attempt), RESULTS).write.mode("append").partitionBy("stage").parquet(f"{out}/results")
    changed = [base.where(F.col("attempt") == attempt).select("id"), _results(spark, out).where(F.col("attempt") == attempt).select("id")]
    scored = changed[0].unionByName(changed[1]).distinct().count()
    _save_flag(spark, out)
    return {"scored": scored, "resumed": total - scored, "errors": records(spark, out).where("error is not null").count()}


def _save_flag(spark: SparkSession, out: str) -> None:
    spark.createDataFrame([("true",)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/complete")


def records(spark: SparkSession, out: str) -> DataFrame:
    """The merged view: base columns, metrics and texts of all stages, stage map, errors, agreement with the reference."""
    if not exists(spark, f"{out}/complete/_SUCCESS"):
        raise ValueError("scoring is not complete")
    results = _results(spark, out)
    base = _base(spark, out).drop("attempt")
    merged = stages.fold(base, results.select("id", "stage", "metrics", "error", "seconds"))
    texts = results.where("error is null").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("stage", "texts")), stages.by_stage).alias("t"))
    merged = merged.join(texts, "id", "left")
    text = F.coalesce(F.aggregate("t", F.lit(None).cast("string"), lambda s, e: F.coalesce(e["texts"]["text"], s)), F.when(F.col("silent"), F.lit("")))
    said = lambda key: F.aggregate("t", F.lit(None).cast("string"), lambda s, e: F.coalesce(e["texts"][key], s)).alias(key)
    merged = merged.withColumn("text", text).select("*", *[said(key) for key in SAID])
    merged = merged.withColumn("_r", normalize(F.col("reference_text"), F.col("language"))).withColumn("_h", normalize(F.col("text"), F.col("language")))
    merged = merged.withColumn("_a", F.when(F.length("_r") > 0, agreement(F.col("_r"), F.col("_h"), F.col("language"))))
    own = ("source_sample_rate", "duration_s", "rms_dbfs", "peak", "full_scale_ratio")
    measured = [F.coalesce(F.col("metrics")[m], F.col("_a")[m] if m.startswith("reference_") else F.lit(None).cast("double")).alias(m) for m in rules.METRICS if m not in own]
    flags = [(F.col("metrics")[m] != 0).alias(m) for m in ("speaker_capacity_reached", "speaker_reference_available")]
    return merged.select("*", *measured, *flags, stages.with_flags(F.coalesce("stages", F.create_map().cast(merged.schema["stages"].dataType))).alias("ok_stages")).drop("_a", "_r", "_h", "t")


def decide(rows: DataFrame, policy: Mapping, profile: str | None = None) -> DataFrame:
    """records with status and reasons."""
    columns = {c: F.col(c) for c in rows.columns}
    text = kept(F.col("text"))
    if profile is None:
        rules.validate_policy(policy)
        found = rules.decision(policy, columns, text)
    else:
        rules.validate_profiles(policy)
        found = rules.profile_decision(policy, profile, columns, text)
    return rows.withColumn("_d", found).select(*rows.columns, "_d.status", "_d.reasons")


def _hash_now(name: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Paths with their files' hashes in the column `name`, null where a file can't be read."""

    def one(path: str) -> str | None:
        try:
            return audio.file_hash(path)
        except OSError:
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(p, one(p)) for p in pdf["audio"]], columns=["audio", name])

    return run


def select(spark: SparkSession, scored: str, policy: Mapping, out: str, profile: str | None = None) -> dict[str, Any]:
    """Decisions on all records, exact duplicates rejected, written to a fresh folder; counts by status."""
    decided = decide(records(spark, scored), policy, profile)
    now = decided.select("audio").where("source_sha256 is not null").distinct().mapInPandas(_hash_now("sha256"), "audio string, sha256 string")
    final = selection.first_accepted_wins(selection.source_changes(decided, now))
    final.write.mode("errorifexists").parquet(f"{out}/decisions")
    final = spark.read.parquet(f"{out}/decisions")
    final.where("status = 'accept'").orderBy("seq").write.json(f"{out}/accepted")
    counts = {r["status"]: r["n"] for r in selection.counts_by(final, "status", rules.STATUSES).collect()}
    _save(spark, f"{out}/summary", {"counts": counts, "policy": policy, "profile": profile})
    return counts


def calibrate(
    spark: SparkSession, scored: str, out: str, per_group: int = 20, seed: str = "0", labels: str | None = None, policy: Mapping | None = None, profile: str | None = None
) -> list[dict] | None:
    """A review sample per language and kind, and, given human labels and a policy, its confusion."""
    rows = records(spark, scored)
    sample = selection.review_sample(rows, ["language", "kind"], per_group, seed)
    sample = sample.withColumn("human_label", F.lit(None).cast("string")).withColumn("human_notes", F.lit(""))
    sample.orderBy("language", "kind", "rank").write.mode("errorifexists").json(f"{out}/review")
    if labels is None or policy is None:
        return None
    given = spark.read.json(labels).where(F.col("human_label").isin("accept", "reject"))
    selection.check_labels(given, rows)
    if not selection.stale_labels(given, rows).isEmpty():
        raise ValueError("labels are of other sources, samples or inputs")
    judged = decide(rows, policy, profile).join(given.select("id", F.col("human_label").alias("human_label")), "id")
    cells = selection.calibration(judged, ["language", "kind"]).orderBy("language", "kind")
    report = [r.asDict() for r in cells.collect()]
    _save(spark, f"{out}/report", report)
    return report


def _write_clips(out: str, rate: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for row in pdf.to_dict("records"):
                if audio.file_hash(row["audio"]) != row["source_sha256"]:
                    raise ValueError(f"{row['audio']} changed since selection")
                if audio.info(row["audio"])["sample_rate"] != row["source_sample_rate"]:
                    raise ValueError(f"{row['audio']} has another rate than when it was scored")
                clip, target, width = audio.cut(row["audio"], row["start"], row["end"], rate)
                path = f"{out}/{row['path']}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                audio.write_wav(path, clip, target, width)
                frames, channels = audio.verify(path, round((row["end"] - row["start"]) * target), target)
                if channels != clip.shape[1]:
                    raise ValueError(f"{path} has {channels} channels, its source {clip.shape[1]}")
                done.append((row["id"], row["path"], target, frames, channels, audio.file_hash(path)))
            yield pd.DataFrame(done, columns=["id", "path", "sample_rate", "frames", "channels", "sha256"])

    return run


def _intact(out: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Those of the finished clips whose files are there and unchanged."""

    def same(path: str, sha256: str) -> bool:
        try:
            return audio.file_hash(f"{out}/{path}") == sha256
        except OSError:
            return False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[same(p, h) for p, h in zip(pdf["path"], pdf["sha256"], strict=True)]]

    return run


CLIPS = "id string, path string, sample_rate int, frames long, channels int, sha256 string"


def _finished(spark: SparkSession, out: str) -> DataFrame:
    """The last clip of each id."""
    rows = spark.read.parquet(f"{out}/outputs")
    return rows.groupBy("id").agg(F.max_by(F.struct("path", "sample_rate", "frames", "channels", "sha256"), "attempt").alias("r")).select("id", "r.*")


def export(spark: SparkSession, selected: str, out: str, sample_rate: int | None = None, seed: str = "0", train: float = 0.9, validation: float = 0.05) -> dict[str, Any]:
    """Clips of accepted records in leakage-safe splits, with metadata in manifest order; finished clips that are unchanged are kept on a resume."""
    if sample_rate is not None and not 8000 <= sample_rate <= 192_000:
        raise ValueError("sample rates are 8000 to 192000")
    rows = spark.read.parquet(f"{selected}/decisions").where("status = 'accept'")
    if not rows.where("source_sample_rate is null").isEmpty():
        raise ValueError("an accepted record has no source rate")
    _same_run(spark, f"{out}/config", {"selected": selected, "rate": sample_rate, "seed": seed, "train": train, "validation": validation})
    dealt = splits.assign(splits.grouped(rows, splits.record_keys()), seed, train, validation)
    dealt = dealt.withColumn("path", F.concat("split", F.lit("/"), F.sha2("id", 256), F.lit(".wav")))
    todo = dealt
    if exists(spark, f"{out}/outputs"):
        todo = dealt.join(_finished(spark, out).mapInPandas(_intact(out), CLIPS), "id", "left_anti")
    if not todo.isEmpty():
        todo.select("id", "path", "audio", "source_sha256", "source_sample_rate", "start", "end").mapInPandas(
            _write_clips(out, sample_rate), CLIPS
        ).withColumn("attempt", F.lit(time.time_ns())).write.mode("append").parquet(f"{out}/outputs")
    done = _finished(spark, out).drop("path", "sha256")
    items = dealt.join(done, "id")
    items.orderBy("seq").write.mode("overwrite").json(f"{out}/metadata")
    counts = {r["split"]: r["n"] for r in selection.counts_by(items, "split", ("train", "validation", "test")).collect()}
    rates = [r.asDict() for r in items.groupBy("source_sample_rate", "sample_rate").agg(F.count("*").alias("n")).orderBy("source_sample_rate", "sample_rate").collect()]
    return {"splits": counts, "conversions": rates}


SPANS = "episode string, sha256 string, begin long, finish long, cut boolean"
FRAMES = "episode string, sha256 string, a long, p array<array<float>>"


def _speech(voice: Callable[[], Callable[[Any], float]], options: Mapping[str, Any]) -> Callable[[dict], Iterator[tuple]]:
    def of(row: dict) -> Iterator[tuple]:
        begin, finish = _bounds(row, None)
        offset, model = round(begin * dsp.RATE), voice()
        state, rest, total, spans = vad.Activity(**options), np.zeros(0, np.float32), 0, []
        for block in audio.stream(row["path"], begin, finish):
            total += len(block)
            rest = np.concatenate([rest, block])
            whole = len(rest) // vad.WINDOW * vad.WINDOW
            spans += state.feed([model(w) for w in rest[:whole].reshape(-1, vad.WINDOW)])
            rest = rest[whole:]
        if len(rest):
            spans += state.feed([model(np.pad(rest, (0, vad.WINDOW - len(rest))))])
        for a, b, cut in [*spans, *state.finish(total)]:
            if not 0 <= a < b or b - a > vad.MOST_SAMPLES:
                raise ValueError(f"{row['id']}: a speech span is empty or longer than 30 s")
            yield offset + a, offset + b, cut

    return of


def _speakers(make: Callable[[], Callable[[Iterator[Any]], Iterator[tuple[int, Any]]]]) -> Callable[[dict], Iterator[tuple]]:
    def of(row: dict) -> Iterator[tuple]:
        begin, finish = _bounds(row, None)
        offset = round(begin * dsp.RATE)
        for first, found in make()(audio.stream(row["path"], begin, finish)):
            for a, _, part in diarization.chunks(diarization.checked(found), offset + first):
                yield a, part.tolist()

    return of


def _episodes(of: Callable[[dict], Iterator[tuple]], schema: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of each episode as they come, after one without values that tells that the episode was read."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.astype(object).where(pdf.notna(), None).to_dict("records"):
                own = (row["id"], row["sha256"])
                yield pd.DataFrame([own + (None,) * (len(names) - 2)], columns=names, dtype=object)
                for values in of(row):
                    yield pd.DataFrame([own + values], columns=names, dtype=object)

    return run


def _segments(identities: Mapping[str, Mapping], diarized: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The lines of a manifest of segments: all that the episode's line holds, under what the segment says itself."""

    def line(row: dict) -> str:
        a, b, given = row["begin"], row["finish"], json.loads(row["input"])
        segment = {
            "id": f"{row['id']}:{a}:{b}", "audio": row["path"], "source_id": given.get("source_id", row["id"]), "start_sample": a, "end_sample": b, "timebase_hz": dsp.RATE,
            "start": a / dsp.RATE, "end": b / dsp.RATE, "boundary_cut": bool(row["cut"]), "vad": dict(identities.get("vad", {})), "source_sha256": row["sha256"],
        }
        if diarized:
            found = json.loads(row["summary"])
            tail = found.pop("unscored_tail_samples")
            if tail is not None:
                segment["boundary_cut"] = True
                found |= {"diarization_status": "review", "diarization_reasons": ["unscored_diarization_tail"], "unscored_tail_samples": tail, "speaker_turns": []}
            segment |= {"prepared_diarization": found | {"speaker_id_scope": "source_local"}, "diarization_identity": dict(identities.get("diarization", {}))}
        return json.dumps(given | segment, ensure_ascii=False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"seq": pdf["seq"], "begin": pdf["begin"], "line": [line(r) for r in pdf.to_dict("records")]})

    return run


def prepare(
    spark: SparkSession, path: str, out: str, voice: Callable[[], Callable[[Any], float]], speakers: Callable[[], Callable[[Iterator[Any]], Iterator[tuple[int, Any]]]] | None = None,
    identities: Mapping[str, Mapping] | None = None, **options: Any,
) -> int:
    """Untranscribed podcasts to a manifest of speech segments in manifest order, with their speakers if `speakers` is given.

    voice: makes, for an episode, a model from a 512-sample window to a probability. speakers: makes one from an episode's
    blocks of samples to (first sample, frames by 8 probabilities). identities: of the models `vad` and `diarization`; the
    latter's `activity_threshold` is what a probability must pass. Episodes that were read before are kept in `out`.state
    and not read again; other models, changed sources, or an output that differs are errors.
    """
    rows, identities = manifest.read(spark, path), identities or {}
    if not rows.where("kind <> 'podcast' or length(reference_text) > 0").isEmpty():
        raise ValueError("prepare takes podcasts without a transcript")
    state, diarized = f"{out}.state", speakers is not None
    _same_run(spark, f"{state}/config", {"identities": {k: dict(v) for k, v in identities.items()}, "diarized": diarized, "options": options})
    probed = rows.select(F.col("audio").alias("name")).distinct().mapInPandas(_probe(path), "name string, path string, sha256 string, rate int, seconds double, problem string")
    known = rows.select("id", "seq", "audio", "input", "start", "end", "start_sample", "end_sample", "timebase_hz").join(probed, F.col("audio") == F.col("name"), "left")
    known = session.cut(known.drop("name", "audio"))
    if found := known.where("problem is not null").orderBy("seq").first():
        raise ValueError(f"{found['id']}: {found['problem']}")
    readers = [("spans", _speech(voice, options), SPANS)] + ([("frames", _speakers(speakers), FRAMES)] if diarized else [])
    for name, of, schema in readers:
        todo = known
        if exists(spark, f"{state}/{name}"):
            read = spark.read.parquet(f"{state}/{name}").select(F.col("episode").alias("id"), F.col("sha256").alias("was")).distinct()
            if changed := known.join(read, "id").where("sha256 <> was").first():
                raise ValueError(f"{changed['id']}: the source changed since it was read")
            todo = known.join(read, "id", "left_anti")
        if not todo.isEmpty():
            todo.mapInPandas(_episodes(of, schema), schema).write.mode("append").parquet(f"{state}/{name}")
    spans = spark.read.parquet(f"{state}/spans").where("begin is not null").drop("sha256")
    found = known.withColumnRenamed("id", "episode").join(spans, "episode")
    if diarized:
        frames = diarization.frames_of(spark.read.parquet(f"{state}/frames").where("a is not null"))
        told = diarization.summarize(found.select("episode", "begin", "finish"), frames, identities.get("diarization", {}).get("activity_threshold", 0.5))
        told = session.cut(told)
        if wrong := told.where("error is not null").first():
            raise ValueError(f"{wrong['episode']}: {wrong['error']}")
        kept = F.struct("diar_speakers", "overlap_ratio", "overlap_seconds", "speaker_turns", "speaker_capacity_reached", "unscored_tail_samples")
        found = found.join(told.select("episode", "begin", "finish", F.to_json(kept, {"ignoreNullFields": "false"}).alias("summary")), ["episode", "begin", "finish"])
    else:
        found = found.withColumn("summary", F.lit(None).cast("string"))
    found = found.select(F.col("episode").alias("id"), "seq", "path", "sha256", "input", "begin", "finish", "cut", "summary")
    lines = session.cut(found.mapInPandas(_segments(identities, diarized), "seq long, begin long, line string"))
    if exists(spark, out):
        old, new = spark.read.text(out), lines.select(F.col("line").alias("value"))
        if not old.exceptAll(new).isEmpty() or not new.exceptAll(old).isEmpty():
            raise ValueError(f"{out} exists and differs")
    else:
        lines.orderBy("seq", "begin").select("line").write.mode("errorifexists").text(out)
    return lines.count()
