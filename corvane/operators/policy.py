"""Bounds on metrics and the decisions that follow: accept, review, reject or error, with reasons in a fixed order."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.numeric import finite

STATUSES = ("accept", "reject", "review", "error")
LANGUAGES = ("en", "zh", "ja", "tr")
KINDS = ("podcast", "synthetic")
PROFILES = ("tts", "asr")
#: The metrics that a policy may bound.
METRICS = (
    "source_sample_rate", "duration_s", "rms_dbfs", "peak", "full_scale_ratio", "avg_logprob", "no_speech_prob",
    "compression_ratio", "reference_cer", "reference_wer", "dnsmos_sig", "dnsmos_bak", "dnsmos_ovrl", "overlap_ratio",
    "diar_speakers", "speaker_similarity", "speaker_consistency", "alignment_coverage", "alignment_score", "alignment_token_score",
)


def _check_cell(bounds: object, metrics: tuple[str, ...]) -> None:
    if not isinstance(bounds, Mapping):
        raise ValueError("bounds must map metrics to limits")
    for metric, limits in bounds.items():
        if metric not in metrics:
            raise ValueError(f"{metric} can't be bounded")
        if not isinstance(limits, Mapping) or not limits or not limits.keys() <= {"min", "max"}:
            raise ValueError(f"{metric}: limits are min, max or both")
        for value in limits.values():
            if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value):
                raise ValueError(f"{metric}: a limit is a finite number")
        if "min" in limits and "max" in limits and limits["min"] > limits["max"]:
            raise ValueError(f"{metric}: min is above max")


def validate_policy(policy: Mapping, languages: tuple[str, ...] = LANGUAGES, metrics: tuple[str, ...] = METRICS) -> None:
    """{"languages": {language: {metric: {min, max}}}}, or a ValueError."""
    if not isinstance(policy, Mapping) or policy.keys() != {"languages"} or not isinstance(policy["languages"], Mapping):
        raise ValueError("a policy has the key languages")
    for language, bounds in policy["languages"].items():
        if language not in languages:
            raise ValueError(f"unknown language {language}")
        _check_cell(bounds, metrics)


def validate_profiles(policy: Mapping, languages: tuple[str, ...] = LANGUAGES, metrics: tuple[str, ...] = METRICS, kinds: tuple[str, ...] = KINDS) -> None:
    """{"profiles": {profile: {"languages": {language: {kind: {metric: {min, max}}}}}}}, or a ValueError."""
    if not isinstance(policy, Mapping) or policy.keys() != {"profiles"} or not isinstance(policy["profiles"], Mapping):
        raise ValueError("a profile policy has the key profiles")
    for profile, cells in policy["profiles"].items():
        if profile not in PROFILES or not isinstance(cells, Mapping) or cells.keys() != {"languages"}:
            raise ValueError(f"unknown profile or keys: {profile}")
        for language, by_kind in cells["languages"].items():
            if language not in languages or not isinstance(by_kind, Mapping) or not by_kind.keys() <= set(kinds):
                raise ValueError(f"unknown language or kind under {language}")
            for bounds in by_kind.values():
                _check_cell(bounds, metrics)


def _reasons(*items: Column) -> Column:
    return F.array_compact(F.array(*items))


def _violations(bounds: Mapping, columns: Mapping[str, Column]) -> tuple[list[Column], list[Column]]:
    """For each metric of a cell, in the policy's order: whether its value is outside, and whether it is missing."""
    outside, missing = [], []
    for metric, limits in bounds.items():
        value = finite(columns[metric]) if metric in columns else F.lit(None).cast("double")
        over = F.lit(False)
        if "min" in limits:
            over |= value < float(limits["min"])
        if "max" in limits:
            over |= value > float(limits["max"])
        outside.append(F.coalesce(over, F.lit(False)))
        missing.append(value.isNull())
    return outside, missing


def _result(status: str | Column, reasons: Column) -> Column:
    status = F.lit(status) if isinstance(status, str) else status
    return F.struct(status.alias("status"), reasons.cast("array<string>").alias("reasons"))


def _said(*reasons: str) -> Column:
    return F.array(*[F.lit(r) for r in reasons])


def _by_bounds(bounds: Mapping, columns: Mapping[str, Column]) -> Column:
    """Reasons outside come before missing ones; without any the record is accepted."""
    outside, missing = _violations(bounds, columns)
    told = [F.when(x, f"{m}:outside_bounds") for m, x in zip(bounds, outside, strict=True)] + [F.when(x, f"{m}:missing") for m, x in zip(bounds, missing, strict=True)]
    status = F.when(reduce(or_, outside), "reject").when(reduce(or_, missing), "review").otherwise("accept")
    return _result(status, _reasons(*told))


def truth(name: str, columns: Mapping[str, Column]) -> Column:
    return F.coalesce(columns[name], F.lit(False)) if name in columns else F.lit(False)


def decision(policy: Mapping, columns: Mapping[str, Column], normalized: Column) -> Column:
    """struct(status, reasons) of a record under a language policy; the first rule that holds decides.

    `columns` has language, the metrics, and error, boundary_cut and silent where they exist. Anything
    unmeasured leads to review: a metric that is null, NaN or infinite is missing.
    """
    failed = F.coalesce(F.length(columns["error"]) > 0, F.lit(False)) if "error" in columns else F.lit(False)
    chosen = _result("review", _said("language_not_calibrated"))
    for language, bounds in policy["languages"].items():
        if bounds:
            chosen = F.when(columns["language"] == language, _by_bounds(bounds, columns)).otherwise(chosen)
    return (
        F.when(failed, _result("error", _said("error")))
        .when(truth("boundary_cut", columns), _result("review", _said("boundary_cut")))
        .when(truth("silent", columns), _result("reject", _said("silent")))
        .when(F.coalesce(normalized, F.lit("")) == "", _result("reject", _said("empty_transcript")))
        .otherwise(chosen)
    )


def profile_decision(policy: Mapping, profile: str, columns: Mapping[str, Column], normalized: Column) -> Column:
    """struct(status, reasons) under a profile's bounds for the record's language and kind.

    `columns` besides those of `decision`: kind, reference_text, ok_stages (array of stage names),
    alignment_status, speaker_status, diar_speakers, speaker_capacity_reached, speaker_reference_available.
    """
    failed = F.coalesce(F.length(columns["error"]) > 0, F.lit(False)) if "error" in columns else F.lit(False)
    kind = F.coalesce(columns["kind"], F.lit("podcast"))
    chosen = _result("review", _said("language_source_profile_not_calibrated"))
    cells = policy["profiles"].get(profile, {"languages": {}})["languages"]
    for language, by_kind in cells.items():
        for name, bounds in by_kind.items():
            if bounds:
                here = (columns["language"] == language) & (kind == name)
                chosen = F.when(here, _profile_cell(language, profile, bounds, columns, normalized)).otherwise(chosen)
    return (
        F.when(failed, _result("error", _said("error"))).when(truth("silent", columns), _result("reject", _said("silent"))).otherwise(chosen)
    )


def _profile_cell(language: str, profile: str, bounds: Mapping, columns: Mapping[str, Column], normalized: Column) -> Column:
    tts = profile == "tts"
    required = sorted(["asr", "alignment_tr" if language == "tr" else "alignment_qwen", *(["diarization", "quality", "speaker"] if tts else [])])
    done = F.coalesce(columns["ok_stages"], F.array().cast("array<string>"))
    referenced = F.coalesce(F.length(columns["reference_text"]) > 0, F.lit(False))
    review = lambda name: F.coalesce(columns[name] == "review", F.lit(False))
    missing = [F.when(~F.array_contains(done, stage), f"{stage}:missing_stage") for stage in required]
    missing.append(F.when(review("alignment_status"), "alignment_requires_review"))
    missing.append(F.when(truth("boundary_cut", columns), "boundary_cut"))
    if not {"reference_cer", "reference_wer"} & bounds.keys():
        missing.append(F.when(referenced, "reference_agreement_bound_required"))
    if not {"avg_logprob", "compression_ratio"} <= bounds.keys():
        missing.append(F.when(~referenced, "untranscribed_asr_bounds_required"))
    available = truth("speaker_reference_available", columns)
    if tts:
        missing.append(F.when(~columns["diar_speakers"].eqNullSafe(F.lit(1)), "tts_requires_one_speaker"))
        missing.append(F.when(truth("speaker_capacity_reached", columns), "diarization_capacity_reached"))
        missing.append(F.when(review("speaker_status"), "speaker_requires_review"))
        missing += [F.lit(f"{m}:bound_required") for m in ("overlap_ratio", "speaker_consistency", "dnsmos_ovrl") if m not in bounds]
        if "speaker_similarity" not in bounds:
            missing.append(F.when(available, "speaker_similarity:bound_required"))
    missing = _reasons(*missing)
    decide = lambda effective: decision({"languages": {language: effective}}, columns, normalized)
    found = decide(bounds)
    if tts and "speaker_similarity" in bounds:
        found = F.when(available, found).otherwise(decide({m: b for m, b in bounds.items() if m != "speaker_similarity"}))
    all_ = F.concat(found["reasons"], missing)
    status = F.when(found["status"].isin("reject", "error"), found["status"]).when(F.size(all_) > 0, "review").otherwise("accept")
    return _result(status, all_)
