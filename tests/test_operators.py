"""Decisions, selection, stages, intervals, activity and groups on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import diarization, groups, intervals, policy, selection, speakers, splits, stages, vad

BOUNDS = {"overlap_ratio": {"max": 0}, "speaker_consistency": {"min": 0.2}, "speaker_similarity": {"min": 0.7}, "dnsmos_ovrl": {"min": 2}, "reference_cer": {"max": 0.1}}
TTS = {"profiles": {"tts": {"languages": {"en": {"synthetic": BOUNDS}}}}}
RECORD = {
    "language": "en", "kind": "synthetic", "text": "hello", "reference_text": "hello", "error": None, "boundary_cut": False, "silent": False,
    "reference_cer": 0.0, "overlap_ratio": 0.0, "speaker_consistency": 0.8, "speaker_similarity": 0.9, "dnsmos_ovrl": 3.0, "diar_speakers": 1.0,
    "alignment_status": "ok", "speaker_status": "ok", "speaker_capacity_reached": False, "speaker_reference_available": True,
    "ok_stages": ["asr", "alignment_qwen", "diarization", "quality", "speaker"],
}
SCHEMA = (
    "language string, kind string, text string, reference_text string, error string, boundary_cut boolean, silent boolean, reference_cer double, overlap_ratio double, "
    "speaker_consistency double, speaker_similarity double, dnsmos_ovrl double, diar_speakers double, alignment_status string, speaker_status string, "
    "speaker_capacity_reached boolean, speaker_reference_available boolean, ok_stages array<string>"
)


def decide(spark, f, **changes):
    row = spark.createDataFrame([tuple((RECORD | changes).values())], SCHEMA)
    found = row.select(f({c: F.col(c) for c in row.columns}, F.col("text")).alias("d")).first()["d"]
    return found["status"], found["reasons"]


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, ("accept", [])),
        ({"reference_cer": None}, ("review", ["reference_cer:missing"])),
        ({"reference_cer": float("nan")}, ("review", ["reference_cer:missing"])),
        ({"reference_cer": float("inf")}, ("review", ["reference_cer:missing"])),
        ({"reference_cer": 0.5}, ("reject", ["reference_cer:outside_bounds"])),
        ({"boundary_cut": True, "reference_cer": 5.0}, ("review", ["boundary_cut"])),
        ({"boundary_cut": True, "silent": True}, ("review", ["boundary_cut"])),
        ({"silent": True}, ("reject", ["silent"])),
        ({"text": ""}, ("reject", ["empty_transcript"])),
        ({"language": "zh"}, ("review", ["language_not_calibrated"])),
        ({"error": "x", "silent": True}, ("error", ["error"])),
    ],
)
def test_decision(spark, changes, expected):
    rules = {"languages": {"en": {"reference_cer": {"max": 0.0}}}}
    assert decide(spark, lambda c, t: policy.decision(rules, c, t), **changes) == expected


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, ("accept", [])),
        ({"boundary_cut": True, "silent": True}, ("reject", ["silent"])),
        ({"boundary_cut": True, "reference_cer": 5.0}, ("review", ["boundary_cut", "boundary_cut"])),
        ({"diar_speakers": None}, ("review", ["tts_requires_one_speaker"])),
        ({"ok_stages": ["asr"]}, ("review", ["alignment_qwen:missing_stage", "diarization:missing_stage", "quality:missing_stage", "speaker:missing_stage"])),
        ({"dnsmos_ovrl": 1.0, "speaker_status": "review"}, ("reject", ["dnsmos_ovrl:outside_bounds", "speaker_requires_review"])),
        ({"speaker_similarity": None, "speaker_reference_available": False}, ("accept", [])),
        ({"kind": None}, ("review", ["language_source_profile_not_calibrated"])),
    ],
)
def test_profile_decision(spark, changes, expected):
    assert decide(spark, lambda c, t: policy.profile_decision(TTS, "tts", c, t), **changes) == expected


@pytest.mark.parametrize("limits", [{"max": float("nan")}, {"max": float("inf")}, {"max": True}, {"min": 2, "max": 1}, {"maximum": 1}, {}])
def test_bad_bounds(limits):
    with pytest.raises(ValueError):
        policy.validate_policy({"languages": {"en": {"reference_cer": limits}}})


def test_first_accepted_wins(spark):
    rows = [(0, "bad", "h", "reject", ["x"]), (1, "good", "h", "accept", []), (2, "duplicate", "h", "accept", []), (3, "none", None, "accept", []), (4, "other", None, "accept", [])]
    found = selection.first_accepted_wins(spark.createDataFrame(rows, "seq long, id string, pcm_sha256 string, status string, reasons array<string>"))
    assert {r["id"]: (r["status"], r["reasons"]) for r in found.collect()} == {
        "bad": ("reject", ["x"]), "good": ("accept", []), "duplicate": ("reject", ["exact_pcm_duplicate:good"]), "none": ("accept", []), "other": ("accept", []),
    }


def test_counts_have_zeros(spark):
    rows = spark.createDataFrame([("accept",), ("accept",)], "status string")
    assert {r["status"]: r["n"] for r in selection.counts_by(rows, "status", policy.STATUSES).collect()} == {"accept": 2, "reject": 0, "review": 0, "error": 0}


def test_calibration_and_labels(spark):
    rows = spark.createDataFrame([("en", "accept", "reject", 2.0), ("en", "accept", "accept", 1.0), ("fr", "error", "accept", 1.0), ("fr", "accept", "unsure", 1.0)], "language string, status string, human_label string, duration_s double")
    found = {r["language"]: r for r in selection.calibration(rows, ["language"]).collect()}
    assert found["en"]["accept_precision"] == 0.5 and found["en"]["false_accept_rate"] == 1.0 and found["en"]["accepted_seconds"] == 3.0
    assert found["fr"]["review_or_error"] == 1 and found["fr"]["labels"] == 1 and found["fr"]["accept_precision"] is None
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    with pytest.raises(ValueError):
        selection.check_labels(spark.createDataFrame([("c",)], "id string"), ids)
    with pytest.raises(ValueError):
        selection.check_labels(spark.createDataFrame([("a",), ("a",)], "id string"), ids)


def test_stages(spark):
    base = spark.createDataFrame([("a", "en", None, False), ("b", "en", "broken", False), ("c", "zh", None, True), ("d", "tr", None, False)], "id string, language string, error string, silent boolean")
    results = spark.createDataFrame(
        [("a", "quality", {"q": 1.0}, None, 0.1), ("a", "asr", {"q": 0.5, "p": 2.0}, None, 0.2), ("d", "asr", None, "failed", 0.3)],
        "id string, stage string, metrics map<string,double>, error string, seconds double",
    )
    pending = lambda **o: sorted(r["id"] for r in stages.pending(base, results, "asr", **o).collect())
    assert pending() == [] and pending(retry_errors=True) == ["d"] and pending(languages=["en"], retry_errors=True) == []
    folded = {r["id"]: r for r in stages.fold(base, results).collect()}
    assert folded["a"]["metrics"] == {"q": 1.0, "p": 2.0} and folded["a"]["error"] is None
    assert {k: v["status"] for k, v in folded["a"]["stages"].items()} == {"asr": "ok", "quality": "ok"}
    assert folded["b"]["error"] == "broken" and folded["d"]["error"] == "failed"
    with pytest.raises(ValueError):
        stages.agreed(["x"], "y")


def test_range_join_against_brute_force(spark):
    rng = np.random.default_rng(2)
    spans = [("e", int(a), int(a + n)) for a, n in zip(rng.integers(0, 900, 60), rng.integers(0, 300, 60), strict=True)]
    chunks = [("e", int(a), int(a + n)) for a, n in zip(rng.integers(-50, 900, 60), rng.integers(0, 50, 60), strict=True)]
    found = intervals.range_join(spark.createDataFrame(spans, "episode string, begin long, finish long"), spark.createDataFrame(chunks, "episode string, a long, b long"), 70)
    got = sorted((r["begin"], r["finish"], r["a"], r["b"]) for r in found.collect())
    assert got == sorted((x, y, a, b) for _, x, y in spans for _, a, b in chunks if x < y and a < b and a < y and b > x)


def test_overlap_and_turns(spark):
    frames = [("e", 0, [0.9, 0.0]), ("e", 160, [0.9, 0.9]), ("e", 320, [0.0, 0.9])]
    spans = [("e", 80, 240), ("e", 80, 560)]
    found = intervals.overlap(spark.createDataFrame(spans, "episode string, begin long, finish long"), spark.createDataFrame(frames, "episode string, a long, p array<double>"))
    by = {r["finish"]: r for r in found.collect()}
    assert by[240]["overlap_ratio"] == 0.5 and by[240]["diar_speakers"] == 2 and by[240]["error"] is None
    assert by[560]["overlap_ratio"] is None and by[560]["error"] == "incomplete_diarization_coverage"
    active = spark.createDataFrame([("s", 0, 0), ("s", 0, 1), ("s", 0, 5), ("s", 1, 1)], "span string, speaker int, frame long")
    assert sorted((r["speaker"], r["start"], r["end"]) for r in intervals.turns(active).collect()) == [(0, 0, 320), (0, 800, 960), (1, 160, 320)]


def test_activity():
    speech = [1.0] * 938
    whole = vad.spans_of(speech, 480_000)
    assert whole == [(0, 480_000, True)] or whole == [(0, 480_000, False)]
    # A forced cut marks the span and its continuation.
    long = vad.spans_of([1.0] * 944, 483_200)
    assert long == [(0, 480_000, True), (480_000, 483_200, True)]
    # Silence that begins before the cut still closes what follows it, even before its start.
    odd = vad.spans_of([1.0] * 936 + [0.0] * 10)
    assert odd[0] == (0, 480_000, True) and odd[1][1] < odd[1][0]
    assert vad.spans_of([0.0] * 5 + [0.9] * 2 + [0.0] * 20) == []
    rng = np.random.default_rng(3)
    p = rng.random(400).tolist()
    state = vad.Activity()
    pieces = [s for k in range(0, 400, 7) for s in state.feed(p[k : k + 7])] + list(state.finish(400 * 512))
    assert pieces == vad.spans_of(p)


def test_components_and_groups(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(None, 1), (7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = groups.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {x: root(x) for x in parent}
    assert groups.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    rows = [("1", ["audio:a", "speaker:s"]), ("2", ["audio:b", "speaker:s"]), ("3", ["audio:b", "source:z"]), ("4", ["audio:q"])]
    grouped = splits.assign(splits.grouped(spark.createDataFrame(rows, "id string, k array<string>"), F.col("k")))
    got = {r["id"]: (r["root"], r["split"]) for r in grouped.collect()}
    assert {got[i] for i in "123"} == {got["1"]} and got["1"][0] == "audio:a" and got["4"][0] == "audio:q"


def test_diarization_summary(spark):
    one = lambda *on: [1.0 if k in on else 0.0 for k in range(8)]
    stored = [("e", 0, [one(0), one(1)]), ("f", 0, [one(0, 1), one(1)]), ("g", 0, [one(*range(8))] * 2)]
    frames = diarization.frames_of(spark.createDataFrame(stored, "episode string, a long, p array<array<double>>"))
    spans = [("e", 80, 240), ("f", 80, 240), ("g", 0, 320), ("e", 0, 400), ("f", 0, 900)]
    found = {(r["episode"], r["begin"]): r for r in diarization.summarize(spark.createDataFrame(spans, "episode string, begin long, finish long"), frames).collect()}
    e = found["e", 80]
    assert (e["diar_speakers"], e["overlap_ratio"]) == (2, 0.0)
    assert [(t["start"], t["end"], t["speaker"]) for t in e["speaker_turns"]] == [(0.0, 0.005, "speaker_0"), (0.005, 0.01, "speaker_1")]
    f = found["f", 80]
    assert (f["overlap_ratio"], f["overlap_seconds"]) == (0.5, 0.005) and not f["speaker_capacity_reached"]
    assert found["g", 0]["speaker_capacity_reached"] and found["g", 0]["diar_speakers"] == 8
    assert found["e", 0]["unscored_tail_samples"] == 80 and found["e", 0]["boundary_cut"] and found["e", 0]["diar_speakers"] is None
    assert found["f", 0]["error"] == "incomplete_diarization_coverage"
    with pytest.raises(ValueError):
        diarization.checked(np.full((3, 8), 1.5))
    assert [(a, b) for a, b, _ in diarization.chunks(np.zeros((3001, 8)))] == [(0, 480_000), (480_000, 480_160)]


def test_speakers(spark):
    rows = [("a", "h", 0.0, 1.0, [1.0, 0.0], [[1.0, 0.0], [0.0, 1.0], [0.0, 1.0]]), ("b", "h", 0.0, 1.0, [0.0, 1.0], [[1.0, 0.0]]), ("c", None, None, None, [1.0, 0.0], [])]
    table = spark.createDataFrame(rows, "id string, reference_sha256 string, reference_start double, reference_end double, embedding array<float>, windows array<array<float>>")
    found = {r["id"]: r for r in speakers.compare(speakers.embed_references(table, lambda r: [2.0, 0.0])).collect()}
    assert (found["a"]["speaker_similarity"], found["b"]["speaker_similarity"], found["c"]["speaker_similarity"]) == (1.0, 0.0, None)
    assert found["a"]["speaker_consistency"] == 0.5 and found["b"]["speaker_status"] == "review" and not found["c"]["speaker_reference_available"]


def test_signal_queries_read_whole_clips(spark, tmp_path):
    from corvane.functions import dsp
    from corvane.plans.queries import QUERIES

    rng = np.random.default_rng(4)
    values = {1: rng.uniform(0, 100, 120), 2: rng.uniform(0, 100, 3)}
    rows = [(u, i, u * 1000 + i, float(v)) for u, vs in values.items() for i, v in enumerate(vs)]
    spark.createDataFrame(rows, "user_id long, ts long, event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    features = {r["user_id"]: r for r in QUERIES["fbank"](spark, str(tmp_path)).collect()}
    paths = {r["user_id"]: r for r in QUERIES["ctc_viterbi"](spark, str(tmp_path)).collect()}
    filters, window = dsp.mel_filters(), 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(dsp.FRAME) / dsp.FRAME)
    for u, vs in values.items():
        clip = np.tile(vs / 200 - 0.1, 200)
        padded = np.concatenate([np.zeros(dsp.FRAME // 2), clip, np.zeros(dsp.FRAME // 2)])
        starts = range(0, len(padded) - dsp.FRAME + 1, dsp.HOP)
        power = [np.abs(np.fft.rfft(padded[a : a + dsp.FRAME] * window, dsp.FFT)) ** 2 @ filters for a in starts]
        mel = 10 * np.log10(np.maximum(power, 1e-10))
        mel = np.maximum(mel, mel.max() - 80)
        assert features[u]["n"] == len(starts) and np.isclose(features[u]["value"], np.abs(mel - mel.mean(axis=0)).mean())
        # The best path by a plain recursion over blanks and tokens.
        x = dsp.log_softmax(clip.reshape(-1, 5) * 50)
        labels = [0, 1, 0, 2, 0, 2, 0, 3, 0]
        best = {0: x[0, 0], 1: x[0, 1]}
        for row in x[1:]:
            came = {}
            for s, k in enumerate(labels):
                ways = [s, s - 1] + [s - 2] * (s % 2 and s > 2 and k != labels[s - 2])
                known = [best[w] for w in ways if w in best]
                if known:
                    came[s] = max(known) + row[k]
            best = came
        assert paths[u]["n"] == len(x) and np.isclose(paths[u]["value"], max(best[7], best[8]))
